"""Brute-force versions of the operators, and a table of awkward rows."""

import hashlib
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, part int, node long, n int, shard int, ids string"
PASSAGE = " ".join(f"shared{i}" for i in range(40))


def awkward():
    """NULLs, empty and blank texts, a very long one, ties, repeated rows, and columns whose names the operators use."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = [f"word{i}" for i in range(60)]
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, long), (5, " ".join(base)), (6, " ".join(base)), (7, " ".join([*base[:-1], "other"])),
             (8, "One two three four"), (9, "one TWO three\tfour"), (10, "Ünï çödé ñ — 漢字 🙂 x"), (11, PASSAGE), (12, "before " + PASSAGE + " after it all"),
             (13, "a"), (13, "a"), (None, " ".join(base)), (14, "!!! ... 123"), (15, "a" * 5000)]
    return [(i, t, "en" if k % 3 else None, "s" if k % 2 else None, k if k % 4 else None, k, None, 3, 4, "x") for k, (i, t) in enumerate(texts)]


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(docs):
    """doc_id -> (shingles, smallest doc_id reachable); docs is a list of (doc_id, text)."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    shared = Counter()
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            for j in holders.get(x, ()):
                shared[j, i] += 1
            holders.setdefault(x, []).append(i)
    for (i, j), both in shared.items():
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if (least.get(r) is not None or d is not None) else None
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def dedup(docs, width=13):
    """(doc_id, words, removed, kept words) by the rule on windows."""
    words = [SPACED.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


def hits(docs, items, width=10):
    """(doc_id, words, hit words, item ids) by comparing every window."""
    windows = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for d, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i : i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((d, len(w), len(hit), sorted(found)))
    return out
