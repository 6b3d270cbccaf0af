"""Vector codes, source divergence and quality rules against brute force, and on awkward rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest

from statloom.llm import flat, quality_rules, shared, source_divergence, vector_codes
from statloom.sources.tables import read_table

VECTORS = "vec_id long, embedding array<float>, label int, code_of string"


# --- vector codes ---


def _vectors(n=150, dim=32, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in np.round(rng.normal(0, 0.05, dim), 2)], int(rng.integers(3)) if i % 4 else None, "x") for i in range(n)]
    rows += [rows[7], rows[7], (7, rows[8][1], 1, "x"), (None, rows[9][1], None, None), (None, rows[10][1], 2, None)]
    rows += [(200, None, 1, "x"), (201, [None] * dim, 1, "x"), (202, [float("nan")] * dim, 1, "x"), (203, [float("-inf")] + [0.0] * (dim - 1), None, "x")]
    return rows


def _plain_codes(rows, parts=16, entries=64, rounds=2):
    """Every part against every entry, one by one, in Python integers."""
    kept = [(i, [int(np.floor(np.float32(v) * 256.0)) for v in e], label) for i, e, label, _ in rows if e is not None and all(v is not None and np.isfinite(v) for v in e)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, rows_key(kept[r][1])))
    books = [[cut[r][p] for r in order[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for c in cut:
                mine[near(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(mine[k]) for col in zip(*mine[k])] if k in mine else e for k, e in enumerate(books[p])]
    coded = []
    for (i, _, label), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    total = Counter()
    for _, _, error, label in coded:
        total[label] += error
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return sorted(((i, code, error, total[label], digest) for i, code, error, label in coded), key=str)


def rows_key(v):
    return tuple(v)


@pytest.mark.parametrize("rows", [_vectors(), _vectors(n=20), _vectors(n=90, dim=16, seed=3)])
def test_codes_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = sorted((tuple(r) for r in vector_codes.code_report(df).collect()), key=str)
    assert got == _plain_codes(rows)


def test_orchard_search_is_exact_with_ties_and_equal_entries():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 17, 64):
        entries = rng.integers(-4, 5, (k, 3))
        entries[k // 2] = entries[0]
        x = rng.integers(-6, 7, (500, 3))
        index, distance = vector_codes.Codebook(entries).nearest(x)
        apart = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (index == apart.argmin(1)).all() and (distance == apart.min(1)).all()


def test_codes_of_awkward_tables(spark):
    assert vector_codes.code_report(spark.createDataFrame([], VECTORS)).collect() == []
    nothing = spark.createDataFrame([(1, None, 1, "x")], VECTORS)
    assert vector_codes.code_report(nothing).collect() == []
    ragged = spark.createDataFrame([(1, [0.5] * 20, 1, "x"), (2, [0.5], 1, "x"), (3, [], 1, "x")], VECTORS)
    books = vector_codes.train(ragged)
    assert books.values.shape == (16, 3, 2)
    back = {r.vec_id: r.decoded for r in vector_codes.decode(vector_codes.encode(ragged, books, keep=("vec_id",)), books).collect()}
    assert back[1] == [0.5] * 20 + [0.0] * 12 and back[2] == [0.5] + [0.0] * 31 and back[3] == [0.0] * 32
    with pytest.raises(ValueError):
        vector_codes.encode(ragged, books, keep=("vec_id", "error"))
    with pytest.raises(Exception, match="too large"):
        vector_codes.train(spark.createDataFrame([(1, [1e20] * 16, 1, "x")], VECTORS))


def test_label_errors_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = _vectors()
    df = spark.createDataFrame(rows, VECTORS)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(shared, "SALTS", 3)
    assert sorted((tuple(r) for r in vector_codes.code_report(df).collect()), key=str) == _plain_codes(rows)


# --- source divergence ---

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall((text or "").translate(plain.LOWER))


def _plain_audit(rows, min_docs=3, top=200):
    """Every kept term of the language for every group and pair, in Python integers."""
    groups, docs, count = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        g = (lang or "", source or "")
        groups.add(g)
        docs[g[0]].update(set(_terms(text)))
        count[g].update(_terms(text))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for a, s in groups if a == lang)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def _sources(seed=11):
    """Texts of a few languages and sources, terms of all lengths, hot terms, copies and NULLs."""
    rng = np.random.default_rng(seed)
    words = ["a", "Bb", "ABCDEFGH", "abcdefghi", "x" * 16, "y" * 17, "é", "漢字漢字漢", "Zürich", "q" * 33, "r" * 300, "straßenbahnhaltestelle", "🙂", "don", "t"]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "de", "x"], p=[0.6, 0.3, 0.1]), f"s{int(rng.integers(6))}"
        n = int(rng.integers(0, 60))
        glue = rng.choice([" ", "-", "1", "\n", "_`"])
        rows.append((glue.join(rng.choice(words, n)), str(lang), source))
    rows += [rows[3]] * 40 + [(None, "en", "s1"), (None, None, None), ("!!", "none", "a"), ("one two", "none", "b"), ("", "en", "empty"), ("a A a", None, "s1")]
    return rows


@pytest.mark.parametrize("block", [source_divergence.BLOCK_BYTES, 300])
def test_audit_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(source_divergence, "BLOCK_BYTES", block)
    monkeypatch.setattr(source_divergence, "CELLS", 60)
    monkeypatch.setattr(source_divergence, "GROUP_ROWS", 50)
    rows = _sources()
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "text string, lang string, source string, n int, term string").repartition(4)
    for top in (200, 5):
        assert sorted(tuple(r) for r in source_divergence.audit(df, top=top).collect()) == _plain_audit(rows, top=top)


def test_audit_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    rows = _sources(4)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(tuple(r) for r in source_divergence.audit(df).collect()) == _plain_audit(rows)


def test_audit_of_awkward_tables(spark):
    rows = plain.awkward()
    df = spark.createDataFrame(rows, plain.COLUMNS)
    assert sorted(tuple(r) for r in source_divergence.audit(df).collect()) == _plain_audit([r[1:4] for r in rows])
    assert source_divergence.audit(df.where("false")).collect() == []


def test_a_block_counts_the_terms_of_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_BYTES", 64)
    texts = ["ab " * 100 + "long" * 40, "é" * 200, "", "ab AB ab-" * 9, "zz " + "ab" * 300]
    buf, off = flat.text_buffer(pa.array(texts))
    got = Counter()
    docs = Counter()
    for shown, own, n, rows in source_divergence.count_terms(buf, off, np.array([0, 0, 1, 1, 1])):
        for term, g, a, b in zip(source_divergence._strings(shown).to_pylist(), own.tolist(), n.tolist(), rows.tolist()):
            got[term, g] += a
            docs[term, g] += b
    want, seen = Counter(), Counter()
    for text, g in zip(texts, [0, 0, 1, 1, 1]):
        want.update((t, g) for t in _terms(text))
        seen.update((t, g) for t in set(_terms(text)))
    assert got == want and docs == seen


def test_radix_order_is_a_stable_byte_order():
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 4, 500).astype(np.uint64) << np.uint64(48), rng.integers(0, 2**63, 500).astype(np.uint64) % np.uint64(9)]
    order = source_divergence.radix_order(words)
    assert order.tolist() == sorted(range(500), key=lambda i: (int(words[0][i]), int(words[1][i])))


def test_shares_of_huge_counts():
    count = np.array([0, 1, 10**13, 3 * 10**14])
    below = np.array([7, 10**9, 10**13 + 5, 9 * 10**14])
    assert source_divergence._shares(count, below).tolist() == [1 + 10**9 * (int(c) + 1) // int(b) for c, b in zip(count, below)]


# --- quality rules ---


def _plain_statistics(text):
    text = text or ""
    words = plain.SPACED.findall(text)
    lines = [x for x in text.split("\n") if plain.SPACED.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), sum(c in plain_upper for c in text))


plain_upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _texts():
    rng = np.random.default_rng(8)
    words = ["a", "Bé", "c#", "<d>", "|", "漢字", "e\x0bf", "G,"]
    out = [t[1] for t in plain.awkward()] + ["a a a a", "a a a", "x\n x\nx\n\n\n \nx \nx", "a b c a b c\na b c a b c", "\n".join(["l1 w"] * 50)]
    return out + ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\r\n"], p=[0.7, 0.2, 0.05, 0.05]) for _ in range(int(rng.integers(80)))) for _ in range(80)]


def test_statistics_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BLOCK_BYTES", 5000)
    texts = _texts()
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(3)
    got = {r.doc_id: tuple(r[n] for n in quality_rules.STATISTICS) for r in quality_rules.statistics(df).collect()}
    assert got == {i: _plain_statistics(t) for i, t in enumerate(texts)}


def test_forest_scores_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[:, 2] = 0
    forest = quality_rules.Forest.grow(x, trees=9, rows=50, seed=1)

    def path(t, row, i=0):
        f = forest.feature[t, i]
        if f < 0:
            return forest.path[t, i]
        return path(t, row, 2 * i + 1 if row[f] <= forest.split[t, i] else 2 * i + 2)

    def usual(n):
        return 2 * sum(1 / k for k in range(1, n)) - 2 * (n - 1) / n

    want = [2 ** -(sum(path(t, row) for t in range(9)) / 9 / float(quality_rules.expected_path(50))) for row in x]
    assert np.allclose(forest.scores(x), want)
    assert abs(float(quality_rules.expected_path(256)) - usual(256)) < 0.01 and not (forest.feature == 2).any()
    far = forest.scores(np.array([[9.0, -9.0, 0.0], [0.0, 0.0, 0.0]]))
    assert far[0] > 0.6 > far[1]


def test_threshold_is_the_lowest_within_the_clean_loss():
    rng = np.random.default_rng(6)
    bad, clean = rng.integers(0, 5, 64), rng.integers(0, 50, 64)
    for loss in (0, 0.01, 0.2):
        got = quality_rules.threshold_of(bad, clean, loss)
        fits = [s for s in range(65) if clean[s:].sum() <= loss * clean.sum()]
        assert got == fits[0] / 64
    assert quality_rules.threshold_of(bad, clean * 0, 0.1) > 1 and quality_rules.threshold_of(bad * 0, clean, 0.1) > 1


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    done = quality_rules.quality_report(docs, labels)
    assert done.columns == ["doc_id", *quality_rules.BASE, "base_failed", "kept", "score"]
    rows = done.join(labels, "doc_id").where(quality_rules.held_out()).collect()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    judged = [r for r in rows if not r.base_failed]
    clean, bad = [r.kept for r in judged if r.quality == 1], [r.kept for r in judged if r.quality == 0]
    assert len(bad) > 50 and sum(clean) / len(clean) > 0.98 and sum(bad) / len(bad) < 0.1


def test_quality_of_awkward_tables(spark):
    docs = spark.createDataFrame(plain.awkward(), plain.COLUMNS)
    labels = spark.createDataFrame([(4, 0), (5, 1), (5, None), (None, 0), (6, 1), (99, 0)], "doc_id long, quality int")
    none = labels.where("false")
    for known in (labels, none):
        rows = quality_rules.quality_report(docs, known).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in plain.awkward())
        assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.kept != r.base_failed for r in rows)  # without labels the forest rejects nothing
    assert quality_rules.quality_report(docs.where("false"), labels).collect() == []
