"""Benchmark decontamination with a generalised suffix automaton over the test items.

The items are normalised to words (A-Z lower-cased, punctuation dropped) and
indexed in one suffix automaton whose letters are words. Training documents
are streamed through it: every state change keeps the length of the longest
item substring that ends at the current word. Where that length reaches the
window (10 words, or a whole shorter item), the words of the match are hit.

Only stretches in which every two neighbouring words are neighbours in some
item can hold a match, so NumPy finds those stretches first and the automaton
runs over them alone; nothing else can change a match length of two or more.

Documents are never shuffled. The items are the query set: they are split
into blocks of ``BLOCK_BYTES`` by size, and each block's automaton is broadcast.
With several blocks the documents pass through them one after the other; what
was found so far is written to the shared folder in between, and a broadcast
ends with its pass. So a task holds one automaton and one Python worker however
large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm import flat
from statloom.llm.shared import Tables

WINDOW = 10
#: Bytes of item text in one automaton.
BLOCK_BYTES = 2 << 20
#: Bytes of document text that a task works on at once.
TEXT_BYTES = 2 << 20


class ItemIndex:
    """Generalised suffix automaton of a block of items, with the windows that make a hit."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.ids = [str(i) for i, _ in items]
        words = flat.find_words(*flat.text_buffer(pa.array([t or "" for _, t in items], pa.large_string())), flat.ALNUM_LOWER)
        self.vocabulary = np.unique(words.hash)
        code = np.searchsorted(self.vocabulary, words.hash)
        texts = [code[a:b].tolist() for a, b in zip(words.row_first[:-1], words.row_first[1:], strict=True)]
        pairs = [np.array(t[:-1], np.int64) * len(self.vocabulary) + np.array(t[1:], np.int64) for t in texts if len(t) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.shortest = min([window, *(len(t) for t in texts if t)])
        self.known = np.zeros(1 << 16, bool)
        self.known[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for t in texts:
            last = 0
            for c in t:
                last = self._extend(last, c)
        self.window_state = [self._climb(v) for v in range(len(self.link))]
        self.window_items: dict[int, set[int]] = {}
        self.short_items: dict[int, list[tuple[int, int]]] = {}
        for k, t in enumerate(texts):
            state = 0
            for at, c in enumerate(t):
                state = self.step[state][c]
                if at + 1 >= window:
                    self.window_items.setdefault(self.window_state[state], set()).add(k)
            if 0 < len(t) < window:
                while self.length[self.link[state]] >= len(t):
                    state = self.link[state]
                self.short_items.setdefault(state, []).append((len(t), k))

    def _extend(self, last: int, c: int) -> int:
        """Append a letter after ``last``; states are shared between items."""
        if c in self.step[last]:
            target = self.step[last][c]
            return target if self.length[target] == self.length[last] + 1 else self._clone(last, c, target)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and c not in self.step[at]:
            self.step[at][c] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            target = self.step[at][c]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._clone(at, c, target)
        return new

    def _clone(self, at: int, c: int, target: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.step[target]))
        self.link[copy], self.link[target] = self.link[target], copy
        while at >= 0 and self.step[at].get(c) == target:
            self.step[at][c] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _climb(self, state: int) -> int:
        """The state of the last ``window`` words of a longer match (-1 if it is shorter)."""
        if self.length[state] < self.window:
            return -1
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stretches(self, words: flat.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, end, codes): word ranges that can hold a match; codes cover all words (-1: in no item)."""
        code = np.full(len(words.hash), -1, np.int64)
        maybe = np.flatnonzero(self.known[(words.hash >> np.uint64(48)).astype(np.int64)])
        if not len(maybe) or not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), code
        place = np.minimum(np.searchsorted(self.vocabulary, words.hash[maybe]), len(self.vocabulary) - 1)
        found = self.vocabulary[place] == words.hash[maybe]
        code[maybe[found]] = place[found]
        joined = np.zeros(len(code), bool)  # with the word before it
        both = 1 + np.flatnonzero((code[1:] >= 0) & (code[:-1] >= 0))
        if len(self.pairs) and len(both):
            pair = code[both - 1] * len(self.vocabulary) + code[both]
            joined[both] = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        joined[words.row_first[:-1][words.row_first[:-1] < len(code)]] = False
        first = np.flatnonzero((code >= 0) & ~joined)
        # a stretch goes on while words are joined to the one before
        stop = np.flatnonzero(~joined)
        end = np.append(stop, len(code))[np.searchsorted(stop, first, "right")]
        long = end - first >= self.shortest
        return first[long], end[long], code

    def matches(self, codes: list[int]) -> Iterator[tuple[int, int, int, set[int] | list[tuple[int, int]]]]:
        """(end, words, length of the longest match, items) for each window that ends at a word."""
        state = size = 0
        for at, c in enumerate(codes):
            while state and c not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.step[state]:
                state, size = self.step[state][c], size + 1
            if size >= self.window:
                yield at + 1, self.window, size, self.window_items[self._climb(state)]
            if self.short_items:
                up = state
                while up > 0:
                    for n, k in self.short_items.get(up, ()):
                        if n <= size:
                            yield at + 1, n, size, {k}
                    up = self.link[up]


_FOUND = "n_words long, n_hit long, hits array<int>, items array<string>, longest int"


def _scan(index_of, extra: list[str], schema: pa.Schema, again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = index_of.value
        for block in flat.blocks(batches, size=TEXT_BYTES):
            words = flat.find_words(*flat.text_buffer(block.column("text")), flat.ALNUM_LOWER)
            first, end, code = index.stretches(words)
            n = block.num_rows
            hits = block.column("hits").to_pylist() if again else [[] for _ in range(n)]
            items = [set(x) for x in block.column("items").to_pylist()] if again else [set() for _ in range(n)]
            longest = block.column("longest").to_pylist() if again else [0] * n
            touched: dict[int, np.ndarray] = {}
            for a, b, row in zip(first.tolist(), end.tolist(), (np.searchsorted(words.row_first, first, "right") - 1).tolist(), strict=True):
                base, stop = words.row_first[row], words.row_first[row + 1]
                for at, size, length, found in index.matches(code[a:b].tolist()):
                    if row not in touched:
                        touched[row] = np.zeros(stop - base, bool)
                        for x, y in zip(hits[row][::2], hits[row][1::2], strict=True):
                            touched[row][x:y] = True
                    touched[row][a + at - size - base : a + at - base] = True
                    items[row].update(index.ids[k] for k in found)
                    longest[row] = max(longest[row], length)
            for row, mask in touched.items():
                hits[row] = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).tolist()
            n_hit = [sum(h[1::2]) - sum(h[::2]) for h in hits]
            columns = [*(block.column(c) for c in extra), pa.array(np.diff(words.row_first)), pa.array(n_hit, pa.int64()), pa.array(hits, pa.list_(pa.int32())),
                       pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(longest, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans of documents that occur in test items.

    ``items`` has item_id and text. Returns doc_id, the columns in
    ``keep`` (text among them if named), n_words, n_hit, hits (maximal hit spans in words, flat: first, end,
    ...), items (ids of the items with occurring windows, sorted as strings)
    and longest (words of the longest match that made a hit; 0 if none).

    NULL and empty texts have no words and no hits; items without words match
    nothing; items of fewer words than the window match as a whole. Items that
    share an id count once. A NULL item_id is the id "" . Other columns are
    ignored unless named in ``keep``. No items or documents: no hits or rows.
    """
    return _through(docs, items, window, keep)


def _through(docs: DataFrame, items: DataFrame, window: int, keep: tuple[str, ...], last=None, last_schema: StructType | None = None) -> DataFrame:
    """The documents with what ``find_hits`` finds. ``last`` is a further step on its batches in the last pass's tasks."""
    spark = docs.sparkSession
    chosen = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    keep = tuple(c for c in keep if c != "doc_id")
    done = docs.select("doc_id", *keep, *([] if "text" in keep else ["text"]))
    tables = Tables(spark, "decontaminate")
    for k in range(count):  # one automaton at a time: each block is bounded, and so is what the driver holds
        part = chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).distinct()
        held = spark.sparkContext.broadcast(ItemIndex([tuple(r) for r in part.collect()], window))
        extra = [c for c in done.columns if c in ("doc_id", *keep) or c == "text" and k < count - 1]
        out = StructType([*docs.select(*extra).schema.fields, *StructType.fromDDL(_FOUND).fields])
        scan = _scan(held, extra, to_arrow_schema(out), k > 0)
        if k < count - 1:
            done = tables.write(done.mapInArrow(scan, out), f"pass-{k}")
            held.destroy()
            if k:
                tables.drop(f"pass-{k - 1}")
        elif last is None:
            done = done.mapInArrow(scan, out)
        else:
            done = done.mapInArrow(lambda batches, scan=scan: last(scan(batches)), last_schema)
    return done


def report(found: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def _cut(schema: pa.Schema, max_words: int, max_share: float, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, size=TEXT_BYTES):
            buf, off = flat.text_buffer(block.column("text"))
            hits, kept, texts = block.column("hits").to_pylist(), [], []
            some = [r for r, h in enumerate(hits) if h]
            words = flat.find_words(buf, off, flat.ALNUM_LOWER) if some else None
            raw = buf.tobytes()
            cut: dict[int, str] = {}
            for r in some:
                every = list(zip(hits[r][::2], hits[r][1::2], strict=True))
                spans = [(a, b) for a, b in every if b - a >= max_words or b - a < window]  # below the window: whole short items
                base, n = words.row_first[r], words.row_first[r + 1] - words.row_first[r]
                if sum(b - a for a, b in every) > max_share * n:
                    cut[r] = ""
                    continue
                at, pieces = off[r], []
                for a, b in spans:
                    pieces.append(raw[at : words.start[base + a]])
                    at = words.end[base + b - 1]
                cut[r] = b"".join([*pieces, raw[at : off[r + 1]]]).decode("utf-8") or " "
            column = block.column("text").to_pylist() if some else None
            for r in range(block.num_rows):
                if r not in cut or cut[r]:
                    kept.append(r)
                    if column:
                        texts.append(cut.get(r, column[r]))
            rows = block.take(pa.array(kept, pa.int64())) if len(kept) < block.num_rows else block
            made = {"text": pa.array(texts, pa.string())} if column else {}
            yield pa.RecordBatch.from_arrays([made.get(f.name, rows.column(f.name)).cast(f.type) for f in schema], schema=schema)

    return run


def remove_hits(found: DataFrame, columns: list[str], max_words: int = WINDOW, max_share: float = 0.5, window: int = WINDOW) -> DataFrame:
    """Cut hit spans of at least ``max_words`` words out of the texts, and shorter ones that are whole items
    of fewer words than ``window`` (that of ``find_hits``); drop documents with more than ``max_share`` of
    their words in hit spans. Documents without hits keep their text unchanged (NULL too). No rows give no rows."""
    schema = found.select(*columns).schema
    return found.select(*columns, "hits").mapInArrow(_cut(to_arrow_schema(schema), max_words, max_share, window), schema)


def clean(docs: DataFrame, items: DataFrame, columns: list[str], max_words: int = WINDOW, max_share: float = 0.5, window: int = WINDOW) -> DataFrame:
    """``find_hits`` and ``remove_hits`` in the same tasks: ``columns`` of the documents that stay (text among them), and n_hit.

    A column named like one that ``find_hits`` makes can't be among them.
    """
    kept = docs.select(*columns).schema
    schema = StructType([*kept.fields, *StructType.fromDDL("n_hit long").fields])
    keep = tuple(c for c in columns if c != "doc_id")
    if clash := set(keep) & set(StructType.fromDDL(_FOUND).fieldNames()):
        raise ValueError(f"columns that find_hits makes: {sorted(clash)}")
    return _through(docs, items, window, keep, _cut(to_arrow_schema(schema), max_words, max_share, window), schema)
