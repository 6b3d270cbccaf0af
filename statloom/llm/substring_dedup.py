"""Substring dedup: Rabin-Karp window hashes, counted in Spark, merged into maximal removal intervals.

Every window of ``width`` consecutive words has a 64-bit rolling hash and a
second, independent one that only chooses its shuffle partition, so two
windows count as equal when both agree in effect (64 + log2(partitions) bits).

1. Map: a block of documents (a few MB of text) sends each window hash once,
   with the smallest doc_id that has it in the block. Copies inside a block
   need no sending: the block's own first document already precedes them.
   A passage that a third of all rows share costs one entry per block.
2. Count: each hash partition finds the hashes that several blocks sent and
   the smallest doc_id of each, and tells the other documents.
3. Remove: each document marks the windows it was told about, and the marks
   merge into maximal intervals of words.

The texts cross the shuffle once, the hashes once. No hash, document or
interval passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from statloom.llm import flat
from statloom.llm.shared import text_groups

WIDTH = 13
#: Bytes of text whose windows are held at a time.
BLOCK_BYTES = 3 << 20
#: The documents and what they are told meet in this many groups for each group of windows.
GROUPS_PER_GROUP = 4

#: Wire format: window entries (docs, counts, hashes) or intervals already settled (keys, spans).
_WIRE = ["part", "docs", "counts", "hashes", "keys", "spans"]
_WIRE_DDL = "part int, docs binary, counts binary, hashes binary, keys binary, spans binary"


def _pack_docs(doc: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted doc_ids with repeats: the first id and the steps to the next ones, and how often each occurs."""
    own, counts = np.unique(doc, return_counts=True)
    return own[:1].tobytes() + flat.narrow(np.diff(own.view(np.uint64))), flat.narrow(counts)


def _unpack_docs(docs: bytes, counts: bytes) -> np.ndarray:
    first = np.frombuffer(docs, np.int64, 1)
    return np.repeat(np.cumsum(np.concatenate([first, flat.wide(docs[8:])])), flat.wide(counts))


def _row_keys(words: flat.Words, ids: np.ndarray) -> np.ndarray:
    """A hash of each row's doc_id and words."""
    place = np.arange(len(words.hash)) - words.row_first[words.row]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat.mix(words.hash + place.astype(np.uint64) * flat.ODD))])
    return flat.mix((total[words.row_first[1:]] - total[words.row_first[:-1]]) ^ flat.mix(ids.astype(np.uint64)))


def _block_entries(words: flat.Words, ids: np.ndarray, width: int):
    """(hash, route, smallest doc_id) of each distinct window of a block, and the windows the block settles itself."""
    at, h = flat.window_hashes(words, width, seed=101)
    _, route = flat.window_hashes(words, width, seed=202)
    doc = ids[words.row[at]] if len(at) else np.zeros(0, np.int64)
    order = np.argsort(doc, kind="stable")
    order = order[np.argsort(h[order], kind="stable")]
    at, h, route, doc = at[order], h[order], route[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    least = doc[first][np.cumsum(first) - 1] if len(h) else doc
    return h[first], route[first], doc[first], np.sort(at[doc > least])


def _runs(words: flat.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted window places as (row, first, last + 1) runs, places counted within the row."""
    row = words.row[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(at))[: int(new.sum())] - 1
    base = words.row_first[row[new]]
    return row[new], at[new] - base, at[last] + 1 - base


def _group(ids: np.ndarray, groups: int) -> np.ndarray:
    return (flat.mix(ids.astype(np.uint64)) % np.uint64(groups)).astype(np.int32)


def _wire(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in _WIRE]
    return pa.record_batch([pa.array(c, pa.binary() if i else pa.int32()) for i, c in enumerate(columns)], _WIRE)


def _window_entries(width: int, parts: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, size=BLOCK_BYTES):
            ids = block.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            words = flat.find_words(*flat.text_buffer(block.column("text")), flat.SPACED)
            h, route, doc, settled = _block_entries(words, ids, width)
            part = (route % np.uint64(parts)).astype(np.int32)
            order = np.lexsort((doc, part))
            rows = [(p, *_pack_docs(d), x.tobytes(), b"", b"") for p, d, x in flat.cut_by(part[order], doc[order], h[order])]
            # intervals the block settles itself go straight to their documents, under a negative part
            row, first, end = _runs(words, settled)
            grp, keys = _group(ids[row], groups), _row_keys(words, ids)[row]
            order = np.argsort(grp, kind="stable")
            rows += [(-1 - g, b"", b"", b"", k.tobytes(), np.stack([a, b]).tobytes())
                     for g, k, a, b in flat.cut_by(grp[order], keys[order], first[order], end[order])]
            for i in range(0, len(rows), 64):
                yield _wire(rows[i : i + 64])

    return run


def _repeats(groups: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one hash partition: the (doc_id, hash) pairs that a smaller doc_id precedes."""
        part = table.column("part")[0].as_py()
        if part < 0:  # settled by a block: pass on
            return table.set_column(0, "part", pa.array([-1 - part] * len(table), pa.int32()))
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()])
        doc = np.concatenate([_unpack_docs(d, c) for d, c in zip(table.column("docs").to_pylist(), table.column("counts").to_pylist(), strict=True)])
        ranked = np.sort(hashes)
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        if not len(twice):
            return pa.Table.from_batches([_wire([])])
        at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        keep = twice[at] == hashes
        at, doc, hashes = at[keep], doc[keep], hashes[keep]
        least = np.full(len(twice), np.iinfo(np.int64).max)
        np.minimum.at(least, at, doc)
        later = doc > least[at]
        doc, hashes = doc[later], hashes[later]
        grp = _group(doc, groups)
        order = np.lexsort((hashes, doc, grp))
        rows = [(g, *_pack_docs(d), h.tobytes(), b"", b"") for g, d, h in flat.cut_by(grp[order], doc[order], hashes[order])]
        return pa.Table.from_batches([_wire(rows)])

    return run


class Told:
    """What one group of documents was told: (doc_id, hash) pairs and settled intervals."""

    def __init__(self, table: pa.Table):
        rows = table.select(_WIRE[1:]).to_pylist()
        pairs = [r for r in rows if r["hashes"]]
        spans = [r for r in rows if r["keys"]]
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)])
        doc = join([_unpack_docs(r["docs"], r["counts"]) for r in pairs], np.int64)
        hashes = join([np.frombuffer(r["hashes"], np.uint64) for r in pairs], np.uint64)
        self.pairs = np.unique(_pair_keys(doc, hashes))
        keys = join([np.frombuffer(r["keys"], np.uint64) for r in spans], np.uint64)
        ends = [np.frombuffer(r["spans"], np.int64).reshape(2, -1) for r in spans]
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.first, self.end = (np.concatenate([*(e[i] for e in ends), np.zeros(0, np.int64)])[order] for i in (0, 1))

    def mask(self, words: flat.Words, ids: np.ndarray, width: int) -> np.ndarray:
        """For every word: is it covered by a window that its document was told to remove?"""
        change = np.zeros(len(words.hash) + 1, np.int64)
        at, h = flat.window_hashes(words, width, seed=101)
        if len(at) and len(self.pairs):
            key = _pair_keys(ids[words.row[at]], h)
            hit = at[self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key]
            np.add.at(change, hit, 1)
            np.add.at(change, hit + width, -1)
        if len(self.keys):
            row_key = _row_keys(words, ids)
            a, b = np.searchsorted(self.keys, row_key, "left"), np.searchsorted(self.keys, row_key, "right")
            for r in np.flatnonzero(b > a):
                np.add.at(change, words.row_first[r] + self.first[a[r] : b[r]], 1)
                np.add.at(change, words.row_first[r] + self.end[a[r] : b[r]] - 1 + width, -1)
        return np.cumsum(change)[: len(words.hash)] > 0


def _pair_keys(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return flat.mix(hashes ^ flat.mix(doc.astype(np.uint64) + flat.ODD))


def _intervals(mask: np.ndarray) -> list[int]:
    """Maximal runs of removed words as a flat list first, end, first, end, ..."""
    return np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).tolist()


_OUT = "n_words long, n_removed long, spans array<int>, kept_text string"


def _remove(width: int, extra: list[str], schema: pa.Schema, as_is: bool):
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        told = Told(table)
        out = []
        for block in flat.blocks(docs.to_batches(), size=BLOCK_BYTES):
            ids = block.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            buf, off = flat.text_buffer(block.column("text"))
            words = flat.find_words(buf, off, flat.SPACED)
            mask, raw = told.mask(words, ids, width), buf.tobytes()
            n, removed, spans, kept = [], [], [], []
            for r in range(block.num_rows):
                own = mask[words.row_first[r] : words.row_first[r + 1]]
                n.append(len(own))
                removed.append(int(own.sum()))
                spans.append(_intervals(own) if removed[-1] else [])
                whole = raw[off[r] : off[r + 1]]
                if removed[-1]:
                    kept.append(b" ".join(compress(whole.split(), ~own)))
                else:
                    kept.append(whole if as_is else b" ".join(whole.split()))
            made = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                    pa.array(kept, pa.binary()).cast(pa.string())]
            columns = [*(block.column(c) for c in extra), *made]
            out.append(pa.record_batch([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def _with_group(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp = _group(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), groups)
            yield pa.RecordBatch.from_arrays([pa.array(grp), *batch.columns], ["part", *batch.schema.names])

    return run


def dedup_windows(docs: DataFrame, width: int = WIDTH, keep: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller doc_id.

    Returns doc_id, the columns named in ``keep``, n_words, n_removed, spans
    (maximal removed intervals, flat: first word, end, ...) and kept_text (kept
    words joined by one space; with ``as_is`` a text that loses nothing stays
    as it is, white space included).

    NULL and empty texts have no words and come back empty. Texts shorter than
    a window keep everything. Rows that share a doc_id are one document for
    the rule: neither precedes the other. A NULL doc_id comes after every
    other document. Other columns are ignored unless named in ``keep``,
    whatever their names; an empty table gives an empty result.
    """
    last = F.lit(2**63 - 1)
    parts = text_groups(docs)
    groups = parts * GROUPS_PER_GROUP
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc_id"), *dict.fromkeys(["text", *keep]))
    sent = own.select("doc_id", "text").mapInArrow(_window_entries(width, parts, groups), _WIRE_DDL)
    told = sent.groupBy("part").applyInArrow(_repeats(groups), _WIRE_DDL)
    grouped = own.mapInArrow(_with_group(groups), StructType([StructField("part", IntegerType()), *own.schema.fields]))
    out = StructType([*(own.schema[c] for c in ("doc_id", *keep)), *StructType.fromDDL(_OUT).fields])
    done = grouped.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_remove(width, ["doc_id", *keep], to_arrow_schema(out), as_is), out)
    return done.withColumn("doc_id", F.nullif("doc_id", last))


def digest(done: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_words, n_removed, kept_sha256."""
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
