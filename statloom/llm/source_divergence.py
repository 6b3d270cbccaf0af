"""Source divergence audit: how far each source of a language uses terms unlike the others.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. They
are counted by length-bucketed packing: in a block of texts, a term of up to 8
bytes becomes one uint64 word and one of up to 16 bytes two, big-endian and
padded with zeros, which no term holds; these are sorted by radix passes over
16-bit digits and counted by runs. Longer terms go to buckets of their own,
by powers of two of their length, sorted as bytes. Each block
gives one row per group and term; Spark adds them up before and after the
shuffle, so a group with a third of all rows costs one row per term and task.

A language keeps its terms that are in at least ``MIN_DOCS`` rows (each row is
one document). With N a group's or language's occurrences of kept terms and V
their number, a term with c occurrences has the share

    p = 1 + floor(10^9 (c + 1) / (N + V))

and the divergence of shares p and q is floor((p - q)^2 / q), all in whole
numbers. For two sources the sum over all kept terms splits into terms that one
of them lacks, whose share is then the same number, and terms of both:

    sum of f(p, q0) over the group's terms  + sum of f(p0, q) over the other's
    + (V - terms of one - terms of the other) f(p0, q0)
    + sum of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over the terms of both

The first two sums need only how many terms a group has with each count. The
last is taken in NumPy over terms dealt by hash, over the sources that have
them. No pairs of documents or of rows are made; the result itself holds every
pair of sources of a language.

NULL text, lang and source are ''. Texts without terms, and whole groups
without, have no occurrences; their group is still in the result. Repeated rows
count as often as they come. An empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import flat
from statloom.llm.shared import Tables, attach
from statloom.session import ensure_checkpoint_dir

UNIT = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, A-Z lower-cased.
LETTERS = flat.word_rule([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)
#: Texts are packed in blocks of about this many bytes; a longer text in pieces of this size.
BLOCK_BYTES = 2 << 20
#: Rows of kept terms that one group of the pair sums should hold.
GROUP_ROWS = 200_000
#: Terms x sources of one dense table of shares.
CELLS = 1 << 19

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] = _SMALL[0x61:0x7B]


# --- counting in a task ---


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows of uint64 words (most significant first): one counting pass per 16-bit digit that varies."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]  # radix for 16-bit integers
    return order


def _order(key: np.ndarray) -> np.ndarray:
    return radix_order(list(key.T)) if key.dtype == np.uint64 else np.argsort(key, kind="stable")


def pack(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width in bytes, members, keys) of each length bucket; keys are uint64[n, 1 or 2], or byte strings beyond 16 bytes."""
    length = end - start
    bucket = np.maximum(np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64), 3)
    for b in np.unique(bucket):
        width, who = 1 << int(b), np.flatnonzero(bucket == b)
        padded = np.concatenate([buf, np.zeros(width, np.uint8)])
        first, size = start[who], length[who]
        if width <= 16:
            load = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
            words = []
            for k in range(width // 8):
                inside = np.clip(size - 8 * k, 0, 8).astype(np.uint64)
                word = load[np.minimum(first + 8 * k, len(load) - 1)].astype(np.uint64)
                cut = (np.uint64(8) - inside) * np.uint64(8)
                words.append(np.where(inside > 0, (word >> (cut & np.uint64(63))) << (cut & np.uint64(63)), np.uint64(0)))
            yield width, who, np.stack(words, axis=1)
        else:
            rows = np.lib.stride_tricks.sliding_window_view(padded, width)[first]
            rows[np.arange(width) >= size[:, None]] = 0
            yield width, who, rows.view(f"S{width}").ravel()


def _runs(key: np.ndarray, owner: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sums of the weights for each different (key, owner); owners come in ascending order."""
    order = _order(key)
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    other = key[1:] != key[:-1]
    new[1:] = (other.any(axis=1) if key.ndim > 1 else other) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return key[first], owner[first], [np.add.reduceat(w[order], first) if len(first) else w[:0] for w in weights]


def _pieces(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK_BYTES`` that no term crosses."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + BLOCK_BYTES)
        while end < n and LETTERS.inside[buf[end - 1]] and LETTERS.inside[buf[end]] and end not in off:
            gap = np.flatnonzero(~LETTERS.inside[buf[end : end + BLOCK_BYTES]])
            row_end = int(off[np.searchsorted(off, end, "right")])
            end = min(row_end, end + int(gap[0]) if len(gap) else min(n, end + BLOCK_BYTES))
        yield at, end
        at = end


def count_terms(buf: np.ndarray, off: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms as uint8[n, width], group, occurrences, rows that have it) of a block, bucket by bucket.

    Rows must come in ascending order of ``group``. A text longer than a piece
    is counted piece by piece, so what is held is its different terms.
    """
    buf = _SMALL[buf]
    parts: dict[int, list] = {}
    for lo, hi in _pieces(buf, off):
        cuts = np.clip(off, lo, hi) - lo
        words = flat.find_words(buf[lo:hi], cuts, LETTERS)
        row = words.row
        for width, who, key in pack(buf[lo:hi], words.start, words.end):
            parts.setdefault(width, []).append(_runs(key, row[who], [np.ones(len(who), np.int64)]))
    for _width, runs in parts.items():
        key, row, (n,) = runs[0]
        if len(runs) > 1:
            key, row, n = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs]), np.concatenate([r[2][0] for r in runs])
            by_row = np.argsort(row, kind="stable")
            key, row, (n,) = _runs(key[by_row], row[by_row], [n[by_row]])
        # the runs lie by key and row, so by key and group too
        key, own, (n, rows) = _runs(key, group[row], [n, np.ones(len(n), np.int64)])
        shown = key.astype(">u8").view(np.uint8).reshape(len(key), -1) if key.dtype == np.uint64 else key.view(np.uint8).reshape(len(key), -1)
        yield shown, own, n, rows


def _strings(shown: np.ndarray) -> pa.Array:
    there = shown != 0
    offsets = np.zeros(len(shown) + 1, np.int32)
    np.cumsum(there.sum(axis=1), out=offsets[1:])
    return pa.StringArray.from_buffers(len(shown), pa.py_buffer(offsets), pa.py_buffer(shown[there]))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term in every group, and rows that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, size=BLOCK_BYTES):
            lang, source = (block.column(c).dictionary_encode() for c in ("lang", "source"))
            code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            text = block.column("text").take(pa.array(order))
            for shown, own, n, rows in count_terms(*flat.text_buffer(text), code[order]):
                yield pa.record_batch(
                    [lang.dictionary.take(pa.array(own // len(source.dictionary))), source.dictionary.take(pa.array(own % len(source.dictionary))),
                     _strings(shown), pa.array(n), pa.array(rows)], ["lang", "source", "term", "n", "docs"])

    counted = _plain(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


# --- shares and divergences ---


def share(count: str, n: str, v: str) -> Column:
    return F.expr(f"1 + (CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))) DIV CAST({n} + {v} AS DECIMAL(20,0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV {q}")


def _shares(count: np.ndarray, below: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / below), three decimal digits at a time so that nothing overflows."""
    rest, out = count + 1, np.zeros(np.broadcast(count, below).shape, np.int64)
    out, rest = out + rest // below, rest % below
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // below, rest % below
    return out + 1


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_terms(term: np.ndarray, source: np.ndarray, count: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Sums over the terms of both sources of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), for all sources.

    Rows are (term, source, count) codes, sorted by term; ``below`` is N + V of
    each source. A source that lacks a term has the share of count 0, which
    makes the summand 0, so tables over terms and sources need no mask.
    """
    sources = len(below)
    none = _shares(np.zeros(sources, np.int64), below)
    total, height = np.zeros((sources, sources), np.int64), max(1, CELLS // sources)
    term = np.unique(term, return_inverse=True)[1]
    for lo in range(0, int(term[-1]) + 1 if len(term) else 0, height):
        a, b = np.searchsorted(term, [lo, lo + height])
        counts = np.zeros((height, sources), np.int64)
        counts[term[a:b] - lo, source[a:b]] = count[a:b]
        p = _shares(counts, below[None, :])
        for g in range(sources):
            q = p[counts[:, g] > 0]
            own = q[:, g : g + 1]
            total[g] += (_f(own, q) - _f(own, none[None, :]) - _f(none[g], q) + _f(none[g], none)[None, :]).sum(axis=0)
    return total


def _pair_sums(kept: DataFrame) -> DataFrame:
    """(lang, source, item, value) parts of the pair sums from the terms that both have."""
    rows = kept.count()
    buckets = max(1, -(-rows // GROUP_ROWS))
    dealt = kept.select("lang", "source", "term", "n", (F.col("total") + F.col("vocab")).alias("below"),
                        F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()  # about GROUP_ROWS rows: terms are dealt by hash
        lang, source = table.column("lang")[0].as_py(), table.column("source").combine_chunks().dictionary_encode()
        code = source.indices.to_numpy()
        term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        below = np.zeros(len(source.dictionary), np.int64)
        below[code] = table.column("below").to_numpy()
        order = np.argsort(term, kind="stable")
        total = shared_terms(term[order], code[order], table.column("n").to_numpy()[order], below)
        g, s = np.nonzero(total)
        yield pa.record_batch([pa.array([lang] * len(g), pa.string()), pc.take(source.dictionary, pa.array(g)),
                               pc.take(source.dictionary, pa.array(s)), pa.array(total[g, s])], ["lang", "source", "item", "value"])

    return dealt.groupBy("lang", "bucket").applyInArrow(run, "lang string, source string, item string, value long")


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every other source of each group's language."""
    none = groups.withColumn("p0", F.when(F.col("vocab") > 0, share("0", "total", "greatest(vocab, 1)")).otherwise(1))
    other = none.select(F.col("lang").alias("l"), F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("terms").alias("item_terms"))
    mates = (F.col("lang") == F.col("l")) & (F.col("source") != F.col("item"))
    value = F.col("value").cast("decimal(38,0)")

    absent = none.join(other, mates).withColumn("f", divergence("p0", "q0"))
    absent = absent.select("lang", "source", "item", (F.expr("vocab - terms - item_terms").cast("decimal(20,0)") * F.col("f")).alias("value"))

    counts = kept.groupBy("lang", "source", "n", "total", "vocab").agg(F.count("*").alias("m")).withColumn("p", share("n", "total", "vocab"))
    held = counts.join(other, mates).withColumn("x", divergence("p", "q0")).withColumn("y", divergence("q0", "p"))
    both_ways = F.explode(F.array(
        F.struct(F.col("source").alias("g"), F.col("item").alias("s"), (F.col("m").cast("decimal(20,0)") * F.col("x")).alias("v")),
        F.struct(F.col("item").alias("g"), F.col("source").alias("s"), (F.col("m").cast("decimal(20,0)") * F.col("y")).alias("v"))))
    one_lacks = held.select("lang", both_ways.alias("w")).select("lang", F.col("w.g").alias("source"), F.col("w.s").alias("item"), F.col("w.v").alias("value"))

    parts = absent.select("lang", "source", "item", value.alias("value"))
    for part in (one_lacks, _pair_sums(kept)):
        parts = parts.unionByName(part.select("lang", "source", "item", value.alias("value")))
    return parts.where("source != item").groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _top_terms(kept: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` terms of each group that exceed the language's share most; first by hash of the term, then over those."""
    rows = kept.withColumn("p", share("n", "total", "vocab")).withColumn("q", share("lang_n", "lang_total", "vocab")).where("p > q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value"), F.pmod(F.xxhash64("term"), F.lit(32)).alias("salt"))
    order = [F.col("value").desc(), F.col("item")]
    first = F.row_number().over(Window.partitionBy("lang", "source", "salt").orderBy(*order))
    return rows.withColumn("first", first).where(F.col("first") <= limit).select("lang", "source", "item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for every other source of the language, part ``term`` for the ``top`` terms.

    Ranks go from 1 in each group and part by falling value, then by item in UTF-8 order.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    tables = Tables(spark, "divergence")
    counts = term_counts(docs)
    of_lang = Window.partitionBy("lang", "term")
    kept = counts.withColumn("lang_docs", F.sum("docs").over(of_lang)).withColumn("lang_n", F.sum("n").over(of_lang))
    kept = tables.write(kept.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "kept")

    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    terms = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("vocab"))
    langs = sizes.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(terms, "lang")
    groups = _plain(docs).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "terms", "vocab", "lang_total"]).checkpoint()  # one row per group

    full = attach(kept, groups, ["lang", "source"], F.col("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    done = None
    for part, rows in (("pair", _pairs(full, groups)), ("term", _top_terms(full, top))):
        ranked = rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
        if part == "term":
            ranked = ranked.where(F.col("rank") <= top)
        ranked = ranked.select("lang", "source", "part", "item", "value", "rank")
        done = ranked if done is None else done.unionByName(ranked)
    done = done.checkpoint()
    tables.drop()
    return done
