"""Toxicity: a character n-gram linear classifier on naive-Bayes-scaled features.

Texts are lower-cased (A-Z), everything in ASCII that is no letter or digit
counts as a space, and the features are the n-grams of ``ORDERS`` consecutive
characters (code points) of a text with a space on either side, hashed into
one table per length; the value of one is log2(1 + occurrences), in steps of
1 / ``STEP``. From labelled documents:

1. naive Bayes: the log-count ratio r of each feature, the log of how much
   more often toxic documents have it than others (smoothed);
2. selection: the features whose ratio is clearest (|r| over its deviation);
3. a logistic regression over value * r of those features, with an L2
   penalty, whose intercept is corrected to the class shares of all labels.

The fit uses at most ``PER_CLASS`` rows of each class (the smallest hashes of
doc_id and text; equal rows once). They are written to the shared folder and
counted by many tasks; Spark adds the counts up and picks the features. One
task fits the regression over the entries (document, chosen feature, value),
at most 2 * ``PER_CLASS`` * ``SELECTED`` small numbers; it sees no text.
Class shares are counted over all labels. Every text is then scored whole in
its own task, a long one in pieces; only the weights (a few MB, fixed size)
are broadcast, and no text is shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm import flat
from statloom.llm.shared import Tables

ORDERS = (3, 4, 5, 6)
TABLE_BITS = 18
#: Rows of each class that the fit reads at most.
PER_CLASS = 3000
SELECTED = 20_000
SMOOTH = 1.0
PENALTY = 2e-3
ROUNDS = 300
#: Values are whole multiples of 1 / STEP, so that sums don't depend on their order.
STEP = 1 << 12
#: Bytes of text whose n-grams are held at once.
PIECE_BYTES = 1 << 19
#: Bytes of text that one task of the fit counts.
FIT_BYTES = 2 << 20


def _plain() -> np.ndarray:
    out = np.full(128, 0x20, np.uint32)
    for a, b in ((0x30, 0x3A), (0x61, 0x7B)):
        out[a:b] = np.arange(a, b)
    out[0x41:0x5B] = out[0x61:0x7B]
    return out


PLAIN = _plain()


def characters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, code point) of every character of UTF-8 text; ASCII as ``PLAIN`` maps it."""
    first = np.flatnonzero((buf & 0xC0) != 0x80)
    code = buf[first].astype(np.uint32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        lead, at = code[wide], first[wide]
        padded = np.append(buf, np.zeros(3, np.uint8))
        b, c, d = ((padded[at + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3))
        two, three, four = (lead & 0x1F) << 6 | b, (lead & 0x0F) << 12 | b << 6 | c, (lead & 0x07) << 18 | b << 12 | c << 6 | d
        code[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    ascii_ = code < 0x80
    code[ascii_] = PLAIN[code[ascii_]]
    return first, code


def pieces(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(characters, row of each, number of places at which n-grams may begin), a space on either side of a text included.

    A block beyond ``PIECE_BYTES`` is cut into pieces; each is followed by the characters that its last n-grams reach into.
    """
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + PIECE_BYTES)
        while end < n and buf[end] & 0xC0 == 0x80:
            end += 1
        stop = min(n, end + 4 * max(ORDERS))
        while stop < n and buf[stop] & 0xC0 == 0x80:
            stop += 1
        first, code = characters(buf[at:stop])
        row = np.searchsorted(off, first + at, "right") - 1
        # a text's first character has a space before it, its last one a space behind it
        opens = np.isin(first + at, off[:-1]).astype(np.int64)
        after = np.append(first[1:], stop - at) + at
        closes = np.isin(after, off[1:]).astype(np.int64)
        place = np.arange(len(first)) + np.cumsum(opens) + np.cumsum(closes) - closes
        size = len(first) + int(opens.sum() + closes.sum())
        text = np.full(size, 0x20, np.uint32)
        text[place] = code
        own = np.empty(size, np.int64)
        own[place] = row
        own[place[opens > 0] - 1] = row[opens > 0]
        own[place[closes > 0] + 1] = row[closes > 0]
        inside = int(np.searchsorted(first, end - at))
        starts = size if end == n else int(place[inside] - opens[inside])
        yield text, own, starts
        at = end


def features(text: np.ndarray, own: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: (row, table place) of every n-gram that begins in a piece."""
    value = text * np.uint32(0x9E3779B1)
    value = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    value ^= value >> np.uint32(13)
    h, power = np.zeros(len(text), np.uint32), 1
    for n in range(1, min(max(ORDERS), len(text)) + 1):
        h[: len(text) - n + 1] += value[n - 1 :] * np.uint32(power)
        power = power * 0x9E3779B1 % (1 << 32)
        if n in ORDERS:
            most = min(starts, len(text) - n + 1)
            at = np.flatnonzero(own[:most] == own[n - 1 : n - 1 + most])
            x = h[at]
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield own[at], ((x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - TABLE_BITS)


def counts(buf: np.ndarray, off: np.ndarray, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value in steps), by row and feature. Of the active features only, if given.
    Feature = order * table size + place."""
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for piece in pieces(buf, off):
        for k, (row, place) in enumerate(features(*piece)):
            if active is not None:
                some = active[k][place]
                row, place = row[some], place[some]
            key = (row << (TABLE_BITS + 3)) | (k << TABLE_BITS) | place.astype(np.int64)
            key.sort()
            first = np.flatnonzero(np.diff(key, prepend=-1))
            keys.append(key[first])
            times.append(np.diff(first, append=len(key)))
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    total = np.add.reduceat(n, first) if len(first) else n
    key = key[first]
    return key >> (TABLE_BITS + 3), key & ((1 << (TABLE_BITS + 3)) - 1), np.rint(np.log2(1 + total) * STEP).astype(np.int64)


class Model:
    """Weights per feature (one table per n-gram length) and intercept."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept
        self.active = weights != 0

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        row, feature, value = counts(buf, off, self.active)
        total = np.bincount(row, self.weights.ravel()[feature].astype(np.float64) * value / STEP, minlength=len(off) - 1)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -35, 35)))


def _logistic(row, column, value, scale, label, n) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression over the entries (row, column, scale[column]), by Adam steps."""
    y = label.astype(np.float64)
    weight, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(row, (weight[:n] * scale)[column] * value, minlength=len(y)) + weight[n]
        wrong = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        grad = np.append(np.bincount(column, wrong[row] * value, minlength=n) * scale / len(y) + PENALTY * weight[:n], wrong.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weight -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return weight[:n], float(weight[n])


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, text, label) of the fit: at most ``PER_CLASS`` of each class, equal rows once.

    ``known`` is (doc_id, toxic), one row per doc_id. Ids are drawn first, so that
    only their documents are looked at, then rows, as an id may have many.
    """
    label = F.col("toxic") == 1
    ids = [known.where(label == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for t in (True, False)]
    ids = ids[0].unionByName(ids[1]).select("doc_id", label.alias("label"))  # 2 * PER_CLASS rows at most
    rows = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(ids), "doc_id")
    keys = rows.select("doc_id", "text_hash", "label").distinct()
    drawn = [keys.where(F.col("label") == t).orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(PER_CLASS) for t in (True, False)]
    drawn = drawn[0].unionByName(drawn[1]).select("doc_id", "text_hash")
    rows = rows.join(F.broadcast(drawn), ["doc_id", "text_hash"])  # 2 * PER_CLASS rows at most
    return rows.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"), F.first("label").alias("label"))


def ratios(rows: DataFrame, n_yes: int, n_no: int) -> DataFrame:
    """(feature, ratio, clear) of every feature of the sampled rows: its log-count ratio, and that over its deviation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(ORDERS) << TABLE_BITS), np.int64)
        for block in flat.blocks(batches, size=PIECE_BYTES):
            row, feature, value = counts(*flat.text_buffer(block.column("text")))
            toxic = block.column("label").to_numpy(zero_copy_only=False).astype(bool)[row]
            for t in (0, 1):
                np.add.at(sums[t], feature[toxic == t], value[toxic == t])
        at = np.flatnonzero(sums.any(axis=0))
        for part in np.array_split(at, -(-len(at) // 50_000) or 1):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part.astype(np.int32), sums[0][part], sums[1][part])], ["feature", "no", "yes"])

    found = rows.select("text", "label").mapInArrow(run, "feature int, no long, yes long").groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    no, yes = (F.col(c) / STEP + SMOOTH for c in ("no", "yes"))
    found = found.withColumn("ratio", F.log(yes / (n_yes + 2 * SMOOTH)) - F.log(no / (n_no + 2 * SMOOTH)))
    return found.select("feature", "ratio", (F.abs("ratio") / F.sqrt(1 / yes + 1 / no)).alias("clear"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents that are not held out, at most ``PER_CLASS`` rows of each class.

    A document with several labels counts as toxic if one says so. NULL labels
    and doc_ids are left out; with one class or no labels, or no document
    that has one, the score is the (smoothed) share of toxic labels.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked, total = known.agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.count("*")).first()
    share = ((marked or 0) + 1) / (total + 2)
    prior = float(np.log(share / (1 - share)))
    size = 1 << TABLE_BITS
    tables = Tables(spark, "toxicity-fit")
    rows = tables.write(sample(docs, known), "sample")
    n_yes, n, volume = rows.agg(F.sum(F.col("label").cast("int")), F.count("*"), F.sum(F.octet_length("text"))).first()
    weights, intercept = np.zeros((len(ORDERS), size), np.float32), prior
    if n and 0 < n_yes < n:
        rows = rows.repartition(max(1, -(-(volume or 0) // FIT_BYTES)), "doc_id", "text_hash")
        chosen = ratios(rows, n_yes, n - n_yes).where("clear > 1").orderBy(F.desc("clear"), "feature").limit(SELECTED).select("feature", "ratio").collect()
        chosen.sort()
        feature = np.array([r.feature for r in chosen], np.int64)
        scale = np.array([r.ratio for r in chosen], np.float64)
        weight, bias = _fit(rows, feature, scale)
        weights.ravel()[feature] = weight * scale
        intercept = bias + prior - float(np.log(n_yes / (n - n_yes)))
    tables.drop()
    return Model(weights, intercept)


def _fit(rows: DataFrame, chosen: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight per chosen feature and intercept: all tasks look up the chosen features, one fits the regression."""
    place = np.full(len(ORDERS) << TABLE_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    held = rows.sparkSession.sparkContext.broadcast(place)  # fixed size

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = (held.value >= 0).reshape(len(ORDERS), -1)
        for block in flat.blocks(batches, size=PIECE_BYTES):
            row, feature, value = counts(*flat.text_buffer(block.column("text")), active)
            cuts = np.searchsorted(row, np.arange(block.num_rows + 1))
            packed = [held.value[feature[a:b]].tobytes() + value[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            columns = [block.column("doc_id"), block.column("text_hash"), block.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "label", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, column, value, length = [], [], [], []
        for batch in batches:
            labels.append(batch.column("label").to_numpy(zero_copy_only=False).astype(bool))
            for data in batch.column("packed").to_pylist():
                both = np.frombuffer(data, np.int32).reshape(2, -1)
                column.append(both[0])
                value.append(both[1].astype(np.float32) / STEP)
                length.append(both.shape[1])
        row = np.repeat(np.arange(len(length), dtype=np.int32), length)
        model = _logistic(row, np.concatenate(column), np.concatenate(value), scale, np.concatenate(labels), len(scale))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        flat.give_back()

    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, label boolean, packed binary"
    found = rows.select("doc_id", "text_hash", "label", "text").mapInArrow(entries, kind)
    made = found.repartition(1).sortWithinPartitions("label", "doc_id", "text_hash").mapInArrow(run, "model binary").first()
    held.unpersist()
    return pickle.loads(made.model)  # made by the task above  # noqa: S301


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text: doc_id, the columns in ``keep``, score (0 to 1) and predicted (1 from 0.5 on).

    NULL and empty texts have no features: their score is the model's
    intercept. Rows are independent, so repeats need no rule; an empty table
    gives no rows. A column in ``keep`` that is called like one of the results gives way to it.
    """
    extra = [c for c in dict.fromkeys(["doc_id", *keep]) if c not in ("score", "predicted")]
    out = StructType([*docs.select(*extra).schema.fields, *StructType.fromDDL("score double, predicted int").fields])
    schema, held = to_arrow_schema(out), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, size=PIECE_BYTES):
            s = held.value.scores(*flat.text_buffer(block.column("text")))
            columns = [*(block.column(c) for c in extra), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(*dict.fromkeys([*extra, "text"])).mapInArrow(run, out)
