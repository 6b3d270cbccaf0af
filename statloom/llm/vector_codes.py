"""Product quantisation of vectors, with nearest entries found by Orchard's search.

A component x counts as the integer floor(256 * x). Vectors are cut into equal
consecutive parts; each part position has a codebook of entries, and a part is
stored as the index of its nearest entry (squared Euclidean distance, the lower
index of a tie).

Orchard's search keeps for every entry the list of the others, sorted by
distance. A part starts at some entry and goes down that entry's list; an entry
it has not met is measured and marked, and a nearer one makes it jump to that
entry's list. It stops where the list's distance exceeds twice the current one:
by the triangle inequality nothing beyond can be as near. The search is exact.
All vectors of a block take their steps together in NumPy.

Each training round is one pass over the vectors: a task adds up counts and
sums per entry (a table of fixed size), Spark adds up the tasks' tables, and
the driver divides. Codebooks (parts x entries x width integers) are the only
thing collected or broadcast.

Rows whose vector is NULL or holds NULL or non-finite components are left out.
Vectors shorter than the longest, and those whose length the parts don't
divide, are padded with zeros. Rows without an id seed a codebook only after
all others. Repeated rows count as often as they come; equal rows get equal
codes. An empty table gives empty codebooks and no rows. Integers so large that
a squared distance would not fit a long stop the job with OverflowError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm.shared import attach
from statloom.session import ensure_checkpoint_dir

SCALE = 256
#: Vectors that take their steps together.
BLOCK_ROWS = 8192


class Codebook:
    """Entries of one part position with their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # int64[k, width]
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        np.fill_diagonal(apart, -1)  # an entry comes first in its own list, before equal ones
        self.list = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.far = np.take_along_axis(apart, self.list, axis=1)
        total = entries.sum(1)
        self.by_total = np.argsort(total, kind="stable")
        self.total = total[self.by_total]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of each row of ``x`` (int64[n, width])."""
        n, k = len(x), len(self.entries)
        at = np.clip(np.searchsorted(self.total, x.sum(1)), 0, k - 1)
        current = self.by_total[at]  # any start is right; one of like component sum is often near
        best = ((x - self.entries[current]) ** 2).sum(1)
        marked = np.zeros((n, k), bool)
        marked[np.arange(n), current] = True
        step = np.zeros(n, np.int64)
        active = np.arange(n) if k > 1 else np.zeros(0, np.int64)
        while len(active):
            active = active[step[active] < k - 1]
            c, p = current[active], step[active]
            going = self.far[c, p] <= 4 * best[active]
            active, met = active[going], self.list[c, p][going]
            step[active] += 1
            fresh = ~marked[active, met]
            who, met = active[fresh], met[fresh]
            marked[who, met] = True
            d = ((x[who] - self.entries[met]) ** 2).sum(1)
            nearer = (d < best[who]) | ((d == best[who]) & (met < current[who]))
            who = who[nearer]
            current[who], best[who], step[who] = met[nearer], d[nearer], 0
        return current, best


class Codebooks:
    """One codebook for each part position; ``values`` is int64[parts, entries, width]."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.parts, _, self.width = values.shape
        self.books = [Codebook(v) for v in values]

    def __reduce__(self):
        return Codebooks, (self.values,)

    def sha256(self) -> str:
        """Digest of all components in decimal by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes uint8[n, parts], distances int64[n, parts]) of integer vectors."""
        code, error = np.zeros((len(x), self.parts), np.uint8), np.zeros((len(x), self.parts), np.int64)
        for p, book in enumerate(self.books):
            code[:, p], error[:, p] = book.nearest(x[:, p * self.width : (p + 1) * self.width])
        return code, error


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    return vectors.where(F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))))


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(256 * x) of a list column as int64[n, dim], padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(values) and np.abs(values).max() > np.sqrt(2.0**59 / max(dim, 1)):
        raise OverflowError("vector components are too large for exact squared distances in a long")
    out = np.zeros((len(length), dim), np.int64)
    out[np.arange(dim) < length[:, None]] = values.astype(np.int64)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, *, id_column: str = "vec_id", column: str = "embedding") -> Codebooks:
    """Codebooks after ``rounds`` rounds over all usable vectors.

    They start as the parts of the ``entries`` (256 at most) smallest ids; in a
    round every entry becomes the componentwise floor of the mean of its
    parts, and an entry nobody chose stays.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a part's code is one byte: 1 to 256 entries")
    rows = usable(vectors.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("v")), "v").select("id", "v")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    ids = [r.id for r in rows.where("id IS NOT NULL").select("id").orderBy("id").limit(entries).collect()]  # narrow rows first
    early = rows.where(F.col("id") <= ids[-1]) if len(ids) == entries else rows
    seeds = early.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # 256 rows at most
    first = integers(pa.array([r.v for r in seeds], pa.list_(pa.float64())), parts * width)
    books = Codebooks(first.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy())
    for _ in range(rounds if seeds else 0):
        books = _next(rows, books)
    return books


def _next(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one more round."""
    parts, k, width = books.values.shape
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), np.int64)  # sums, and last the count
        for batch in _slices(batches):
            x = integers(batch.column(0), parts * width)
            code, _ = held.value.assign(x)
            for p in range(parts):
                np.add.at(total[p, :, :width], code[:, p], x[:, p * width : (p + 1) * width])
                total[p, :, width] += np.bincount(code[:, p], minlength=k)
        used = np.flatnonzero(np.repeat(total[:, :, width] > 0, width + 1))
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total.ravel()[used], pa.int64())], ["place", "total"])

    sums = rows.select("v").mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.zeros(parts * k * (width + 1), np.int64)
    for place, value in sums.collect():  # parts * entries * (width + 1) rows at most
        total[place] = value
    held.destroy()
    total = total.reshape(parts, k, width + 1)
    count = total[:, :, width:]
    return Codebooks(np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books.values))


def encode(vectors: DataFrame, books: Codebooks, *, keep: tuple[str, ...] = (), column: str = "embedding") -> DataFrame:
    """The columns in ``keep``, ``code`` (binary, a byte for each part) and ``error`` (squared distance over all parts) of every usable row.

    A column of ``keep`` that is named like one of the two new ones is refused.
    """
    if {"code", "error"} & set(keep):
        raise ValueError("keep names a column that encode makes")
    if not books.values.shape[1]:
        return vectors.where("false").select(*keep, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    out = StructType([*vectors.select(*keep).schema.fields, *StructType.fromDDL("code binary, error long").fields])
    schema, held = to_arrow_schema(out), vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in _slices(batches):
            code, error = own.assign(integers(batch.column(len(keep)), own.parts * own.width))
            codes = pa.Array.from_buffers(pa.binary(own.parts), len(code), [None, pa.py_buffer(np.ascontiguousarray(code))])
            columns = [*batch.columns[: len(keep)], codes, pa.array(error.sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    vector = F.col(column).cast("array<double>").alias("vector of this row")
    return usable(vectors, column).select(*keep, vector).mapInArrow(run, out)


def decode(codes: DataFrame, books: Codebooks, column: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the vector its code stands for (components entry / 256)."""
    held = codes.sparkSession.sparkContext.broadcast(books)
    out = StructType([*codes.schema.fields, *StructType.fromDDL("decoded array<double>").fields])
    schema, at = to_arrow_schema(out), codes.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = held.value.values
        for batch in _slices(batches):
            code = np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint8).reshape(batch.num_rows, values.shape[0])
            x = values[np.arange(values.shape[0]), code].reshape(batch.num_rows, -1) / SCALE
            listed = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, listed], schema, strict=True)], schema=schema)

    return codes.mapInArrow(run, out)


def code_report(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code (hex), error, label_error (error over equal labels, NULLs together) and the codebooks' digest."""
    ensure_checkpoint_dir(vectors.sparkSession)
    books = train(vectors, parts, entries, rounds)
    coded = encode(vectors, books, keep=("vec_id", "label")).checkpoint()
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).checkpoint()
    done = attach(coded, by_label, ["label"], F.col("vec_id"))
    return done.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
