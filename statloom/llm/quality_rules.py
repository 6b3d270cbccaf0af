"""Quality rules: statistics of each text, two plain rules, and an isolation forest over the statistics.

Statistics are counts of the whole text (``STATISTICS``), taken in NumPy over
blocks of texts. Lines and windows are compared by 64-bit hashes inside one text.

    n_words         words, ``[^\\x20\\x09-\\x0D]+``
    word_chars      code points in words
    n_symbols       characters of ``#*$%&|<>``
    n_dup_lines     \\n-split lines with a word that equal an earlier line
    n_repeat_words  words in 3-word windows found twice or more, the first included
    n_upper         A-Z

A text fails the base rules with fewer than 50 words, or if more than half of
its words are in repeated windows.

The isolation forest (``Forest``) sees three rates: code points a word, symbols a word
and A-Z a code point. Each is drawn towards the rate of all documents by the weight of
``PRIOR_WORDS`` words, since short texts scatter widely by chance alone. (Repeats are left to
the base rules: clean documents differ in them more than bad ones.) Each tree takes ``TREE_ROWS`` documents that pass the
base rules, and splits them at random values of random rates until each is
alone or the tree has its full depth. Documents that stand apart end after few
splits: the score is 2^(-mean path / expected path), near 1 for anomalies.
Trees draw from the documents of the smallest hashes of id and statistics, at
most ``TREES * TREE_ROWS`` of them: the subsampling is the method's own.

The threshold is calibrated over all labelled documents that pass the base
rules and are not held out (crc32 of doc_id as text, mod 5, is not 0): the lowest score
that at most ``CLEAN_LOSS`` of the documents with quality 1 reach. With
no labelled documents of both classes the forest rejects nothing.

NULL and blank texts have only zero statistics and fail the base rules. Rows are
judged one by one, so repeats need no rule; a row without a doc_id has no label. A
document with several labels has quality 1 only if all say so. Empty
tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm import flat
from statloom.session import ensure_checkpoint_dir

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (*BASE, "n_upper")
#: Counts behind the rates, and what each is counted against.
RATES = (("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_upper", "word_chars"))
#: Words of an average document that are added to every document's own.
PRIOR_WORDS = 50
#: Trees of the forest, and documents that each is grown from.
TREES = 128
TREE_ROWS = 256
SEED = 97
#: Share of labelled documents of quality 1 that the threshold may reject.
CLEAN_LOSS = 0.005
#: Steps of the score (0 to 1) in which labelled documents are counted.
STEPS = 4096
BLOCK_BYTES = 1 << 20

LINES = flat.word_rule([0x0A], lower=False)


def _bytes(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SYMBOLS = _bytes(b"#*$%&|<>")
UPPER = _bytes(bytes(range(0x41, 0x5B)))
#: Bytes that begin a code point, inside words.
WORD_CHARS = flat.SPACED.inside & ((np.arange(256) & 0xC0) != 0x80)


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many places of each row are marked."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), off))


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an equal, has an equal before it) of each key."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twin, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    twin[order[1:]] = same
    twin[order[:-1]] |= same
    return twin, later


def _own(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return flat.mix(hashes ^ (row.astype(np.uint64) * flat.ODD + np.uint64(SEED)))


def measure(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """``STATISTICS`` of each text of a block."""
    out = {name: _per_row(table[buf], off) for name, table in (("word_chars", WORD_CHARS), ("n_symbols", SYMBOLS), ("n_upper", UPPER))}
    words = flat.find_words(buf, off, flat.SPACED)
    out["n_words"] = np.diff(words.row_first)

    lines = flat.find_words(buf, off, LINES)
    filled = np.searchsorted(words.start, lines.start) < np.searchsorted(words.start, lines.end)
    row = lines.row[filled]
    _, later = _repeated(_own(lines.hash[filled], row))
    out["n_dup_lines"] = np.bincount(row[later], minlength=len(off) - 1)

    at, window = flat.window_hashes(words, 3, seed=71)
    row = words.row
    twin, _ = _repeated(_own(window, row[at]))
    first = at[twin]
    edges = np.bincount(first, minlength=len(row) + 1) - np.bincount(first + 3, minlength=len(row) + 1)[: len(row) + 1]
    covered = np.cumsum(edges[: len(row)]) > 0
    out["n_repeat_words"] = np.bincount(row[covered], minlength=len(off) - 1)
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``STATISTICS`` (long) of every whole text."""
    names = ["doc_id", *STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, size=BLOCK_BYTES):
            stats = measure(*flat.text_buffer(block.column("text")))
            yield pa.record_batch([block.column("doc_id").cast(pa.int64()), *(pa.array(stats[n].astype(np.int64)) for n in STATISTICS)], names)

    schema = ", ".join(f"{n} long" for n in names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def rates(columns: dict[str, np.ndarray], usual: dict[str, float]) -> np.ndarray:
    """The forest's view of the statistics: float64[documents, len(RATES)].

    ``usual`` has the mean of each statistic over all documents; a document
    counts as if ``PRIOR_WORDS`` words of the mean document stood in it too.
    """
    weight = PRIOR_WORDS / max(usual["n_words"], 1.0)
    c = {k: np.asarray(columns[k], np.float64) + weight * usual[k] for k in STATISTICS}
    return np.stack([c[count] / np.maximum(c[against], 1e-9) for count, against in RATES], axis=1)


# --- isolation forest ---


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree over n rows."""
    n = np.asarray(n, np.float64)
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + np.euler_gamma) - 2 * m / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays in heap order: node i has children 2 i + 1 and 2 i + 2."""

    def __init__(self, feature: np.ndarray, split: np.ndarray, path: np.ndarray, rows: int):
        self.feature, self.split, self.path, self.rows = feature, split, path, rows

    @classmethod
    def grow(cls, x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
        """Trees from ``rows`` rows of ``x`` each, drawn without replacement; no rows give no trees."""
        rng = np.random.default_rng(seed)
        rows = min(rows, len(x))
        depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
        size = (1 << (depth + 1)) - 1
        feature, split, path = np.full((trees, size), -1, np.int16), np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees if rows else 0):
            nodes = {0: x[rng.choice(len(x), rows, replace=False)]}
            for i in range(size):
                here = nodes.pop(i, None)
                if here is None:
                    continue
                level = (i + 1).bit_length() - 1
                low, high = here.min(axis=0), here.max(axis=0)
                wide = np.flatnonzero(high > low)
                if level == depth or not len(wide):
                    path[t, i] = level + expected_path(len(here))
                    continue
                f = rng.choice(wide)
                cut = rng.uniform(low[f], high[f])
                left = here[:, f] <= cut
                feature[t, i], split[t, i] = f, cut
                nodes[2 * i + 1], nodes[2 * i + 2] = here[left], here[~left]
        return cls(feature, split, path, rows)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row: 2^(-mean path / expected path); 0.5 where nothing is known."""
        usual = float(expected_path(self.rows))
        if usual <= 0:
            return np.full(len(x), 0.5)
        total, every = np.zeros(len(x)), np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 2
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                f = feature[node]
                down = 2 * node + 1 + (x[every, f] > split[node])
                node = np.where(f >= 0, down, node)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / usual)


class Model:
    """A forest, the mean statistics its rates lean on, and the score from which a document is rejected."""

    def __init__(self, forest: Forest, usual: dict[str, float], threshold: float):
        self.forest, self.usual, self.threshold = forest, usual, threshold


def _scored(stats: DataFrame, forest: Forest, usual: dict[str, float]) -> DataFrame:
    """``stats`` (doc_id and STATISTICS) with ``score``."""
    held = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rates({n: batch.column(n).to_numpy() for n in STATISTICS}, usual)
            yield pa.record_batch([*batch.columns, pa.array(held.value.scores(x))], [*batch.schema.names, "score"])

    names = ["doc_id", *STATISTICS]
    return stats.select(*names).mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", score double")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def _sample(stats: DataFrame, n: int, limit: int) -> DataFrame:
    """The ``limit`` rows of smallest hash, out of those below a hash that about twice as many of the ``n`` rows have: tasks send few more than needed."""
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", *STATISTICS), 2)
    below = stats.where(mark <= int(min(1.0, 2 * limit / max(n, 1)) * (1 << 62)))
    return below.orderBy(mark, "doc_id", *STATISTICS).limit(limit)


def train(stats: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS) -> Model:
    """Forest and threshold from the statistics of all documents and their labels (doc_id, quality)."""
    passing = stats.where(~base_failed())
    usual = passing.agg(F.count("*").alias("n"), *(F.avg(n).alias(n) for n in STATISTICS)).first().asDict()
    usual = {n: v or 0.0 for n, v in usual.items()}
    sample = _sample(passing, usual.pop("n"), TREES * TREE_ROWS).toPandas()
    forest = Forest.grow(rates({n: sample[n].to_numpy() for n in STATISTICS}, usual))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).alias("step")
    counted = _scored(passing.join(known.select("doc_id"), "doc_id", "left_semi"), forest, usual).join(known, "doc_id")
    count = np.zeros((2, STEPS), np.int64)
    for quality, at, n in counted.groupBy((F.col("quality") >= 1).cast("int"), step).count().collect():  # 2 * STEPS rows at most
        count[quality, at] = n
    return Model(forest, usual, threshold_of(count[0], count[1], clean_loss))


def threshold_of(bad: np.ndarray, clean: np.ndarray, clean_loss: float) -> float:
    """Lowest step from which at most ``clean_loss`` of the clean documents lie; none (2.0) without documents of both classes."""
    if not bad.sum() or not clean.sum():
        return 2.0
    beyond = np.cumsum(clean[::-1])[::-1]
    return int(np.flatnonzero(np.append(beyond, 0) <= clean_loss * clean.sum())[0]) / len(clean)


def judge(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with score, base_failed and kept (passes the base rules, and its score is below the threshold)."""
    done = _scored(stats, model.forest, model.usual).withColumn("base_failed", base_failed())
    return done.withColumn("kept", ~F.col("base_failed") & (F.col("score") < model.threshold))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed, kept and score of every document."""
    ensure_checkpoint_dir(docs.sparkSession)
    stats = statistics(docs).checkpoint()  # a few numbers a document; read by the fit, the calibration and the verdict
    return judge(stats, train(stats, labels)).select("doc_id", *BASE, "base_failed", "kept", "score")
