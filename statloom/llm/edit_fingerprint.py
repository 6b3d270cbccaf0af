"""Document fingerprints by a randomised edit embedding.

A text is walked with random bits that all texts share: at step t the current
character is emitted, and the shared bit of (t, character) says whether the
walk goes on to the next character. Two texts that differ by few edits soon
walk in step again behind each edit, so their emitted strings differ in few
places: edit distance becomes Hamming distance.

The fingerprint samples the emitted string at ``SLOTS`` shared random steps,
one bit of the character each. A slot's step is the position of least random
priority among the steps of the walk; texts of similar length share most of
their steps, and a longer text moves a slot only to steps the shorter one does
not have. Every position of a text is equally likely to be sampled.

Near documents (``near_groups``): a band is a random choice of the fingerprint's
bits; documents that agree in all bits of a band are candidates, and the full
fingerprints decide. A band has a few bits more than the number of fingerprints
has, so that chance candidates grow with the rows and not with their square;
there are as many bands as it takes to meet a pair at the threshold with
probability ``RECALL`` (pairs above it with more). Bands are worked through
``PASS_BANDS`` at a time, and only (band and bits, node) go through a shuffle,
added up before it: the fingerprints are fetched for candidates alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import flat
from statloom.llm.components import components
from statloom.llm.shared import Tables, text_groups, tidy

SLOTS = 512
#: The shared bits repeat after this many steps.
PERIOD = 1 << 12
CLASSES = 256
#: Characters that are walked at once.
BLOCK_CHARS = 4 << 20
#: With this many texts left, they are walked one after the other.
FEW = 12
#: Texts of one range of documents.
RANGE_BYTES = 32 << 20


def _stays() -> np.ndarray:
    """[class, step]: how many steps a character of the class is emitted from that step on."""
    bits = (flat.seeded(PERIOD * CLASSES, 601) >> np.uint64(63)).astype(bool).reshape(CLASSES, PERIOD)
    bits[:, -1] = True  # every run ends within the period
    out, run = np.empty((CLASSES, PERIOD), np.int64), np.zeros(CLASSES, np.int64)
    for t in range(2 * PERIOD - 1, -1, -1):
        run = np.where(bits[:, t % PERIOD], 1, run + 1)
        if t < PERIOD:
            out[:, t] = run
    return np.minimum(out, 255).astype(np.uint8)


def _records() -> np.ndarray:
    """[slot, k]: the steps at which a slot's least priority so far occurs, padded with a huge step."""
    last, out = np.zeros(SLOTS), []
    for k in range(96):
        out.append(last.copy())
        chance = ((flat.seeded(SLOTS, 700 + k) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        last = np.minimum(np.floor((last + 1) / chance), 2.0**50)
        last = np.maximum(last, out[-1] + 1)
    return np.stack(out, 1).astype(np.int64)


class Walker:
    """The shared random tables, built once in each Python worker."""

    def __init__(self):
        self.stays = _stays().ravel()
        self.stays_bytes = self.stays.tobytes()
        self.records = _records()
        self.slot_bits = (flat.seeded(SLOTS * CLASSES, 801) >> np.uint64(63)).astype(np.uint8).reshape(SLOTS, CLASSES)

    def codes(self, chars: np.ndarray) -> np.ndarray:
        """Places of characters (code points) in the table of stays, at step 0."""
        return ((chars * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.int32) * PERIOD

    def walk(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, step: np.ndarray) -> np.ndarray:
        """For every character the step behind it. Texts are ranges of ``codes`` and begin at ``step``."""
        out = np.zeros(len(codes), np.int64)
        order = np.argsort(-size, kind="stable")
        start, size, now = start[order], size[order], step[order].astype(np.int64)
        left = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")  # texts with more than i characters
        many = int(np.searchsorted(-left, -FEW, "left"))
        for i in range(many):
            k = left[i]
            at = start[:k] + i
            now[:k] += self.stays[codes[at] + (now[:k] & (PERIOD - 1))]
            out[at] = now[:k]
        stays, mask = self.stays_bytes, PERIOD - 1
        for a, n, t in zip(start.tolist(), size.tolist(), now.tolist(), strict=True):
            if n <= many:
                break
            steps = []
            for c in codes[a + many : a + n].tolist():
                t += stays[c + (t & mask)]
                steps.append(t)
            out[a + many : a + n] = steps
        return out

    def sample(self, codes: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Fingerprint (packed bits) of one text from its characters and the steps behind them."""
        if not len(codes):
            return np.zeros(SLOTS // 8, np.uint8)
        row = (self.records < steps[-1]).sum(axis=1) - 1
        at = np.searchsorted(steps, self.records[np.arange(SLOTS), row], "right")
        return np.packbits(self.slot_bits[np.arange(SLOTS), codes[at] // PERIOD])


_WALKER: list[Walker] = []


def walker() -> Walker:
    if not _WALKER:
        _WALKER.append(Walker())
    return _WALKER[0]


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places that the agreement of two fingerprints speaks for: 1 if equal, 0 if unrelated."""
    agree = 1 - int(np.bitwise_count(a ^ b).sum()) / SLOTS
    return max(0.0, 2 * agree - 1)


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last half replaced by the beginning of the next one, and how much of it was kept."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half], len(text) - half


def fingerprints(texts: list[str], following: list[str | None]) -> list[tuple[np.ndarray, str | None, np.ndarray | None]]:
    """(fingerprint, edited text, its fingerprint) of each text; without a next text the latter two are None."""
    own = walker()
    chars = [_chars(t) for t in texts]
    size = np.array([len(c) for c in chars], np.int64)
    start = np.cumsum(size) - size
    codes = own.codes(np.concatenate([*chars, np.zeros(0, np.uint32)]))
    steps = own.walk(codes, start, size, np.zeros(len(texts), np.int64))
    # edited texts walk like the originals up to the cut: only what follows is walked anew
    change = [(None, 0) if f is None else edited(t, f) for t, f in zip(texts, following, strict=True)]
    tails = [np.zeros(0, np.uint32) if e is None else _chars(e[cut:]) for e, cut in change]
    tail_size = np.array([len(c) for c in tails], np.int64)
    tail_start = np.cumsum(tail_size) - tail_size
    tail_codes = own.codes(np.concatenate([*tails, np.zeros(0, np.uint32)]))
    begin = np.array([steps[a + cut - 1] if cut else 0 for a, (_, cut) in zip(start.tolist(), change, strict=True)], np.int64)
    tail_steps = own.walk(tail_codes, tail_start, tail_size, begin)
    out = []
    for k, (e, cut) in enumerate(change):
        a, n, ta, tn = start[k], size[k], tail_start[k], tail_size[k]
        mark = own.sample(codes[a : a + n], steps[a : a + n])
        if e is None:
            out.append((mark, None, None))
        else:
            both = [np.concatenate([x[a : a + cut], y[ta : ta + tn]]) for x, y in ((codes, tail_codes), (steps, tail_steps))]
            out.append((mark, e, own.sample(*both)))
    return out


_DONE = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "place", "text"]
_DONE_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, place string, text string"
)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _DONE)


def _finish(doc_id, text: str, change: str, mark: np.ndarray, mark2: np.ndarray, next_mark: np.ndarray) -> tuple:
    return (doc_id, len(text), hashlib.sha256(change.encode("utf-8")).hexdigest(), mark.tobytes().hex(), mark2.tobytes().hex(),
            likeness(mark, mark2), likeness(mark, next_mark), None, None, None)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range, each with its next row; the range's first and last texts are passed on for the ranges around."""
    from pyspark import TaskContext

    part, last = TaskContext.get().partitionId(), None
    for block in flat.blocks(batches, size=BLOCK_CHARS):
        ids, texts = block.column("doc_id").to_pylist(), [t or "" for t in block.column("text").to_pylist()]
        if last is None:
            yield _table([(ids[0], None, None, None, None, None, None, part, "first", texts[0])])
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        made = fingerprints(texts, [*texts[1:], None])
        yield _table([_finish(i, t, c, m, m2, n[0]) for i, t, (m, c, m2), n in zip(ids, texts, made, made[1:], strict=False)])
        last = (ids[-1], texts[-1])
    if last is not None:
        yield _table([(last[0], None, None, None, None, None, None, part, "last", last[1])])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of rows that come with the next text."""
    for block in flat.blocks(batches, size=BLOCK_CHARS):
        ids, texts, follow = (block.column(c).to_pylist() for c in ("doc_id", "text", "next_text"))
        made = fingerprints([*texts, *follow], [*follow, *[None] * len(follow)])
        yield _table([_finish(i, t, c, m, m2, made[len(texts) + k][0]) for k, (i, t, (m, c, m2)) in enumerate(zip(ids, texts, made, strict=False))])


def edit_report(docs: DataFrame, tables: Tables | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text. What is written on the way goes to ``tables``, for the caller to drop.

    The edited text of a document is its text whose last floor(n/2) code
    points are replaced by the first as many (or all) of the next document, in
    descending doc_id; after the last document comes the first.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint
    (hexadecimal), near_edited and near_next. NULL texts are empty texts; the
    fingerprint of an empty text is all zeros. NULL doc_ids come last; rows
    that share a doc_id follow each other by text. A single row is its own
    next document. Other columns are ignored; no rows give no rows.

    Texts cross the shuffle once, dealt by ranges of doc_id. Only the first
    and last text of each range are joined with their neighbours afterwards.
    """
    tables = tables or Tables(docs.sparkSession, "edit-fingerprint")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.col("text")]
    ranges = own.repartitionByRange(text_groups(own, size=RANGE_BYTES), F.desc_nulls_last("doc_id")).sortWithinPartitions(*order)
    made = tables.write(ranges.mapInArrow(_with_next, _DONE_DDL), "rows")
    inner = made.where("place IS NULL")
    firsts = made.where("place = 'first'")
    parts = firsts.select("part")  # one narrow row per range
    lead = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    ends = made.where("place = 'last'").select("part", "doc_id", "text").join(parts.select("part", lead.alias("next_part")), "part")
    ends = ends.join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")
    outer = ends.select("doc_id", "text", "next_text").mapInArrow(_pairs, _DONE_DDL)
    return inner.unionByName(outer).drop("part", "place", "text")


# ------------------------------------------------------------------ near documents

NEAR = 0.75
#: Probability that a pair of likeness ``near`` shares a band.
RECALL = 0.95
#: Bands whose buckets are shuffled at once.
PASS_BANDS = 32
#: Buckets of three nodes or more up to which they are looked up in each task instead of by a shuffle.
LOOKED_UP = 1_000_000


def band_plan(nodes: int, near: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a band, number of bands) for so many different fingerprints."""
    bits = min(48, max(12, math.ceil(math.log2(max(nodes, 2))) + 4))
    same = round(SLOTS * (1 + near) / 2)  # equal bits of a pair at the threshold
    chance = math.prod((same - i) / (SLOTS - i) for i in range(bits)) if same > bits else 0.0
    if chance <= 0:
        raise ValueError("near is too low for bands of this length")
    return bits, 1 if chance >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def _band_bits(band: int, bits: int) -> np.ndarray:
    """Which bits of a fingerprint make the band."""
    return np.argsort(flat.seeded(SLOTS, 9001 + band), kind="stable")[:bits]


def _buckets(bands: range, bits: int):
    """Rows (bucket, node) for each of some bands; a bucket is the band's number and its bits."""
    chosen = [_band_bits(b, bits) for b in bands]
    weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.frombuffer(b"".join(batch.column("mark").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            every = np.unpackbits(marks, axis=1)
            for band, at in zip(bands, chosen, strict=True):
                value = (every[:, at].astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
                key = (np.uint64(band) << np.uint64(bits)) | value
                yield pa.record_batch([pa.array(key.view(np.int64)), batch.column("node")], ["bucket", "node"])

    return run


def _verified(near: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("left", "right"))
            wrong = np.bitwise_count(a ^ b).sum(axis=1)
            yield batch.select(["u", "v"]).filter(pa.array(1 - 2 * wrong / SLOTS >= near))

    return run


def _word(k: int) -> Column:
    """64 bits of a fingerprint."""
    return F.conv(F.hex(F.substring("mark", 8 * k + 1, 8)), 16, -10).cast("long")


def _links(pairs: DataFrame, nodes: DataFrame, near: float) -> DataFrame:
    """The pairs (u, v) of nodes whose fingerprints are alike."""
    joined = pairs.join(nodes.select(F.col("node").alias("u"), F.col("mark").alias("left")), "u")
    joined = joined.join(nodes.select(F.col("node").alias("v"), F.col("mark").alias("right")), "v")
    return joined.select("u", "v", "left", "right").mapInArrow(_verified(near), "u long, v long")


def near_groups(marks: DataFrame, near: float = NEAR, keep: tuple[str, ...] = (), recall: float = RECALL) -> DataFrame:
    """Groups of documents whose fingerprints are alike.

    ``marks`` has doc_id and fingerprint (hexadecimal). Documents with one fingerprint are one
    node (named by a 64-bit hash). Candidates share all bits of a band; they are linked if their
    likeness is ``near`` or more. In every bucket (the nodes that share a band) each node is
    first verified against the least and the greatest one, which joins large groups with few pairs; then, in buckets that still hold nodes of
    different groups, the pairs between groups are. A pair at the threshold is met with
    probability ``recall``, a closer one with more.

    Returns doc_id, fingerprint, the columns in ``keep`` and group_id, the
    smallest doc_id of the group. NULL fingerprints form no group (group_id is the own doc_id);
    an empty table gives no rows. A column of ``keep`` may not be named group_id.
    """
    with tidy(marks.sparkSession):
        return _near_groups(marks, near, keep, recall)


def _near_groups(marks: DataFrame, near: float, keep: tuple[str, ...], recall: float) -> DataFrame:
    tables = Tables(marks.sparkSession, "near-groups")
    named = marks.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    nodes = tables.write(named.select(F.xxhash64("fingerprint").alias("node"), F.unhex("fingerprint").alias("mark"), "least", "copies"), "nodes")
    bits, bands = band_plan(nodes.count(), near, recall)
    links, crowded = [], []
    for first in range(0, bands, PASS_BANDS):
        rows = nodes.select("node", "mark").mapInArrow(_buckets(range(first, min(bands, first + PASS_BANDS)), bits), "bucket long, node long")
        shared = rows.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).where("n > 1")
        shared = tables.write(shared, f"shared-{first}")
        large = shared.where("n > 2").select("bucket", "low", "high")
        if large.limit(LOOKED_UP + 1).count() <= LOOKED_UP:
            large = F.broadcast(large)  # three numbers a bucket
        met = tables.write(rows.join(large, "bucket"), f"met-{first}")
        pairs = shared.where("n = 2").select(F.col("high").alias("u"), F.col("low").alias("v"))
        pivots = met.select(F.col("node").alias("u"), F.explode(F.array("low", "high")).alias("v")).where("u != v")
        pairs = pairs.unionByName(pivots).distinct()
        links.append(tables.write(_links(pairs, nodes, near), f"links-{first}"))
        tables.drop(f"shared-{first}")
        crowded.append(met.select("bucket", "node"))
    group = tables.write(components(_fewer(_union(links))), "components")
    more = []
    for k, rows in enumerate(crowded):  # two nodes of a bucket of two have met
        own = rows.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
        own = own.join(mixed, "bucket").join(nodes.select("node", *(_word(k).alias(f"w{k}") for k in range(SLOTS // 64))), "node")
        own = tables.write(own, f"mixed-{k}")
        other = own.select(*(F.col(c).alias(c if c == "bucket" else f"{c} of other") for c in own.columns))
        wrong = sum((F.bit_count(F.col(f"w{w}").bitwiseXOR(F.col(f"w{w} of other"))) for w in range(SLOTS // 64)), F.lit(0))
        alike = (F.col("component") < F.col("component of other")) & (wrong <= math.floor(SLOTS * (1 - near) / 2))
        pairs = own.join(other, "bucket").where(alike).select(F.col("node").alias("u"), F.col("node of other").alias("v"))
        more.append(tables.write(pairs.distinct(), f"more-{k}"))
        tables.drop(f"mixed-{k}")
    if not _union(more).isEmpty():
        group = tables.write(components(_fewer(_union([*links, *more]))), "more-components")
    done = nodes.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    size = done.groupBy("component").agg(F.min("least").alias("group_id"), F.sum("copies").alias("members")).where("members > 1")
    named = done.join(size, "component").select(F.lower(F.hex("mark")).alias("fingerprint"), "group_id")
    out = marks.select("doc_id", "fingerprint", *keep).join(named, "fingerprint", "left").select(
        "doc_id", "fingerprint", *keep, F.coalesce("group_id", "doc_id").alias("group_id")
    )
    out = out.checkpoint()
    tables.drop()
    return out


def _fewer(links: DataFrame) -> DataFrame:
    """Links (u, v) that connect the same nodes: each u with its least partner, and its other partners with that one.

    Pivots are few, so the latter are few different pairs however often they occur.
    """
    least = links.withColumn("m", F.min("v").over(Window.partitionBy("u")))  # a node has two pivots a band at most
    near = least.select("u", F.col("m").alias("v")).distinct()
    return near.unionByName(least.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def near_report(docs: DataFrame, near: float = NEAR) -> DataFrame:
    """``edit_report`` with the group of each document."""
    tables = Tables(docs.sparkSession, "edit-fingerprint")
    done = edit_report(docs, tables)
    out = near_groups(done, near, keep=tuple(c for c in done.columns if c not in ("doc_id", "fingerprint"))).select(*done.columns, "group_id")
    tables.drop()
    return out
