"""Language ID by multilingual mixture inference.

Each language has a table of byte 4-gram log-probabilities (hashed, smoothed),
learnt from labelled documents. A document is a mixture of languages: every
word has a likelihood under each language, and expectation-maximisation finds
the language proportions that explain the document's words best. The language
set is chosen by penalised likelihood: of the nested sets that the proportions
suggest (the strongest language, the two strongest, ...) the one of largest
log-likelihood minus ``PENALTY`` * log(words) per language.

Tables are counted in Spark over a sample of about ``PER_LANGUAGE`` documents
of each language (those of smallest hash of doc_id). Texts are read whole and
are never shuffled; the tables (fixed size) are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm import flat

TABLE_BITS = 18
PER_LANGUAGE = 3000
SMOOTH = 0.3
#: Overlapping 4-grams count double; words are weighed by this power of their likelihood.
TEMPER = 0.5
PENALTY = 2.0
ROUNDS = 12
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[0x80:] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_PLAIN = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


class Grams:
    """Words of a block and the hashed 4-grams of each, a space on either side included."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        rows = len(off) - 1
        row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(off))
        text = np.full(len(buf) + rows + 4, 0x20, np.uint8)
        text[np.arange(len(buf)) + row + 1] = _PLAIN[buf]
        inside = text != 0x20
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = change[::2], change[1::2]
        wide = text.astype(np.uint32)
        code = wide[:-3] | (wide[1:-2] << np.uint32(8)) | (wide[2:-1] << np.uint32(16)) | (wide[3:] << np.uint32(24))
        count = np.maximum(end - start - 1, 1)
        self.first = np.cumsum(count) - count
        word = np.repeat(np.arange(len(start)), count)
        at = np.arange(len(word)) - self.first[word] + start[word] - 1
        self.place = ((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)
        self.word_row = np.searchsorted(off[:-1] + np.arange(rows) + 1, start, "right") - 1
        # rows may be empty: the words of a row are a range
        self.row_first = np.searchsorted(self.word_row, np.arange(rows + 1))


class Mixture:
    """Language proportions of documents under fixed 4-gram tables (log-probabilities [place, language])."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def likelihoods(self, grams: Grams) -> np.ndarray:
        """Per word: relative likelihood under each language (the best has 1)."""
        if not len(grams.first):
            return np.zeros((0, len(self.languages)))
        total = np.add.reduceat(self.table[grams.place], grams.first, axis=0) * TEMPER
        return np.exp(total - total.max(axis=1, keepdims=True)).astype(np.float64) + 1e-12

    @staticmethod
    def proportions(like: np.ndarray, row: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for many documents at once: (proportions, log-likelihood). Every document has a word at least."""
        count = np.diff(np.append(first, len(row)))[:, None]
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            part = like * share[row]
            part /= part.sum(axis=1, keepdims=True)
            share = np.add.reduceat(part, first, axis=0) / count
        return share, np.add.reduceat(np.log((like * share[row]).sum(axis=1)), first)

    def infer(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the chosen language set of every row, and the rows' word counts (0: nothing to read)."""
        grams = Grams(buf, off)
        out = np.zeros((len(off) - 1, len(self.languages)))
        words = np.diff(grams.row_first)
        some = np.flatnonzero(words)
        if not len(some) or not self.languages:
            return out, words
        like = self.likelihoods(grams)
        n, size = len(some), words[some]
        row, first = np.repeat(np.arange(n), size), np.cumsum(size) - size
        share, full = self.proportions(like, row, first, np.ones((n, len(self.languages))))
        order = np.argsort(-share, axis=1, kind="stable")
        cost = PENALTY * np.log(size + 1)
        alone = np.add.reduceat(np.log(like), first, axis=0)
        best_at = alone.argmax(axis=1)
        best = np.zeros_like(share)
        best[np.arange(n), best_at] = 1
        value = alone[np.arange(n), best_at] - cost
        # the full mixture bounds every subset: only where it gains enough can a larger set win
        open_ = np.flatnonzero(full - 2 * cost > value)
        for k in range(2, len(self.languages) + 1):
            if not len(open_):
                break
            allowed = np.zeros((len(open_), len(self.languages)))
            np.put_along_axis(allowed, order[open_, :k], 1, axis=1)
            pick = np.isin(row, open_) if len(open_) < n else slice(None)
            length = size[open_]
            s, v = self.proportions(like[pick], np.repeat(np.arange(len(open_)), length), np.cumsum(length) - length, allowed)
            v = v - k * cost[open_]
            better = v > value[open_]
            best[open_[better]], value[open_[better]] = s[better], v[better]
        out[some] = best
        return out, words


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def train(docs: DataFrame) -> Mixture:
    """4-gram tables of the languages of documents that are not held out; NULL languages and texts are left out.

    At most about ``PER_LANGUAGE`` documents of a language are read: those
    whose hash of doc_id is below PER_LANGUAGE / (documents of the language).
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).select("doc_id", "lang", "text")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = sorted(counts)
    if not languages:
        return Mixture([], np.zeros((1 << TABLE_BITS, 0), np.float32))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, PER_LANGUAGE / counts[k]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << TABLE_BITS), np.int64)
        for block in flat.blocks(batches, size=1 << 20):
            grams = Grams(*flat.text_buffer(block.column("text")))
            lang = np.searchsorted(languages, block.column("lang").to_pylist())
            word = np.repeat(np.arange(len(grams.first)), np.diff(np.append(grams.first, len(grams.place))))
            key = lang[grams.word_row[word]] * (1 << TABLE_BITS) + grams.place
            total += np.bincount(key, minlength=total.size).reshape(total.shape)
        some = [k for k in range(len(languages)) if total[k].any()]
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array([flat.narrow(total[k]) for k in some], pa.binary())], ["lang", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(flat.wide(x) for x in table.column("counts").to_pylist())
        return pa.table({"lang": table.column("lang")[:1], "counts": pa.array([flat.narrow(total)], pa.binary())})

    parts = known.where(place < F.element_at(share, F.col("lang"))).select("lang", "text").mapInArrow(run, "lang int, counts binary")
    table = np.zeros((1 << TABLE_BITS, len(languages)))
    for r in parts.groupBy("lang").applyInArrow(add, "lang int, counts binary").collect():  # one row per language
        table[:, r.lang] = flat.wide(r.counts)
    table = np.log((table + SMOOTH) / (table.sum(axis=0) + SMOOTH * (1 << TABLE_BITS)))
    return Mixture(languages, table.astype(np.float32))


def predict(docs: DataFrame, model: Mixture, keep: tuple[str, ...] = ()) -> DataFrame:
    """Language of every whole text: doc_id, the columns in ``keep``, lang_pred, score and languages.

    lang_pred is the language of largest proportion in the chosen set, score
    its proportion, languages the chosen set, strongest first. NULL texts,
    texts without a letter and tables without any labelled language give
    ``und`` with score 0 and no languages. Rows are independent of each other.
    """
    extra = list(dict.fromkeys(["doc_id", *keep]))
    out = StructType([*docs.select(*extra).schema.fields, *StructType.fromDDL("lang_pred string, score double, languages array<string>").fields])
    schema, held = to_arrow_schema(out), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for block in flat.blocks(batches, size=1 << 20):
            buf, off = flat.text_buffer(block.column("text"))
            share, words = model.infer(buf, off)
            ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[buf] & (buf < 0x80))])
            lettered = ascii_letters[off[1:]] > ascii_letters[off[:-1]]
            for r in np.flatnonzero(~lettered & (words > 0)):  # only characters beyond ASCII: are there letters?
                lettered[r] = any(map(str.isalpha, buf[off[r] : off[r + 1]].tobytes().decode("utf-8")))
            lettered &= share.any(axis=1) if share.shape[1] else False
            order = np.argsort(-share, axis=1, kind="stable")
            pred, score, sets = [], [], []
            for r, ok in enumerate(lettered.tolist()):
                own = [k for k in order[r].tolist() if share[r, k] > 0] if ok else []
                sets.append([model.languages[k] for k in own])
                pred.append(sets[-1][0] if own else UNKNOWN)
                score.append(float(share[r, own[0]]) if own else 0.0)
            columns = [*(block.column(c) for c in extra), pa.array(pred), pa.array(np.clip(score, 0, 1)), pa.array(sets, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(*dict.fromkeys([*extra, "text"])).mapInArrow(run, out)
