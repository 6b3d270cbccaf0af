"""Toxicity: n-grams of characters, ratios and scores against plain loops; the rows of the fit."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from statloom.llm import flat, toxicity

MASK = (1 << 32) - 1
TEXTS = ["", "a", None, "Hello, WORLD hello world", "漢字かな交じり文 🙂🙂 ünï", "x" * 40, " ", "日本語" * 30, "", "tail é"]


def _place(gram):
    """Table place of an n-gram, step by step."""
    h, power = 0, 1
    for c in gram:
        x = ((c * 0x9E3779B1 & MASK) ^ ((c * 0x9E3779B1 & MASK) >> 15)) * 0x85EBCA6B & MASK
        h = (h + (x ^ (x >> 13)) * power) & MASK
        power = power * 0x9E3779B1 & MASK
    h = (h ^ (h >> 15)) * 0x85EBCA6B & MASK
    return ((h ^ (h >> 13)) * 0xC2B2AE35 & MASK) >> (32 - toxicity.TABLE_BITS)


def _plain(text):
    """feature -> value in steps."""
    chars = [ord(c) if ord(c) >= 128 else ord(c.lower()) if c.isalnum() else 0x20 for c in text or ""]
    chars, found = [0x20, *chars, 0x20] if chars else [], {}
    for k, n in enumerate(toxicity.ORDERS):
        times = Counter((k << toxicity.TABLE_BITS) | _place(chars[i : i + n]) for i in range(len(chars) - n + 1))
        found |= {f: round(math.log2(1 + m) * toxicity.STEP) for f, m in times.items()}
    return found


@pytest.mark.parametrize("size", [1 << 19, 7, 16, 33])
def test_counts_of_characters(monkeypatch, size):
    monkeypatch.setattr(toxicity, "PIECE_BYTES", size)
    row, feature, value = toxicity.counts(*flat.text_buffer(pa.array(TEXTS)))
    got = {(int(r), int(f)): int(v) for r, f, v in zip(row, feature, value, strict=True)}
    assert got == {(r, f): v for r, t in enumerate(TEXTS) for f, v in _plain(t).items()}


def test_ratios_and_scores(spark):
    rows = [(i, i * 7, t, i % 3 == 0) for i, t in enumerate(TEXTS)]
    n_yes = sum(r[3] for r in rows)
    sums = {True: Counter(), False: Counter()}
    for _, _, text, label in rows:
        sums[label].update(_plain(text))
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, text string, label boolean").repartition(3)
    got = {r.feature: (r.ratio, r.clear) for r in toxicity.ratios(df, n_yes, len(rows) - n_yes).collect()}
    assert got.keys() == sums[True].keys() | sums[False].keys()
    for f, (ratio, clear) in got.items():
        yes, no = (sums[t][f] / toxicity.STEP + toxicity.SMOOTH for t in (True, False))
        want = math.log(yes / (n_yes + 2 * toxicity.SMOOTH)) - math.log(no / (len(rows) - n_yes + 2 * toxicity.SMOOTH))
        assert ratio == pytest.approx(want) and clear == pytest.approx(abs(want) / math.sqrt(1 / yes + 1 / no))
    weights = np.zeros((len(toxicity.ORDERS), 1 << toxicity.TABLE_BITS), np.float32)
    for f in list(got)[::2]:
        weights.ravel()[f] = got[f][0]
    scored = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(df, toxicity.Model(weights, -0.5), keep=("score", "label")).collect()}
    for i, _, text, _ in rows:
        total = sum(float(weights.ravel()[f]) * v / toxicity.STEP for f, v in _plain(text).items()) - 0.5
        assert scored[i][0] == pytest.approx(1 / (1 + math.exp(-total))) and scored[i][1] == (scored[i][0] >= 0.5)


def test_rows_of_the_fit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 5)
    known = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    rows = [(i, f"text {k}") for i in range(12) for k in range(4)] * 3 + [(3, None), (None, "x"), (99, "unlabelled")]
    got = toxicity.sample(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    keys = {(r.doc_id, r.text) for r in got}
    assert len(keys) == len(got) and keys <= set(rows)  # an id may have many rows, equal rows count once
    assert Counter(r.label for r in got) == {True: 5, False: 5} and all(r.label == (r.doc_id % 2 == 1) for r in got)
