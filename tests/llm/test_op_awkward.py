"""Every operator on awkward rows and on empty tables: one defined result for each row."""

import time

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statloom.llm import (
    decontaminate, edit_fingerprint, flat, html_text, language_id, ngram_join, sentencepiece_bpe, sharding, substring_dedup, token_files, toxicity,
)
from statloom.llm.components import components

ROWS = plain.awkward()
ITEMS = [(1, plain.PASSAGE), (2, None), (3, ""), (4, "word1 word2"), (None, "one two three four")]
LABELS = [(1, 0, 1), (4, 1, 0), (5, None, None), (5, 1, 1), (None, 1, 1), (8, 0, 1), (99, 0, 1)]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, plain.COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], plain.COLUMNS)


def _items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def _labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def _run(spark, docs):
    """name -> rows of every operator."""
    files = token_files.TokenFiles(docs, WORDS, end_id=2)
    pages = docs.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html")
    return {
        "sharding": sharding.shard_documents(docs, 4),
        "sentencepiece": sentencepiece_bpe.encode_decode(docs, PIECES),
        "html": html_text.extract_text(pages),
        "token files": files.digests(),
        "n-gram join": ngram_join.near_duplicates(docs),
        "decontamination": decontaminate.find_hits(docs, _items(spark)),
        "language": language_id.predict(docs, language_id.train(docs)),
        "substrings": substring_dedup.dedup_windows(docs),
        "toxicity": toxicity.score(docs, toxicity.train(docs, _labels(spark))),
        "fingerprints": edit_fingerprint.edit_report(docs),
    }


def test_one_row_for_each_document(spark, docs):
    want = sorted((str(r[0]) for r in ROWS))
    for name, df in _run(spark, docs).items():
        key = "page_id" if name == "html" else "doc_id"
        assert sorted(str(r[key]) for r in df.select(key).collect()) == want, name


def test_empty_tables(spark, none):
    for name, df in _run(spark, none).items():
        assert df.collect() == [], name


def test_values_of_awkward_rows(spark, docs):
    named = [(r[0], r[1]) for r in ROWS if r[0] is not None]
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(docs).where("doc_id IS NOT NULL").select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(plain.near_duplicates(named))
    kept = docs.where("doc_id IS NOT NULL")
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.dedup_windows(kept).collect())
    assert got == sorted((d, n, k, " ".join(w)) for d, n, k, w in plain.dedup(named))
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_hits(kept, _items(spark)).collect())
    assert got == sorted((d, n, k, [("" if i == "None" else i) for i in sorted("" if x == "None" else x for x in ids)])
                         for d, n, k, ids in plain.hits(named, ITEMS))
    lang = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, language_id.train(docs)).collect() if r.doc_id in (1, 2, 3, 14)}
    assert set(lang.values()) == {("und", 0.0)}
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, _labels(spark))).collect()}
    assert scores[1] == scores[2] and all(0 <= s <= 1 for s in scores.values())


def test_no_labels_or_languages(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, empty)).collect()} == {0.5}
    unknown = language_id.train(docs.where("lang = 'none'"))
    assert {r.lang_pred for r in language_id.predict(docs, unknown).collect()} == {"und"}


def test_stages_take_awkward_rows_and_empty_tables(spark, docs, none, tmp_path):
    _items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    _labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) <= {r[0] for r in ROWS}, name
        if name != "sentencepiece":
            assert out.columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, none, str(tmp_path)).collect() == [], name
    near = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").where("doc_id IS NOT NULL").collect())
    assert near == [1, 2, 3, 4, 5, 8, 10, 11, 13, 14, 15]  # 6 and 7 are near 5, 9 is 8, 12 is near 11, 13 stays once
    cut = {r.doc_id: r for r in corpus_pipeline.substrings(spark, docs.where("doc_id IN (1, 3, 5, 6, 11, 12)"), "").collect()}
    assert set(cut) == {1, 3, 5, 11, 12} and cut[1].text is None and cut[3].text == " \t\n " and cut[12].text == "before after it all"
    left = {r.doc_id: r.text for r in corpus_pipeline.decontaminate(spark, docs.where("doc_id IN (1, 5, 10, 11, 12)"), str(tmp_path)).collect()}
    assert left[1] is None and left[10] == "Ünï çödé ñ — 漢字 🙂 x" and 11 not in left


def test_rounds_leave_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def count():
        return files.getAllBlocks().mkString(" ").count("shuffle")

    edges = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))  # a chain takes several rounds
    before = count()
    group = components(edges)
    assert {r.component for r in group.collect()} == {0}
    for _ in range(100):  # files go in the background
        if count() <= before + 60:
            break
        time.sleep(0.1)
    assert count() <= before + 60


def test_workers_give_back_tables_and_reserves(monkeypatch):
    buf = np.frombuffer(b"some words of a text " * 100, np.uint8)
    flat.find_words(buf, np.array([0, len(buf)]), flat.SPACED)
    assert flat._POWERS
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})()
    monkeypatch.setattr(flat.pa, "default_memory_pool", lambda: pool)
    flat.give_back()
    assert not flat._POWERS and released == [1]
