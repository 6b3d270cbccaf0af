"""The corpus pipeline: documents in, token ids of the documents worth training on out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.

* toxicity: documents that the classifier rejects go.
* near_duplicates: of each group of near copies the document of smallest doc_id stays.
* substring_dedup: words of repeated 13-word windows go; a document that loses all its words goes.
* decontaminate: words of benchmark windows are cut out; a document that is mostly benchmark goes.
* sentencepiece: token ids of each text, with an end id, and digests of ids and decoded text.

Documents that a stage has nothing against keep their text unchanged, NULL
texts too (the last stage encodes NULL like the empty text). Where a text
changes, n_chars follows it. Rows without a doc_id belong to no group of
copies: near_duplicates passes them on. Rows that share a doc_id but not the
text are documents of their own; of equal rows one stays. Columns besides those of
``documents`` are not passed on; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm import decontaminate as hits
from statloom.llm import ngram_join, sentencepiece_bpe, substring_dedup
from statloom.llm import toxicity as tox
from statloom.llm.queries import tokenizer_file
from statloom.llm.shared import Tables
from statloom.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL can't express the classifier or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = tox.train(docs, read_table(spark, sf_dir, "labels"))
    return tox.score(docs, model, keep=tuple(COLUMNS)).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash")).where("doc_id IS NOT NULL")
    found = ngram_join.near_duplicates(named)
    first = found.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    stay = first.unionByName(found.where("node IS NULL").select("doc_id", "text_hash").distinct())  # without words: linked with nothing
    kept = named.join(stay, ["doc_id", "text_hash"])
    # after the join equal rows lie together: keeping one costs no shuffle
    kept = kept.withColumn("again", F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("lang", "source", "n_chars"))).where("again = 1")
    return kept.select(*COLUMNS).unionByName(docs.select(*COLUMNS).where("doc_id IS NULL"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = docs.select(*COLUMNS, F.col("text").isNull().alias("no_text"))
    done = substring_dedup.dedup_windows(marked, keep=("lang", "source", "n_chars", "no_text"), as_is=True)
    changed = F.col("n_removed") > 0
    done = done.where(~changed | (F.col("kept_text") != ""))
    return done.select(
        "doc_id", F.when(~F.col("no_text"), F.col("kept_text")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = hits.clean(docs, read_table(spark, sf_dir, "benchmark"), COLUMNS)
    changed = F.when(F.col("n_hit") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", changed).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(docs, tokenizer_file("piece_bpe_32k.model"), keep=("lang", "source"), ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    tables = Tables(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = tables.write(stage(spark, docs, sf_dir), name)
        if k:
            tables.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
