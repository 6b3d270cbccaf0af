"""Registered queries of the training-data operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import (
    decontaminate, edit_fingerprint, html_text, language_id, ngram_join, quality_rules, sentencepiece_bpe, sharding, source_divergence, substring_dedup,
    token_files, toxicity, vector_codes,
)
from statloom.sources.tables import read_table



def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file (the installed vocabulary package names it)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=16, even="bytes")
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.TokenFiles(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
    done = files.digests().checkpoint()
    files.drop()
    return done


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    done = language_id.predict(docs, language_id.train(docs))
    return done.select("doc_id", F.coalesce(language_id.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    done = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return done.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.near_report(read_table(spark, sf_dir, "documents"))


WORDS = r"[^\x20\x09-\x0D]+"


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup_windows(read_table(spark, sf_dir, "documents")))


OP8_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
least AS (SELECT win, min(doc_id) AS first_doc FROM win GROUP BY win HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN least USING (win) WHERE doc_id > first_doc),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM hit) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
cut AS (SELECT DISTINCT doc_id, unnest(ps) AS p FROM gone),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP5_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
        UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, r.c FROM reach r JOIN edges e ON e.u = r.doc_id)
SELECT r.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.find_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
       FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(read_table(spark, sf_dir, "embeddings"))


def _floor_div(a: str, b: str) -> str:
    """Whole-number division towards minus infinity (b > 0); DuckDB's goes towards zero."""
    return f"(({a}) // ({b}) - CASE WHEN ({a}) % ({b}) < 0 THEN 1 ELSE 0 END)"


def _op11_sql(rounds: int = 2) -> str:
    """Each round by comparing every part with every entry."""
    sql = """
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, label, embedding AS e FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, vec_id, label, list_transform(e, lambda v: CAST(floor(CAST(v AS DOUBLE) * 256) AS BIGINT)) AS v, len(e) // 16 AS w FROM kept),
parts AS (SELECT r, vec_id, label, p, v[p * w + 1:(p + 1) * w] AS v FROM x, range(16) t(p)),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM x QUALIFY k < 64),
b0 AS (SELECT p, k, v FROM parts JOIN seeds USING (r))"""
    near = "SELECT r, vec_id, label, parts.p, parts.v, k, list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d\n  FROM parts JOIN b{i} b USING (p) QUALIFY row_number() OVER (PARTITION BY r, parts.p ORDER BY d, k) = 1"
    for i in range(rounds):
        sql += f""",
a{i} AS ({near.format(i=i)}),
s{i} AS (SELECT p, k, j, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, k, unnest(v) AS c, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY p, k, j),
m{i} AS (SELECT p, k, list({_floor_div('s', 'n')} ORDER BY j) AS v FROM s{i} GROUP BY p, k),
b{i + 1} AS (SELECT b.p, b.k, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN m{i} m USING (p, k))"""
    return sql + f""",
last AS ({near.format(i=rounds)}),
coded AS (SELECT r, vec_id, label, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r, vec_id, label),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, j)) AS h
           FROM (SELECT p, k, unnest(v) AS c, generate_subscripts(v, 1) AS j FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, digest
"""


OP11_SQL = _op11_sql()


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read_table(spark, sf_dir, "documents"))


#: Every kept term against every group, in 128-bit integers.
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  unnest(regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
kept AS (SELECT lang, term, count(*) AS ln FROM d GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM d JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(ln)::HUGEINT AS lt FROM kept GROUP BY lang),
t AS (SELECT lang, source, sum(n)::HUGEINT AS tot FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (coalesce(tot, 0) + v) AS p,
             1 + (1000000000::HUGEINT * (ln + 1)) // (lt + v) AS q
      FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f
                     FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_sharding": (op1_sharding, None),
    "op2_sentencepiece": (op2_sentencepiece, None),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_token_files": (op4_token_files, None),
    "op5_ngram_jaccard_join": (op5_ngram_jaccard_join, OP5_SQL),
    "op6_benchmark_decontamination": (op6_benchmark_decontamination, OP6_SQL),
    "op7_language_id": (op7_language_id, None),
    "op8_substring_dedup": (op8_substring_dedup, OP8_SQL),
    "op9_toxicity": (op9_toxicity, None),
    "op10_edit_fingerprint": (op10_edit_fingerprint, None),
    "op11_vector_codes": (op11_vector_codes, OP11_SQL),
    "op12_source_divergence": (op12_source_divergence, OP12_SQL),
    "op13_quality_rules": (op13_quality_rules, None),
}
