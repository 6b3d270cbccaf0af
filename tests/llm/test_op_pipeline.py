"""The pipeline, stage by stage, against plain versions."""

import duckdb
import plain
import public_tokenizers
import sentencepiece

import corpus_pipeline
from statloom.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = read_table(spark, SF, "documents")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == corpus_pipeline.COLUMNS
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {d for (d,) in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE toxic = 1").fetchall()}
    clean = {d for (d,) in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE toxic = 0").fetchall()}
    first, second, third, fourth = kept.values()
    assert clean <= set(first) and len(toxic & set(first)) <= len(toxic) // 3
    rows = sorted(first.items())
    assert second == {d: first[d] for d, _, c in plain.near_duplicates(rows) if c == d}
    rows = sorted(second.items())
    want = {d: second[d] if not k else " ".join(w) for d, _, k, w in plain.dedup(rows) if not k or w}
    assert third == want
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    found = {d: (n, k) for d, n, k, _ in plain.hits(sorted(third.items()), items)}
    assert set(fourth) == {d for d, (n, k) in found.items() if 2 * k <= n}
    assert all(fourth[d] == third[d] for d in fourth if not found[d][1])
    left = {d: k for d, _, k, _ in plain.hits(sorted(fourth.items()), items)}
    assert any(found[d][1] for d in fourth) and not any(left.values())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in docs.collect():
        ids = [*library.encode(fourth[r.doc_id]), 2]
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded_sha256 == plain.sha(library.decode(ids))
    result = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert result == {r.doc_id: r.ids_sha256 for r in docs.collect()}


def test_short_benchmark_items_are_cut(spark, tmp_path):
    nine = "alpha beta gamma delta epsilon zeta eta theta iota"
    spark.createDataFrame([(1, nine), (2, "lone")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    around = " ".join(f"w{i}" for i in range(20))
    texts = [(1, nine), (2, f"{around} {nine} {around}"), (3, f"{around} lone end"), (4, nine.replace("iota", "other")), (5, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: (r.text and " ".join(r.text.split()), r.n_chars == len(r.text or "")) for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()}
    assert left == {2: (f"{around} {around}", True), 3: (f"{around} end", True), 4: (texts[3][1], True), 5: (None, True)}


def test_documents_that_share_an_id_are_judged_each(spark):
    x, y, z = ("".join(f"{w}{i} " for i in range(30)) for w in ("x", "y", "z"))
    rows = [(3, x), (5, x), (5, y), (5, z), (5, z), (6, z + "more"), (7, y.replace("y29", "end")), (8, "one two"), (8, "three"), (8, "one two"), (9, None), (9, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    # x of 5 is a copy of 3, z of 6 and y of 7 are near the texts of 5; "one two" is a shingle of its own
    assert left == sorted([(3, x), (5, y), (5, z), (8, "one two"), (8, "three"), (9, "")])


def test_many_item_blocks_give_the_same_hits(spark, monkeypatch):
    docs = read_table(spark, SF, "documents")
    items = read_table(spark, SF, "benchmark")
    one = corpus_pipeline.hits.clean(docs, items, corpus_pipeline.COLUMNS)
    want = sorted(tuple(r) for r in one.collect())
    found = sorted((r.doc_id, r.hits, r["items"]) for r in corpus_pipeline.hits.find_hits(docs, items).collect())
    monkeypatch.setattr(corpus_pipeline.hits, "BLOCK_BYTES", 2000)
    many = corpus_pipeline.hits.clean(docs, items, corpus_pipeline.COLUMNS)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(tuple(r) for r in many.collect()) == want
    assert sorted((r.doc_id, r.hits, r["items"]) for r in corpus_pipeline.hits.find_hits(docs, items).collect()) == found
