"""The queries against brute force, the libraries and DuckDB on the small test tables."""

import struct
import zlib

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest

from statloom.llm import edit_fingerprint, language_id, ngram_join, queries, sentencepiece_bpe, sharding, token_files, toxicity
from statloom.sources.tables import read_table

SF = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
TEXTS = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def run(spark, name, sf=SF):
    return queries.QUERIES[name][0](spark, sf)


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(queries.QUERIES[name][1])
    want = sorted(map(str, (dict(sorted(zip([d[0] for d in res.description], r))) for r in res.fetchall())))
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in run(spark, name).collect()) == want


def test_sharding_is_even_and_keeps_equal_texts_together(spark):
    rows = run(spark, "op1_sharding", SF_CHECK).collect()
    size, slots = {}, {}
    for r in rows:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(size) == list(range(16)) and len(rows) == len({r.doc_id for r in rows}) == 1000
    assert max(size.values()) <= 1.02 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_CHECK}/documents.parquet'").fetchall())
    shards = {}
    for r in rows:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_sharding_of_one_group_of_copies_is_even(spark):
    docs = spark.range(0, 3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text' ELSE concat('text ', id) END AS text")
    size = {}
    for r in sharding.shard_documents(docs, 8).collect():
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert len(size) == 8 and max(size.values()) <= 1.03 * min(size.values())


@pytest.mark.parametrize("hot,pairs,rows", [(1000, 300, 3000), (1000, 950, 3000), (0, 400, 800)])
def test_sharding_leaves_no_group_cut_that_a_shard_can_hold(spark, hot, pairs, rows):
    key = f"CASE WHEN id < {hot} THEN 0 WHEN id < {hot + 2 * pairs} THEN 1000 + (id - {hot}) DIV 2 ELSE 100000 + id END"
    docs = spark.range(rows).selectExpr("id AS doc_id", f"concat('text ', lpad({key}, 9, '0')) AS text")
    done, size, shards = sharding.shard_documents(docs, 8).collect(), {}, {}
    for r in done:
        size[r.shard] = size.get(r.shard, 0) + r.size
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert sorted(r.doc_id for r in done) == list(range(rows))
    assert len(size) == 8 and max(size.values()) <= 1.03 * min(size.values())
    # the hot group, a third of the rows, fills three of eight shards; pairs lie whole
    assert sorted(map(len, shards.values()))[-2:] == ([1, 3] if hot else [1, 1])


def test_sharding_by_rows(spark):
    docs = spark.range(0, 1003).selectExpr("id AS doc_id", "repeat('x', CAST(id % 50 AS INT)) AS text")
    count = {r.shard: r["count"] for r in sharding.shard_documents(docs, 8, even="rows").groupBy("shard").count().collect()}
    assert len(count) == 8 and max(count.values()) - min(count.values()) <= 8


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return sentencepiece_bpe.Model(f.read()), sentencepiece.SentencePieceProcessor(model_file=path)


def test_sentencepiece_matches_the_library(pieces):
    own, library = pieces
    rng = np.random.default_rng(3)
    letters = list("ab ▁é漢🙂\n\tthehinst  eaer\0﻿�")
    texts = [t for _, t in TEXTS] + ["", " ", "   x", "x ", "a" * 500, "ab" * 400, "</s>", "<0x41>", " " * 33]
    texts += ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(500)]
    texts += ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(1, 300))) for _ in range(200)]
    for got, want, text in zip(own.encode(texts, {}), library.encode(texts), texts):
        assert got.tolist() == want, text
        assert own.decode(np.append(got, np.int32(own.end))) == library.decode([*want, own.end]), text


def test_sentencepiece_query(spark, pieces):
    _, library = pieces
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op2_sentencepiece").collect()}
    for d, t in TEXTS:
        ids = [*library.encode(t), 2]
        assert got[d] == (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(library.decode(ids)))


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, start, want = Tokenizer.from_file(path), 0, []
    for d, t in TEXTS:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, run(spark, "op4_token_files").collect())) == want
    files = token_files.TokenFiles(read_table(spark, SF, "documents"), path, end_id=2, folder=tmp_path.as_uri())
    row = files.manifest.orderBy("start").first()
    reader = token_files.FileReader(row.path)
    assert [x.tolist() for x in reader.document(TEXTS[3][0])] == [[*library.encode(TEXTS[3][1], add_special_tokens=False).ids, 2]]
    # the file is a series of zstd frames to any reader, and damage is noticed
    name = row.path.removeprefix("file://")
    raw = bytearray(open(name, "rb").read())
    raw[int(reader.offset[3]) + 12] ^= 1
    open(name + ".bad", "wb").write(raw)
    with pytest.raises(Exception):
        token_files.FileReader(row.path + ".bad").document(TEXTS[3][0])


def test_encoder_on_awkward_words():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from statloom.llm import flat

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        own = token_files.WordEncoder(f.read())
    library = Tokenizer.from_file(path)
    rng = np.random.default_rng(5)
    letters = list("abZ19 '\t\n\x0b\x1c\x85éÉßÀ×÷ªµİſΣς́Å漢.,-_") + ["<|endoftext|>", "'s", "'re"]
    for texts in (["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(2000)], ["".join(rng.choice(letters[:-3], rng.integers(0, 40))) for _ in range(2000)]):
        ids, cuts = own.encode(*flat.text_buffer(pa.array(texts)))
        for t, a, b in zip(texts, cuts[:-1], cuts[1:]):
            assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_near_copies_of_one_text(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for k in range(260):  # a large group of near copies, some linked only through others
        words = list(base)
        for i in rng.choice(80, rng.integers(0, 4), replace=False):
            words[i] = f"edit{k}_{i}"
        docs.append((1000 - k, " ".join(words)))
    docs += [(k, f"lone {k} " + " ".join(f"u{k}_{i}" for i in range(30)) + " " + " ".join(base[:30])) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(plain.near_duplicates(docs))


def test_all_links_are_listed(spark):
    docs = TEXTS[:120] + [(10_000 + d, t) for d, t in TEXTS[:5]]
    docs += [(20_000 + d, t + " one more") for d, t in TEXTS[:20]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    links, members = ngram_join.similar_pairs(df)
    node = {r.doc_id: r.node for r in members.collect()}
    sets = {node[d]: plain.shingles(t) for d, t in docs}
    keys = sorted(sets)
    want = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {(min(r.u, r.v), max(r.u, r.v)) for r in links.collect()} == want


def _measure(spark, name, column):
    got = {r.doc_id: r for r in run(spark, name, SF_CHECK).collect()}
    return [(got[d], v) for d, v in duckdb.sql(column).fetchall() if zlib.crc32(str(d).encode()) % 5 == 0]


def test_language_of_held_out_documents(spark):
    pairs = _measure(spark, "op7_language_id", f"SELECT doc_id, lang FROM '{SF_CHECK}/documents.parquet'")
    assert all(r.held_out and 0 <= r.score <= 1 for r, _ in pairs)
    assert np.mean([r.lang_pred == v for r, v in pairs]) > 0.97


def test_mixture_of_languages(spark):
    docs = read_table(spark, SF_CHECK, "documents")
    model = language_id.train(docs)
    text = dict(duckdb.sql(f"SELECT lang, min(text) FROM '{SF_CHECK}/documents.parquet' WHERE n_chars > 1500 GROUP BY lang").fetchall())
    both = spark.createDataFrame([(1, text["de"][:1500] + "\n" + text["fr"][:1500]), (2, text["es"][:1500])], "doc_id long, text string")
    rows = {r.doc_id: set(r.languages) for r in language_id.predict(both, model).collect()}
    assert rows == {1: {"de", "fr"}, 2: {"es"}}


def test_toxicity_of_held_out_documents(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.1", "documents"), read_table(spark, "/root/testdata/sf0.1", "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(toxicity.held_out())
    count = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert count[1, 1] >= 0.85 * (count[1, 1] + count.get((1, 0), 0)) and count.get((0, 1), 0) <= 0.01 * count[0, 0]


def _fingerprint(text):
    """The embedding step by step."""
    w = edit_fingerprint.walker()
    stays, t, emitted = w.stays.reshape(edit_fingerprint.CLASSES, edit_fingerprint.PERIOD), 0, []
    for ch in text:
        c = int(w.codes(edit_fingerprint._chars(ch))[0]) // edit_fingerprint.PERIOD
        run = int(stays[c, t % edit_fingerprint.PERIOD])
        emitted += [c] * run
        t += run
    if not emitted:
        return "00" * (edit_fingerprint.SLOTS // 8)
    bits = [w.slot_bits[s, emitted[max(x for x in w.records[s].tolist() if x < len(emitted))]] for s in range(edit_fingerprint.SLOTS)]
    return np.packbits(bits).tobytes().hex()


def test_edit_fingerprints(spark):
    rows = {r.doc_id: r for r in run(spark, "op10_edit_fingerprint").collect()}
    order = TEXTS[::-1]
    for k, (d, t) in enumerate(order):
        half = len(t) // 2
        other = order[(k + 1) % len(order)][1]
        change = t[: len(t) - half] + other[:half]
        assert rows[d].n_chars == len(t) and rows[d].edited_sha256 == plain.sha(change)
        if k % 25 == 0:
            assert rows[d].fingerprint == _fingerprint(t) and rows[d].edited_fingerprint == _fingerprint(change)
    assert np.mean([r.near_edited for r in rows.values()]) > 0.4 > 0.2 > np.mean([r.near_next for r in rows.values()])


def test_near_fingerprints_are_grouped(spark):
    text = TEXTS[2][1] * 3
    docs = [(1, text), (2, text), (3, text[:300] + "X" + text[300:]), (4, TEXTS[5][1] * 2)]
    marks = edit_fingerprint.edit_report(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.group_id for r in edit_fingerprint.near_groups(marks, 0.6).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_edit_fingerprint_query_groups_near_documents(spark, tmp_path):
    text = TEXTS[2][1] * 3
    docs = [(1, text), (2, text), (3, text[:2000] + "X" + text[2001:]), (4, TEXTS[5][1] * 2), (5, None), (6, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = run(spark, "op10_edit_fingerprint", str(tmp_path)).collect()
    assert {r.doc_id: r.group_id for r in rows} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5} and len(rows) == 6
    assert {r.doc_id: r.n_chars for r in rows} == {d: len(t or "") for d, t in docs}


def test_near_groups_find_the_linked_pairs(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    near = 0.6
    marks = edit_fingerprint.edit_report(docs.where("length(text) > 0")).select("doc_id", "fingerprint").checkpoint()
    rows = [(r.doc_id, np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8)) for r in marks.collect()]
    links = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if edit_fingerprint.likeness(x, y) >= near]
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    group = {r.doc_id: r.group_id for r in edit_fingerprint.near_groups(marks, near).collect()}
    assert len(links) > 100 and sum(group[a] == group[b] for a, b in links) >= 0.95 * len(links)
    for d in group:  # no group joins what links don't
        assert find(d) == find(group[d]) and group[d] <= d


def test_bands_follow_the_rows_and_the_threshold():
    for n in (2, 50_000, 15_000_000, 50_000_000_000):
        bits, bands = edit_fingerprint.band_plan(n, 0.75)
        assert 2**bits >= min(4 * n, 2**38)
        chance = ((1 + 0.75) / 2) ** bits
        assert 1 - (1 - chance) ** bands > 0.95
    assert edit_fingerprint.band_plan(10, 1.0)[1] == 1
    assert len(set(edit_fingerprint._band_bits(3, 20).tolist())) == 20
