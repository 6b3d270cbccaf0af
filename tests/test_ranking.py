"""Exact distributed ranks and star helpers."""

from pyspark.sql import functions as F

from statloom.operators.ranking import global_rank
from statloom.operators.star import extend_dimension, first_wins, insert_or_ignore


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), "id")
    for parts in (None, 7):
        out = global_rank(df, ["k", "id"], "rk", partitions=parts).collect()
        ranks = sorted(r.rk for r in out)
        assert ranks == list(range(5000))
        by_rank = [(r.k, r.id) for r in sorted(out, key=lambda r: r.rk)]
        assert by_rank == sorted(by_rank)


def test_first_wins_keeps_null_keys_as_a_group(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("x", 3, "c")], "k string, o int, v string")
    got = sorted((r.k or "", r.v) for r in first_wins(df, ["k"], ["o"]).collect())
    assert got == [("", "a"), ("x", "c")]


def test_insert_or_ignore_null_safe(spark):
    stored = spark.createDataFrame([(None, "a", 1.0)], "k string, j string, v double")
    batch = spark.createDataFrame([(None, "a", 9.0), (None, "b", 2.0)], "k string, j string, v double")
    new = insert_or_ignore(stored, batch, ["k", "j"]).collect()
    assert [(r.k, r.j, r.v) for r in new] == [(None, "b", 2.0)]


def test_extend_dimension_ids_after_max(spark):
    dim = spark.createDataFrame([(7, "b", "u0")], "id long, name string, unit string")
    batch = spark.createDataFrame([("c", "u1", 5), ("a", "u2", 3), ("b", "u9", 1), ("a", "u3", 4)],
                                  "name string, unit string, seq int")
    new = extend_dimension(dim, batch, ["name"], "id", ["seq"], ["unit"]).collect()
    assert sorted((r.id, r.name, r.unit) for r in new) == [(8, "a", "u2"), (9, "c", "u1")]
