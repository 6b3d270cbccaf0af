"""Generic measures and the semantic traps they must handle."""

import math

import pytest
from pyspark.sql import functions as F

from statloom.operators import measures as m
from statloom.operators.reshape import wide_to_long


def test_annual_mean_filters_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", 2020, 1.0, "x"), ("a", 2020, 3.0, "x"), ("a", 2020, None, "x"), ("a", 2020, 100.0, "y")],
        "g string, anio int, v double, ind string")
    out = m.annual_mean(df, ["g", "anio"], "v", "mean_v", m.eq("ind", "x")).collect()
    assert [(r.g, r.anio, r.mean_v) for r in out] == [("a", 2020, 2.0)]


def test_inequality_and_negated_membership_drop_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert df.filter(m.ne("c", "a")).count() == 1
    assert df.filter(m.not_isin("c", ["a"])).count() == 1


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    vals = [r.r for r in m.ratio(df, "a", "b", "r", 100.0).collect()]
    assert vals == [None, 25.0]


def test_rebase_is_100_at_base_and_checks_base(spark):
    df = spark.createDataFrame([(2014, 50.0), (2015, 80.0), (2016, 120.0)], "anio int, v double")
    out = {r.anio: r.idx for r in m.rebase(df, "anio", 2015, "v", "idx").collect()}
    assert out == {2014: 62.5, 2015: 100.0, 2016: 150.0}
    with pytest.raises(Exception, match="exactly one row"):
        m.rebase(df, "anio", 1999, "v", "idx").collect()
    dup = df.unionByName(df)
    with pytest.raises(Exception, match="exactly one row"):
        m.rebase(dup, "anio", 2015, "v", "idx").collect()


def test_pivot_mean_level_order_and_missing_level(spark):
    df = spark.createDataFrame([(1, "H", 10.0), (1, "H", 20.0), (1, "M", 5.0)], "k int, s string, v double")
    out = m.pivot_mean(df, "k", "s", ["M", "H", "X"], "v")
    assert out.columns == ["k", "M", "H", "X"]
    r = out.first()
    assert (r.M, r.H, r.X) == (5.0, 15.0, None)


def test_pivot_unique_raises_on_duplicate(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "k int, s string, v double")
    with pytest.raises(Exception, match="duplicate cell"):
        m.pivot_unique(df, "k", "s", ["a"], "v").collect()


def test_gap_and_clean(spark):
    df = spark.createDataFrame([(80.0, 100.0), (300.0, 100.0), (-5.0, 100.0), (10.0, 0.0)], "lo double, hi double")
    g = m.clean_gap(m.gap_pct(df, "hi", "lo", "gap"), "gap", "lo", "hi").collect()
    assert [(r.lo, r.gap) for r in g] == [(80.0, 20.0)]


def test_grouped_corr_edge_cases(spark):
    rows = [("line", float(i), 2.0 * i + 1) for i in range(5)]
    rows += [("one", 1.0, 2.0), ("const", 1.0, 1.0), ("const", 1.0, 2.0)]
    rows += [("half", 1.0, 1.0), ("half", 2.0, 2.1), ("half", 3.0, 2.9), ("half", None, 50.0), ("half", 40.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    out = {r.g: r.c for r in m.grouped_corr(df, "g", "x", "y", "c").collect()}
    assert out["line"] == pytest.approx(1.0)
    assert out["one"] is None and out["const"] is None
    import numpy as np

    assert out["half"] == pytest.approx(np.corrcoef([1, 2, 3], [1, 2.1, 2.9])[0, 1])


def test_corr_unchanged_by_positive_scaling(spark):
    rows = [("g", float(i), float((i * 7) % 5)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    a = m.grouped_corr(df, "g", "x", "y", "c").first().c
    b = m.grouped_corr(df.withColumn("x", F.col("x") * 3 + 7), "g", "x", "y", "c").first().c
    assert -1.0 <= a <= 1.0 and a == pytest.approx(b)


def test_latest_keeps_max_period(spark):
    df = spark.createDataFrame([(2020, 1.0), (2021, 2.0), (2021, 3.0)], "anio int, v double")
    assert sorted(r.v for r in m.latest(df, "anio").collect()) == [2.0, 3.0]


def test_pivot_then_unpivot_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "b", 4.0)], "k int, s string, v double")
    wide = m.pivot_unique(df, "k", "s", ["a", "b"], "v")
    back = wide_to_long(wide, ["k"], ["a", "b"], "s", "v")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([(1000.0, 250.0), (3.0, 1.0)], "tot double, part double")
    out = m.complement_share(m.share(df, "part", "tot", "p"), "part", "tot", "q").collect()
    for r in out:
        assert math.isclose(r.p + r.q, 100.0)


def test_round_doubles_keeps_names(spark):
    df = spark.createDataFrame([(1.23456789, "x")], "`Temporal (%)` double, s string")
    out = m.round_doubles(df, 3)
    assert out.columns == ["Temporal (%)", "s"] and out.first()[0] == 1.235


def test_portable_output_form(spark):
    import datetime

    from statloom.plans.testdata import portable

    df = spark.createDataFrame([(datetime.date(2015, 7, 1), 3, None), (datetime.date(2016, 1, 1), None, 2)],
                               "d date, m int, k int")
    out = portable(df, widen=("m",))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "double", "int"]
    assert [tuple(r) for r in out.collect()] == [("2015-07-01", 3.0, None), ("2016-01-01", None, 2)]
