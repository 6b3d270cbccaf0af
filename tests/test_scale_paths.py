"""The plans a large cluster takes: no broadcast anywhere, every join split
as skewed. Results must not change (oracle comparison at sf0.001)."""

import os

import duckdb
import pytest

from statloom.sources.tables import TABLES
from test_registry import ORACLES, QUERIES, SF, _rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

CLUSTER_SHAPE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture()
def cluster_shape(spark):
    old = {k: spark.conf.get(k, None) for k in CLUSTER_SHAPE}
    for k, v in CLUSTER_SHAPE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_all_oracles_hold_without_broadcast(cluster_shape):
    spark = cluster_shape
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, sql in ORACLES.items():
        sdf = QUERIES[name](spark, SF)
        got = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
        res = con.execute(sql)
        want = _rows([d[0] for d in res.description], res.fetchall())
        if got != want:
            bad.append(name)
    assert bad == []


def test_trend_same_without_broadcast(spark):
    import math

    base = {(r.tasa_paro_media, r.salario_medio): r.trend for r in QUERIES["local_trend"](spark, SF).collect()}
    old = {k: spark.conf.get(k, None) for k in CLUSTER_SHAPE}
    try:
        for k, v in CLUSTER_SHAPE.items():
            spark.conf.set(k, v)
        shaped = {(r.tasa_paro_media, r.salario_medio): r.trend
                  for r in QUERIES["local_trend"](spark, SF).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert base.keys() == shaped.keys()
    assert all(math.isclose(base[k], shaped[k], rel_tol=1e-9, abs_tol=1e-6) for k in base)
