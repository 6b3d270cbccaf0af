"""Driver contract: every registered query runs; SQL oracles agree (sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from statloom.plans.registry import all_queries
from statloom.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


# the engine's own queries; those of optional subpackages are tested there
QUERIES = {name: fn for name, (fn, _) in all_queries().items()}
ORACLES = {name: sql for name, (_, sql) in all_queries().items() if sql is not None}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["comunidad", "anio", "salario_medio", "ipc_valor", "poder_adquisitivo"]


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(ORACLES) <= set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLES) == {"local_trend"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    got = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert got == want


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_types_match_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    rel = duck.sql(ORACLES[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_pandas_dtypes_match_oracle(spark, duck, name):
    """Whichever client API reads the results, both sides look alike."""
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert {c: str(t) for c, t in got.dtypes.items()} == {c: str(t) for c, t in want.dtypes.items()}
