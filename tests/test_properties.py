"""Property tests: split loads, insert-or-ignore against a Python model."""

import series_fixture as sf
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statloom.operators.star import insert_or_ignore
from statloom.plans import blocks, ingest
from statloom.sources.series_json import read_series_lines


def _facts_by_name(store):
    """Facts with dimension names instead of ids (ids depend on load order)."""
    sal, pri, emp = blocks.star_blocks(store.tables())
    return {name: sorted(map(tuple, df.collect())) for name, df in
            (("salaries", sal), ("prices", pri), ("employment", emp))}


def test_split_batch_gives_same_facts(spark, scratch):
    docs = sf.series_by_code()
    codes = list(docs)
    whole = ingest.StarStore(spark, scratch + "/whole")
    ingest.load(read_series_lines(spark, sf.write_lines(scratch + "/all", docs)), whole)
    split = ingest.StarStore(spark, scratch + "/split")
    for i, part in enumerate((codes[: len(codes) // 2], codes[len(codes) // 2:])):
        sub = {c: docs[c] for c in part}
        ingest.load(read_series_lines(spark, sf.write_lines(f"{scratch}/part{i}", sub)), split)
    assert _facts_by_name(whole) == _facts_by_name(split)


KEY = st.sampled_from([None, "a", "b"])
ROW = st.tuples(KEY, KEY, st.integers(0, 5))


def _key(r):
    return tuple((x is None, x) for x in r)


def _model(stored, batch):
    seen = {(k1, k2) for k1, k2, _, _ in stored}
    first = {}
    for k1, k2, v, o in sorted(batch, key=lambda r: r[3]):
        first.setdefault((k1, k2), (k1, k2, v, o))
    return sorted((r for key, r in first.items() if key not in seen), key=_key)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=6), st.lists(ROW, max_size=10))
def test_insert_or_ignore_matches_model(spark, stored_rows, batch_rows):
    schema = "k1 string, k2 string, v int, o int"
    stored = [(a, b, v, i) for i, (a, b, v) in enumerate(stored_rows)]
    batch = [(a, b, v, 100 + i) for i, (a, b, v) in enumerate(batch_rows)]
    got = insert_or_ignore(spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema),
                           ["k1", "k2"], ["o"])
    assert sorted(map(tuple, got.collect()), key=_key) == _model(stored, batch)


def test_name_parts_matches_python_split_strip(spark):
    import random

    from statloom.functions.names import name_parts

    rng = random.Random(7)
    alphabet = ["a", "b", "Í", " ", ".", "\t", " ", " ", "x y"]
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r.i: r.p for r in df.select("i", name_parts("n").alias("p")).collect()}
    for i, n in enumerate(names):
        assert got[i] == [p.strip() for p in n.split(".") if p.strip()], repr(n)


def test_grouped_corr_matches_numpy_on_random_groups(spark):
    import math
    import random

    import numpy as np

    from statloom.operators.measures import grouped_corr

    rng = random.Random(3)
    rows = []
    for g in range(60):
        size = rng.randint(1, 12)
        const_x = rng.random() < 0.15
        for _ in range(size):
            x = 5.0 if const_x else round(rng.uniform(-10, 10), 2)
            y = round(rng.uniform(-10, 10), 2)
            if rng.random() < 0.15:
                x = None
            if rng.random() < 0.15:
                y = None
            rows.append((g, x, y))
    df = spark.createDataFrame(rows, "g int, x double, y double")
    got = {r.g: r.c for r in grouped_corr(df, "g", "x", "y", "c").collect()}
    for g in range(60):
        pairs = [(x, y) for gg, x, y in rows if gg == g and x is not None and y is not None]
        xs = np.array([p[0] for p in pairs])
        ys = np.array([p[1] for p in pairs])
        if len(pairs) < 2 or xs.std() == 0 or ys.std() == 0:
            assert got.get(g) is None
        else:
            want = float(np.corrcoef(xs, ys)[0, 1])
            assert math.isclose(got[g], want, rel_tol=1e-9, abs_tol=1e-12)


def _period_model(year, month, code):
    """The period table of functions/periods.py, written out plainly."""
    import datetime

    if year is None:
        return None
    if month is not None:
        if not 1 <= month <= 12:
            return None
        return (year, month, None, datetime.date(year, month, 1))
    if code is None or code == 28:
        return (year, None, None, datetime.date(year, 1, 1))
    if 19 <= code <= 22:
        q = code - 18
        return (year, 3 * q - 2, q, datetime.date(year, 3 * q - 2, 1))
    return None


def test_normalise_period_matches_model(spark):
    import random

    from statloom.functions.periods import normalise_period

    rng = random.Random(11)
    cases = []
    for i in range(400):
        year = rng.choice([None, 1999, 2015, 2024])
        month = rng.choice([None, None, 0, 1, 6, 12, 13])
        code = rng.choice([None, 19, 20, 21, 22, 28, 23, 5, 0])
        cases.append((i, year, month, code))
    df = spark.createDataFrame(cases, "i int, y int, m int, c int")
    out = df.select("i", normalise_period("y", "m", "c").alias("p")).collect()
    for r in out:
        _, year, month, code = cases[r.i]
        want = _period_model(year, month, code)
        p = r.p
        if want is None:
            assert not p.period_ok
        else:
            assert p.period_ok and (p.anio, p.mes, p.trimestre, p.fecha_iso) == want
