"""Queries over the TPC-H-like test tables, one per group of operators.

Each entry is ``name -> (spark_fn, oracle_sql)``. ``spark_fn(spark, sf_dir)``
returns a DataFrame built with the library's operators; ``oracle_sql`` is the
same query in plain SQL (DuckDB dialect) over the same tables, or ``None``
where SQL cannot express it. Floating results are rounded to 6 digits on both
sides so the two engines' summation order does not matter; dates are ISO text
and NULL-holding integer columns are doubles on both sides (``portable``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from statloom.operators import measures as m
from statloom.plans import blocks, marts
from statloom.session import ensure_checkpoint_dir
from statloom.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

DIGITS = 6


def portable(df: DataFrame, widen: tuple[str, ...] = ()) -> DataFrame:
    """Output form that two engines' client libraries read back alike: dates
    as ISO ``YYYY-MM-DD`` text, and the integer columns in ``widen`` (those
    that hold NULLs) as doubles, which have one NULL form everywhere."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif f.name in widen:
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None, widen: tuple[str, ...] = ()):
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return portable(m.round_doubles(fn(spark, sf_dir), DIGITS), widen)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return run

    return wrap


# --------------------------------------------------------------------------
# Analog blocks (same column names as the indicator star's master blocks).
# --------------------------------------------------------------------------

SAL_SQL = """sal AS (
  SELECT o.o_totalprice AS salario, n.n_name AS comunidad,
         CAST(year(o.o_orderdate) AS INTEGER) AS anio, o.o_orderpriority AS indicador,
         o.o_orderstatus AS sexo, c.c_mktsegment AS ocupacion
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

PRICE_SQL = """pri AS (
  SELECT l.l_extendedprice AS precio, o.o_orderstatus AS comunidad,
         CAST(year(l.l_shipdate) AS INTEGER) AS anio, l.l_returnflag AS indicador,
         p.p_type AS categoria_gasto
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

EMP_SQL = """emp AS (
  SELECT l.l_discount AS valor_empleo, n.n_name AS comunidad,
         CAST(year(l.l_shipdate) AS INTEGER) AS anio, l.l_returnflag AS indicador,
         l.l_linestatus AS sexo, CAST(l.l_linenumber AS VARCHAR) AS grupo_edad
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

BY_REGION_SQL = """by_region AS (
  SELECT comunidad, anio, avg(salario) AS salario_medio
  FROM sal WHERE salario IS NOT NULL GROUP BY comunidad, anio)"""

CPI_SQL = """cpi AS (
  SELECT anio, avg(precio) AS ipc_valor FROM pri
  WHERE indicador = 'N' AND precio IS NOT NULL GROUP BY anio)"""

# Analog filter values (TESTDATA columns standing in for the statistics).
NATIONAL_ROW = "NATION_0"
BASE_YEAR = 1998
GAP_LEVELS = ("O", "F")
SHARE_TOTAL, SHARE_PART = "A", "R"
LEVEL_SET = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _r(expr: str, alias: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's decimal rounding never gives -0.0)
    return f"(ROUND({expr}, {DIGITS}) + CAST(0 AS DOUBLE)) AS \"{alias}\""


def _by_region(t: Tables) -> DataFrame:
    return marts.salary_by_region(blocks.testdata_salaries(t), indicator=None)


def _cpi(t: Tables) -> DataFrame:
    return marts.annual_cpi(blocks.testdata_prices(t), indicator="N", region=None, category=None)


def _q5(t: Tables) -> DataFrame:
    unemp = marts.annual_unemployment(
        blocks.testdata_employment(t), indicator=None, excluded_region=NATIONAL_ROW, sex=None, age=None
    )
    return marts.unemployment_vs_wage(_by_region(t), unemp, excluded_region=NATIONAL_ROW)


def _gap(t: Tables) -> DataFrame:
    return marts.occupation_gap(
        blocks.testdata_salaries(t), indicator=None, levels=GAP_LEVELS, out="gap_pct"
    )


def _shares(t: Tables) -> DataFrame:
    return marts.job_quality(
        blocks.testdata_employment(t), total=SHARE_TOTAL, part=SHARE_PART, region=None,
        part_out="share_pct", rest_out="complement_pct",
    )


@query(
    "star_block_orders",
    _with(SAL_SQL) + "SELECT * FROM sal",
)
def star_block_orders(spark, sf_dir):
    """Fact x customer x nation, renamed projection."""
    return blocks.testdata_salaries(Tables(spark, sf_dir))


@query("star_block_lines", _with(PRICE_SQL) + "SELECT * FROM pri")
def star_block_lines(spark, sf_dir):
    """Lineitem x orders x part."""
    return blocks.testdata_prices(Tables(spark, sf_dir))


@query("star_block_supply", _with(EMP_SQL) + "SELECT * FROM emp")
def star_block_supply(spark, sf_dir):
    """Lineitem x supplier x nation."""
    return blocks.testdata_employment(Tables(spark, sf_dir))


@query(
    "region_year_mean",
    _with(SAL_SQL, BY_REGION_SQL)
    + f"SELECT comunidad, anio, {_r('salario_medio', 'salario_medio')} FROM by_region",
)
def region_year_mean(spark, sf_dir):
    """Q1 shape (A1 P9 O1): mean per (region, year), sorted."""
    return m.order_by(_by_region(Tables(spark, sf_dir)), "comunidad", "anio")


@query(
    "annual_index",
    _with(PRICE_SQL, CPI_SQL) + f"SELECT anio, {_r('ipc_valor', 'ipc_valor')} FROM cpi",
)
def annual_index(spark, sf_dir):
    """Annual mean of the index rows (return flag N)."""
    return _cpi(Tables(spark, sf_dir))


@query(
    "purchasing_ratio",
    _with(SAL_SQL, BY_REGION_SQL, PRICE_SQL, CPI_SQL)
    + f"""SELECT b.comunidad, b.anio, {_r('b.salario_medio', 'salario_medio')},
       {_r('c.ipc_valor', 'ipc_valor')},
       {_r('b.salario_medio / NULLIF(c.ipc_valor, 0)', 'poder_adquisitivo')}
FROM by_region b JOIN cpi c ON b.anio = c.anio""",
)
def purchasing_ratio(spark, sf_dir):
    """Q2 shape (J4 M1): wage / index joined on year."""
    t = Tables(spark, sf_dir)
    return marts.purchasing_power(_by_region(t), _cpi(t))


@query(
    "rebased_index",
    _with(
        SAL_SQL, BY_REGION_SQL, PRICE_SQL,
        """hpi AS (SELECT anio, avg(precio) AS ipv FROM pri
  WHERE indicador = 'R' AND precio IS NOT NULL GROUP BY anio)""",
        f"""nat AS (SELECT b.anio, b.salario_medio, h.ipv FROM by_region b
  JOIN hpi h ON b.anio = h.anio WHERE b.comunidad = '{NATIONAL_ROW}')""",
    )
    + f"""SELECT anio, {_r('salario_medio', 'salario_medio')}, {_r('ipv', 'ipv')},
  {_r(f"salario_medio / NULLIF((SELECT salario_medio FROM nat WHERE anio = {BASE_YEAR}), 0) * 100",
      'indice_salario')}
FROM nat""",
)
def rebased_index(spark, sf_dir):
    """Q3 shape (P4 J5 M2 M3 O2): national row, index rebased at a base year."""
    t = Tables(spark, sf_dir)
    hpi = marts.annual_hpi(blocks.testdata_prices(t), indicator="R", region=None)
    out = marts.housing_vs_wage(_by_region(t), hpi, national=NATIONAL_ROW, base_year=BASE_YEAR)
    return m.order_by(out, "anio")


GAP_SQL = _with(
    SAL_SQL,
    """wide AS (
  SELECT anio, ocupacion,
         avg(CASE WHEN sexo = 'O' THEN salario END) AS "O",
         avg(CASE WHEN sexo = 'F' THEN salario END) AS "F"
  FROM sal
  WHERE sexo IN ('O', 'F') AND ocupacion NOT IN ('Total', 'N/A') AND salario IS NOT NULL
  GROUP BY anio, ocupacion)""",
    """gap AS (
  SELECT anio, ocupacion, "O", "F", ("F" - "O") / NULLIF("F", 0) * 100 AS gap_pct
  FROM wide WHERE "O" IS NOT NULL AND "F" IS NOT NULL)""",
)


@query(
    "pivot_gap",
    GAP_SQL
    + f"""SELECT anio, ocupacion, {_r('"O"', 'O')}, {_r('"F"', 'F')}, {_r('gap_pct', 'gap_pct')}
FROM gap WHERE gap_pct BETWEEN -100 AND 100 AND "O" > 0 AND "F" > 0""",
)
def pivot_gap(spark, sf_dir):
    """Q4 shape (A9 P7 P8 P13 M4 M5 P10 P11): two-level pivot and gap."""
    return _gap(Tables(spark, sf_dir))


Q5_SQL = _with(
    SAL_SQL, BY_REGION_SQL, EMP_SQL,
    f"""unemp AS (SELECT comunidad, anio, avg(valor_empleo) AS tasa_paro_media FROM emp
  WHERE comunidad <> '{NATIONAL_ROW}' AND valor_empleo IS NOT NULL GROUP BY comunidad, anio)""",
    f"""q5 AS (SELECT b.comunidad, b.anio, b.salario_medio, u.tasa_paro_media
  FROM by_region b JOIN unemp u ON b.comunidad = u.comunidad AND b.anio = u.anio
  WHERE b.comunidad <> '{NATIONAL_ROW}')""",
)


@query(
    "region_rate_join",
    Q5_SQL
    + f"""SELECT comunidad, anio, {_r('salario_medio', 'salario_medio')},
  {_r('tasa_paro_media', 'tasa_paro_media')} FROM q5""",
)
def region_rate_join(spark, sf_dir):
    """Q5 shape (A4 P6 J6 O3): two-key join of two regional panels."""
    return m.order_by(_q5(Tables(spark, sf_dir)), "anio", "comunidad")


@query(
    "grouped_corr",
    Q5_SQL
    + f"""SELECT comunidad,
  {_r('covar_pop(tasa_paro_media, salario_medio) / NULLIF(stddev_pop(tasa_paro_media) * stddev_pop(salario_medio), 0)',
      'correlacion_pearson')}
FROM q5 GROUP BY comunidad""",
)
def grouped_corr(spark, sf_dir):
    """Q6 shape (A8 O4): Pearson correlation per region."""
    out = marts.unemployment_wage_corr(_q5(Tables(spark, sf_dir)))
    return m.order_by(out, "correlacion_pearson")


@query(
    "real_value",
    _with(
        SAL_SQL, PRICE_SQL, CPI_SQL,
        """nom AS (SELECT anio, avg(salario) AS salario_nominal FROM sal
  WHERE indicador = '1-URGENT' AND salario IS NOT NULL GROUP BY anio)""",
    )
    + f"""SELECT n.anio, {_r('n.salario_nominal', 'salario_nominal')}, {_r('c.ipc_valor', 'ipc_valor')},
  {_r('n.salario_nominal / NULLIF(c.ipc_valor, 0) * 100', 'salario_real')}
FROM nom n JOIN cpi c ON n.anio = c.anio""",
)
def real_value(spark, sf_dir):
    """Q7 shape (A5 J7 M6): nominal series deflated by the annual index."""
    t = Tables(spark, sf_dir)
    out = marts.nominal_vs_real(blocks.testdata_salaries(t), _cpi(t), indicator="1-URGENT", region=None)
    return m.order_by(out, "anio")


SHARES_SQL = _with(
    EMP_SQL,
    f"""means AS (SELECT anio, indicador, avg(valor_empleo) AS v FROM emp
  WHERE indicador IN ('{SHARE_TOTAL}', '{SHARE_PART}') AND valor_empleo IS NOT NULL
  GROUP BY anio, indicador)""",
    f"""wide AS (SELECT anio,
  max(CASE WHEN indicador = '{SHARE_TOTAL}' THEN v END) AS "{SHARE_TOTAL}",
  max(CASE WHEN indicador = '{SHARE_PART}' THEN v END) AS "{SHARE_PART}"
  FROM means GROUP BY anio)""",
    f"""shares AS (SELECT anio, "{SHARE_TOTAL}", "{SHARE_PART}",
  "{SHARE_PART}" / NULLIF("{SHARE_TOTAL}", 0) * 100 AS share_pct,
  ("{SHARE_TOTAL}" - "{SHARE_PART}") / NULLIF("{SHARE_TOTAL}", 0) * 100 AS complement_pct
  FROM wide)""",
)


@query(
    "part_shares",
    SHARES_SQL
    + f"""SELECT anio, {_r(f'"{SHARE_TOTAL}"', SHARE_TOTAL)}, {_r(f'"{SHARE_PART}"', SHARE_PART)},
  {_r('share_pct', 'share_pct')}, {_r('complement_pct', 'complement_pct')} FROM shares""",
)
def part_shares(spark, sf_dir):
    """Q8 shape (A6 A10 M7 M8): unique pivot of two annual series, shares."""
    return m.order_by(_shares(Tables(spark, sf_dir)), "anio")


@query(
    "indicator_levels",
    _with(SAL_SQL)
    + f"""SELECT anio, indicador, {_r('avg(salario)', 'salario')} FROM sal
WHERE indicador IN ({", ".join(f"'{v}'" for v in LEVEL_SET)}) AND sexo = 'F' AND salario IS NOT NULL
GROUP BY anio, indicador""",
)
def indicator_levels(spark, sf_dir):
    """Q9 shape (A7 O5): annual level per statistic, sorted by (year, value)."""
    out = marts.wage_inequality(
        blocks.testdata_salaries(Tables(spark, sf_dir)), indicators=LEVEL_SET, region=None, sex="F"
    )
    return m.order_by(out, "anio", "salario")


@query(
    "latest_snapshot",
    GAP_SQL
    + f"""SELECT anio, ocupacion, {_r('"O"', 'O')}, {_r('"F"', 'F')}, {_r('gap_pct', 'gap_pct')}
FROM gap WHERE gap_pct BETWEEN -100 AND 100 AND "O" > 0 AND "F" > 0
  AND anio = (SELECT max(anio) FROM gap WHERE gap_pct BETWEEN -100 AND 100 AND "O" > 0 AND "F" > 0)""",
)
def latest_snapshot(spark, sf_dir):
    """Rows of the latest year, sorted by gap."""
    return m.order_by(m.latest(_gap(Tables(spark, sf_dir)), "anio"), "gap_pct")


@query(
    "shares_long",
    SHARES_SQL
    + f"""SELECT anio, 'share_pct' AS variable, {_r('share_pct', 'value')} FROM shares
UNION ALL
SELECT anio, 'complement_pct' AS variable, {_r('complement_pct', 'value')} FROM shares""",
)
def shares_long(spark, sf_dir):
    """Wide to long for the two share columns."""
    from statloom.operators.reshape import wide_to_long

    return wide_to_long(_shares(Tables(spark, sf_dir)), ["anio"], ["share_pct", "complement_pct"])


@query(
    "series_points",
    _with(SAL_SQL, BY_REGION_SQL)
    + f"SELECT comunidad AS series, anio AS x, {_r('salario_medio', 'y')} FROM by_region",
)
def series_points(spark, sf_dir):
    """Long-form series (group, x, y) for plotting."""
    from statloom.operators.reshape import series_points as points

    return points(_by_region(Tables(spark, sf_dir)), "comunidad", "anio", "salario_medio")


@query("local_trend", None)
def local_trend(spark, sf_dir):
    """R2: LOWESS trend of wage against the regional rate, over every point of
    the region_rate_join panel (exact; checked against a loop in tests)."""
    from statloom.operators.lowess import lowess

    return lowess(_q5(Tables(spark, sf_dir)), "tasa_paro_media", "salario_medio", out="trend")
