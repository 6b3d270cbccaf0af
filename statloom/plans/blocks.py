"""Master blocks: a fact table joined with its dimensions, renamed.

``star_blocks`` builds the three blocks of the indicator star schema (facts
joined with period, region and indicator). The ``testdata_*`` functions build
blocks with the same column names from the TPC-H-like tables, so the marts run
on them unchanged:

* salaries   <- orders x customer x nation (o_totalprice by customer nation,
  order year; indicator = priority, sex level = order status, occupation =
  market segment)
* prices     <- lineitem x orders x part (l_extendedprice by ship year;
  indicator = return flag, region = order status, category = part type)
* employment <- lineitem x supplier x nation (l_discount by supplier nation,
  ship year; indicator = return flag, sex level = line status, age group =
  line number)

No join is hinted: Spark broadcasts dimensions whose files are small, AQE those
it has measured to be small, and larger ones (and fact-to-fact joins) are
sort-merge joins, split by AQE where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.sources.tables import Tables


def _star(fact: DataFrame, periods: DataFrame, indicators: DataFrame, regions: DataFrame) -> DataFrame:
    per = periods.select("id_periodo", "anio")
    ind = indicators.select("id_indicador", F.col("nombre").alias("indicador"))
    reg = regions.select("id_geografia", F.col("nombre").alias("comunidad"))
    return fact.join(reg, "id_geografia").join(per, "id_periodo").join(ind, "id_indicador")


def salaries_block(wages: DataFrame, periods, indicators, regions) -> DataFrame:
    return _star(wages, periods, indicators, regions).select(
        F.col("valor").alias("salario"), "comunidad", "anio", "indicador", "sexo",
        F.col("ocupacion_cno11").alias("ocupacion"),
    )


def prices_block(prices: DataFrame, periods, indicators, regions) -> DataFrame:
    return _star(prices, periods, indicators, regions).select(
        F.col("valor").alias("precio"), "comunidad", "anio", "indicador", "categoria_gasto"
    )


def employment_block(employment: DataFrame, periods, indicators, regions) -> DataFrame:
    return _star(employment, periods, indicators, regions).select(
        F.col("valor").alias("valor_empleo"), "comunidad", "anio", "indicador", "sexo", "grupo_edad"
    )


def star_blocks(star: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(salaries, prices, employment) from a dict of the six star tables."""
    dims = (star["tbl_periodo"], star["tbl_indicador"], star["tbl_geografia"])
    return (
        salaries_block(star["T_salarios"], *dims),
        prices_block(star["T_precios"], *dims),
        employment_block(star["T_empleo"], *dims),
    )


def _year(c: str):
    return F.year(c).cast("int")


def testdata_salaries(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    out = orders.join(customer, "o_custkey").join(nation, "c_nationkey")
    return out.select(
        F.col("o_totalprice").alias("salario"),
        F.col("n_name").alias("comunidad"),
        _year("o_orderdate").alias("anio"),
        F.col("o_orderpriority").alias("indicador"),
        F.col("o_orderstatus").alias("sexo"),
        F.col("c_mktsegment").alias("ocupacion"),
    )


def testdata_prices(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    out = lines.join(orders, "l_orderkey").join(part, "l_partkey")
    return out.select(
        F.col("l_extendedprice").alias("precio"),
        F.col("o_orderstatus").alias("comunidad"),
        _year("l_shipdate").alias("anio"),
        F.col("l_returnflag").alias("indicador"),
        F.col("p_type").alias("categoria_gasto"),
    )


def testdata_employment(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_suppkey", "l_discount", "l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber"
    )
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    out = lines.join(supplier, "l_suppkey").join(nation, "s_nationkey")
    return out.select(
        F.col("l_discount").alias("valor_empleo"),
        F.col("n_name").alias("comunidad"),
        _year("l_shipdate").alias("anio"),
        F.col("l_returnflag").alias("indicador"),
        F.col("l_linestatus").alias("sexo"),
        F.col("l_linenumber").cast("string").alias("grupo_edad"),
    )
