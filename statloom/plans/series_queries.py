"""Queries that run the ingest code itself: readers, routing, name parsing,
filters, periods, rejects and the load, on series documents written from the
``orders`` table as JSON Lines.

Every order is one document with one observation. Which table it belongs to,
how its name reads and what is wrong with it follow from the order key, so
that all seven tables, both spellings of the period key, NULL values, NULL key
parts, short names, malformed lines and bad codes occur.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions import labels as L
from statloom.operators import star
from statloom.operators.reshape import wide_to_long
from statloom.plans import ingest, marts
from statloom.plans.blocks import star_blocks
from statloom.plans.testdata import query
from statloom.session import shared_path
from statloom.sources.series_json import read_series_files, read_series_lines, schema_report
from statloom.sources.tables import Tables

CODES = (*L.LOAD_ORDER, 99999)
KINDS = ("Índice", "Variación anual", "Variación mensual", "Índice")
CONTRACTS = ("Total asalariados", "Asalariados con contrato temporal", "Otro contrato", "Total asalariados")
PERCENTILES = ("Media", "\t50 ", "75", "10")


def _every(n: int) -> Column:
    return F.col("k") % n == 0


def _pick(values, by: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), by.cast("int") + 1)


def series_lines(orders: DataFrame) -> DataFrame:
    """JSON Lines of the documents (column ``value``), one per order."""
    s = orders.select(
        F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("mo"),
        F.quarter("o_orderdate").alias("q"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("st"),
    )
    code, v, final = _pick(CODES, F.col("k") % 8), F.floor(F.col("k") / 8) % 4, F.col("st") == "F"
    part = lambda yes, no: F.when(final, F.lit(yes)).otherwise(F.lit(no))
    names = {
        L.CPI: ["Total Nacional", part("Índice general", "Alimentos"), _pick(KINDS, v)],
        L.HPI: ["Total Nacional", part("General", "Vivienda nueva"), _pick(KINDS, v)],
        L.UNEMPLOYMENT_RATE: ["Tasa de paro", "Ambos sexos", part("Andalucía", "Total Nacional"), "Todas las edades"],
        L.EMPLOYEES_BY_CONTRACT: ["Total Nacional", "Asalariados", "Ambos sexos", _pick(CONTRACTS, v),
                                  F.when(F.col("st") == "P", F.lit("Jornada a tiempo parcial")).otherwise(F.lit("Jornada Total")), "Personas"],
        L.WAGES_BY_OCCUPATION: [F.concat(F.lit("Grupo "), F.col("st")), "Mujeres", "Salario", "Total Nacional", "Dato"],
        L.WAGE_PERCENTILES: ["Total", "Andalucía", "Dato base", _pick(PERCENTILES, v)],
        L.LABOUR_COST: ["Total Nacional", "Industria", _pick(["Coste salarial total"] * 2 + ["Otros costes", "Coste salarial total"], v), "Euros"],
    }
    name = F.lit("Otra. Tabla. X.")
    for c, parts in names.items():
        text = F.concat(*(x for p in parts for x in (p if isinstance(p, Column) else F.lit(p), F.lit(". "))))
        name = F.when(code == c, text).otherwise(name)
    name = F.when(_every(97), F.lit("Solo un nombre")).otherwise(F.regexp_replace(name, "\t", r"\\t"))
    usual = F.when(code == L.CPI, F.col("mo")).when(_every(11), F.lit(28)).otherwise(F.col("q") + 18).cast("string")
    period = F.when(_every(13), F.lit('"T1"')).when(_every(17), F.lit("0")).when(_every(19), F.concat(usual, F.lit(".0"))).otherwise(usual)
    spelling = F.when(_every(5), F.lit("Fk_Periodo")).otherwise(F.lit("FK_Periodo"))
    fields = [
        F.concat(F.lit('"Anyo": '), F.when(_every(31), F.lit("null")).otherwise(F.col("y").cast("string"))),
        F.when(~_every(23), F.concat(F.lit('"'), spelling, F.lit('": '), period)),
        F.concat(F.lit('"Valor": '), F.when(_every(29), F.lit("null")).otherwise(F.col("price").cast("string"))),
    ]
    one = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    data = F.when(_every(103), one).otherwise(F.concat(F.lit("["), one, F.lit("]")))  # an object is no list of observations
    line = F.concat(F.lit('{"table_code": '), code.cast("string"), F.lit(', "series_pos": '), F.col("k").cast("string"),
                    F.lit(', "Nombre": "'), name, F.lit('", "Data": '), data, F.lit("}"))
    return s.select("k", "st", F.when(_every(101), F.substring(line, 1, 40)).otherwise(line).alias("value"))


def _raw(spark, lines: DataFrame) -> DataFrame:
    folder = shared_path(spark, "statloom-series", uuid.uuid4().hex)
    lines.select("value").write.text(folder)
    return read_series_lines(spark, folder)


def _prepared(spark, sf_dir: str) -> ingest.Batch:
    return ingest.prepare(_raw(spark, series_lines(Tables(spark, sf_dir).orders)), keep=lambda df: df.checkpoint(eager=True))


#: The same documents in SQL: s = series with status, o = their observations.
SERIES_SQL = """s0 AS (
  SELECT o_orderkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, month(o_orderdate) AS mo, quarter(o_orderdate) AS q,
    o_totalprice AS price, o_orderstatus AS st, (o_orderkey // 8) % 4 AS v,
    [50913, 25171, 65334, 65132, 28186, 28191, 6061, 99999][1 + o_orderkey % 8] AS code
  FROM orders),
s AS (
  SELECT *,
    CASE WHEN k % 101 = 0 THEN 'bad_document' WHEN k % 103 = 0 THEN 'bad_data' WHEN code = 99999 THEN 'unmapped_code'
      WHEN k % 97 = 0 THEN 'short_name'
      WHEN code = 50913 AND v = 2 OR code = 25171 AND (v = 2 OR st <> 'F') OR code = 65132 AND (v = 2 OR st = 'P')
        OR code IN (28191, 6061) AND v = 2 THEN 'filtered' END AS status
  FROM s0),
o AS (
  SELECT *, code IN (50913, 25171) AS price_table,
    CASE WHEN k % 31 <> 0 THEN y END AS anio,
    CASE WHEN k % 23 = 0 THEN 'missing' WHEN k % 13 = 0 THEN 'bad'
         WHEN k % 17 = 0 THEN CASE WHEN code IN (50913, 25171) THEN 'missing' ELSE 'bad' END
         WHEN code = 50913 THEN 'month' WHEN k % 11 = 0 AND k % 17 <> 0 THEN 'annual' ELSE 'quarter' END AS per
  FROM s WHERE status IS NULL),
p AS (
  SELECT k, code, st, v, anio, per,
    CASE per WHEN 'month' THEN CAST(mo AS INTEGER) WHEN 'quarter' THEN CAST(q * 3 - 2 AS INTEGER) END AS mes,
    CASE per WHEN 'quarter' THEN CAST(q AS INTEGER) END AS trimestre,
    CASE WHEN k % 29 <> 0 THEN price END AS valor,
    CASE WHEN anio IS NULL THEN 'null_year' WHEN per = 'bad' THEN 'bad_period' END AS reason,
    CASE WHEN code IN (50913, 25171) THEN 'T_precios' WHEN code IN (65334, 65132) THEN 'T_empleo' ELSE 'T_salarios' END AS fact_table,
    CASE WHEN code = 50913 THEN CASE WHEN v = 1 THEN 'IPC_Variacion_Anual' ELSE 'IPC_Indice' END
      WHEN code = 25171 THEN CASE WHEN v = 1 THEN 'IPV_Variacion_Anual' ELSE 'IPV_Indice' END
      WHEN code = 65334 THEN 'Tasa_Paro' WHEN code = 65132 THEN CASE WHEN v = 1 THEN 'Asalariados_Temporal' ELSE 'Asalariados_Total' END
      WHEN code = 28186 THEN 'Salario_Anual_Ocupacion'
      WHEN code = 28191 THEN ['Salario_Anual_Media', 'Salario_Anual_Mediana', '', 'Salario_Anual_Percentil 10'][1 + v]
      ELSE 'Salario_Coste_Trimestral' END AS indicador,
    CASE WHEN code = 65132 THEN 'Miles de personas' WHEN code IN (28186, 28191, 6061) THEN 'Euros' WHEN code = 65334 OR v = 1 THEN '%'
      WHEN code = 50913 THEN 'Base 2021=100' ELSE 'Base 2015=100' END AS unidad,
    CASE WHEN code = 28191 OR code = 65334 AND st = 'F' THEN 'Andalucía' ELSE 'Total Nacional' END AS geografia,
    CASE WHEN code = 50913 THEN CASE WHEN st = 'F' THEN 'IPC General' ELSE 'Alimentos' END WHEN code = 25171 THEN 'Vivienda Total' END AS categoria,
    CASE WHEN code IN (65334, 65132) THEN 'Ambos sexos' WHEN code = 28186 THEN 'Mujeres' WHEN code IN (28191, 6061) THEN 'Total' END AS sexo,
    CASE WHEN code = 6061 THEN 'Industria' WHEN code IN (28186, 28191) THEN 'N/A' END AS sector,
    CASE WHEN code = 28186 THEN 'Grupo ' || st WHEN code IN (28191, 6061) THEN 'N/A' END AS ocupacion,
    CASE WHEN code = 65334 THEN 'Todas las edades' END AS edad,
    CASE WHEN code = 65132 THEN 'Jornada Total' END AS jornada,
    CASE WHEN code = 65132 THEN ['Total asalariados', 'Asalariados con contrato temporal', '', 'Total asalariados'][1 + v] END AS contrato
  FROM o)"""

DETAILS = ["geografia", "categoria", "sexo", "sector", "ocupacion", "edad", "jornada", "contrato"]


def _named(obs: DataFrame, *extra: str) -> DataFrame:
    return obs.select(
        *extra, "anio", "mes", "trimestre", "fact_table", F.col("indicador_nombre").alias("indicador"), "unidad", "geografia",
        F.col("categoria_gasto").alias("categoria"), "sexo", F.col("sector_cnae").alias("sector"), F.col("ocupacion_cno11").alias("ocupacion"),
        F.col("grupo_edad").alias("edad"), F.col("tipo_jornada").alias("jornada"), F.col("tipo_contrato").alias("contrato"), "valor",
    )


@query(
    "series_observations",
    "WITH " + SERIES_SQL + """
SELECT k AS series_pos, anio, CAST(mes AS DOUBLE) AS mes, CAST(trimestre AS DOUBLE) AS trimestre, fact_table, indicador, unidad,
  """ + ", ".join(DETAILS) + ", valor FROM p WHERE reason IS NULL",
    widen=("mes", "trimestre"),
)
def q_series_observations(spark, sf_dir):
    """Documents read, routed, parsed and
    flattened by the ingest code."""
    batch = _prepared(spark, sf_dir)
    return _named(batch.obs, "series_pos")


#: Order keys of one array file of a table.
KEYS_A_FILE = 100_000


def _array_files(spark, docs: DataFrame) -> str:
    """The documents as JSON array files, in the order of their keys: a folder for
    each table, in it a folder with one file for each range of keys."""
    folder = shared_path(spark, "statloom-arrays", uuid.uuid4().hex)
    docs = docs.withColumn("part", F.lpad(F.floor(F.col("k") / KEYS_A_FILE).cast("string"), 12, "0"))
    file = Window.partitionBy("table_code", "part")
    rank, n = F.row_number().over(file.orderBy("k")), F.count(F.lit(1)).over(file)
    line = F.concat(F.when(rank == 1, F.lit("[")).otherwise(F.lit(",")), "value", F.when(rank == n, F.lit("]")).otherwise(F.lit("")))
    docs = docs.select(line.alias("value"), "table_code", "part", "k").sortWithinPartitions("table_code", "part", "k")
    docs.drop("k").write.partitionBy("table_code", "part").text(folder)
    return folder


@query(
    "series_files",
    "WITH " + SERIES_SQL + """
SELECT fact_table, indicador, anio, CAST(mes AS DOUBLE) AS mes, CAST(trimestre AS DOUBLE) AS trimestre, """ + ", ".join(DETAILS) + """,
  count(*) AS n, arg_min(valor, k) AS first_valor, arg_max(valor, k) AS last_valor
FROM p WHERE reason IS NULL AND valor IS NOT NULL GROUP BY fact_table, indicador, anio, mes, trimestre, """ + ", ".join(DETAILS),
    widen=("mes", "trimestre"),
)
def q_series_files(spark, sf_dir):
    """Table files that hold one array of documents each, read by
    byte ranges; of each fact key the number of observations, and the first and
    last in the files' order. (A document cut off in the middle would break
    its array; those are in the JSON Lines queries.)"""
    docs = series_lines(Tables(spark, sf_dir).orders).where("k % 101 <> 0").withColumn("table_code", _pick(CODES, F.col("k") % 8))
    batch = ingest.prepare(read_series_files(spark, _array_files(spark, docs)))
    obs = _named(batch.obs, "series_pos", "obs_pos").where("valor IS NOT NULL").drop("unidad")
    place = F.struct("series_pos", "obs_pos")
    return obs.groupBy("fact_table", "indicador", "anio", "mes", "trimestre", *DETAILS).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("valor", place).alias("first_valor"), F.max_by("valor", place).alias("last_valor")
    )


@query(
    "series_rejects",
    "WITH " + SERIES_SQL + """, r AS (
  SELECT CASE WHEN status = 'bad_document' THEN NULL ELSE k END AS series_pos, status AS reason FROM s WHERE status IS NOT NULL
  UNION ALL SELECT k, reason FROM p WHERE reason IS NOT NULL
  UNION ALL SELECT k, 'null_valor' FROM p WHERE reason IS NULL AND valor IS NULL)
SELECT reason, count(*) AS n, CAST(count(series_pos) AS BIGINT) AS n_named, CAST(coalesce(sum(series_pos), 0) AS BIGINT) AS positions
FROM r GROUP BY reason""",
)
def q_series_rejects(spark, sf_dir):
    """What is not loaded, with its reason (malformed documents
    keep their text and have no position)."""
    batch = _prepared(spark, sf_dir)
    _, nulls = star.split_rejects(batch.obs.select("series_pos", "valor"), star.not_null_checks(["valor"]))
    parts = batch.rejects.select("series_pos", F.col("reject_reason").alias("reason"))
    parts = parts.unionByName(batch.filtered.select("series_pos", F.lit("filtered").alias("reason")))
    parts = parts.unionByName(nulls.select("series_pos", F.col("reject_reason").alias("reason")))
    # a broken line may have been read in part: only its text counts
    position = F.when(F.col("reason") != "bad_document", F.col("series_pos"))
    return parts.groupBy("reason").agg(
        F.count("*").alias("n"), F.count(position).alias("n_named"), F.coalesce(F.sum(position), F.lit(0)).alias("positions")
    )


@query(
    "series_load",
    "WITH " + SERIES_SQL + """, f AS (
  SELECT *, CASE WHEN st = 'F' THEN 0 ELSE 1 END AS load,
    list_position([50913, 25171, 65334, 65132, 28186, 28191, 6061], code) AS place
  FROM p WHERE reason IS NULL AND valor IS NOT NULL)
SELECT anio, CAST(mes AS DOUBLE) AS mes, CAST(trimestre AS DOUBLE) AS trimestre, fact_table, indicador, """ + ", ".join(DETAILS) + """,
  arg_min(valor, load * 1000000000000 + place * 100000000000 + k) AS valor
FROM f GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY anio, mes, trimestre, fact_table, indicador, " + ", ".join(DETAILS)),
    widen=("mes", "trimestre"),
)
def q_series_load(spark, sf_dir):
    """Two loads into a star (finished orders first, then
    all): first write wins, NULL key parts match, dimensions grow."""
    lines = series_lines(Tables(spark, sf_dir).orders)
    store = ingest.StarStore(spark, shared_path(spark, "statloom-stars", uuid.uuid4().hex))
    ingest.load(_raw(spark, lines.filter("st = 'F'")), store)
    ingest.load(_raw(spark, lines), store)
    return _named_facts(store.tables()).drop("unidad")


def _named_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts of all three tables with the members of their dimensions."""
    out = None
    for fact in ingest.FACT_SCHEMAS:
        df = tables[fact].join(tables["tbl_periodo"], "id_periodo").join(tables["tbl_geografia"].withColumnRenamed("nombre", "geografia"), "id_geografia")
        df = df.join(tables["tbl_indicador"].select("id_indicador", F.col("nombre").alias("indicador_nombre"), "unidad"), "id_indicador")
        for c in ("categoria_gasto", "sexo", "sector_cnae", "ocupacion_cno11", "grupo_edad", "tipo_jornada", "tipo_contrato"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        part = _named(df.withColumn("fact_table", F.lit(fact)))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "versioned_load",
    "WITH " + SERIES_SQL + """, f AS (
  SELECT *, list_position([50913, 25171, 65334, 65132, 28186, 28191, 6061], code) * 100000000000 + k AS place
  FROM p WHERE reason IS NULL AND valor IS NOT NULL),
v1 AS (
  SELECT fact_table, indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """, arg_min(valor, place) AS valor
  FROM f WHERE st = 'F' GROUP BY fact_table, indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """),
v2 AS (
  SELECT fact_table, indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """, arg_max(valor, place) AS valor
  FROM f GROUP BY fact_table, indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """)
SELECT 1 AS version, fact_table, indicador, count(*) AS n, round(sum(valor), 6) AS total FROM v1 GROUP BY fact_table, indicador
UNION ALL SELECT 2, fact_table, indicador, count(*), round(sum(valor), 6) FROM v2 GROUP BY fact_table, indicador""",
)
def q_versioned_load(spark, sf_dir):
    """Finished orders are loaded; a load of all orders stops before
    it ends, which changes nothing; then it runs again with ``update``. Both
    versions are read from the same folders."""
    lines = series_lines(Tables(spark, sf_dir).orders)
    store = ingest.StarStore(spark, shared_path(spark, "statloom-stars", uuid.uuid4().hex))
    ingest.load(_raw(spark, lines.filter("st = 'F'")), store)
    raw = _raw(spark, lines)
    stopped = store.begin()
    batch = ingest.prepare(raw)
    stopped.write("tbl_geografia", star.extend_dimension(stopped.read("tbl_geografia"), ingest.dimension_batches(batch)["tbl_geografia"],
                                                         ["nombre"], "id_geografia", ingest.ORDER))
    ingest.load(raw, store, conflict="update")  # what was written above is never seen
    out = None
    for version in store.numbers():
        facts = _named_facts(store.tables(version)).groupBy("fact_table", F.col("indicador").alias("indicador"))
        part = facts.agg(F.count("*").alias("n"), F.sum("valor").alias("total")).select(F.lit(version).alias("version"), "*")
        out = part if out is None else out.unionByName(part)
    return out


#: Marts of a loaded star that ``star_mart`` gives, with their measures.
STAR_MARTS = {
    "Relacion_Poder_Adquisitivo": ("salario_medio", "ipc_valor", "poder_adquisitivo"),
    "Relacion_Paro_Salarios": ("salario_medio", "tasa_paro_media"),
    "Salario_Nominal_vs_Real": ("salario_nominal", "ipc_valor", "salario_real"),
    "Calidad_Empleo": ("Asalariados_Total", "Asalariados_Temporal", "Temporal (%)", "Indefinido (%)"),
}


@query(
    "star_mart",
    "WITH " + SERIES_SQL + """, facts AS (
  SELECT indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """,
    arg_min(valor, list_position([50913, 25171, 65334, 65132, 28186, 28191, 6061], code) * 100000000000 + k) AS valor
  FROM p WHERE reason IS NULL AND valor IS NOT NULL GROUP BY indicador, anio, mes, trimestre, """ + ", ".join(DETAILS) + """),
w AS (SELECT geografia AS comunidad, anio, avg(valor) AS salario FROM facts WHERE indicador = 'Salario_Anual_Media' GROUP BY 1, 2),
c AS (SELECT anio, avg(valor) AS ipc FROM facts
  WHERE indicador = 'IPC_Indice' AND geografia = 'Total Nacional' AND categoria = 'IPC General' GROUP BY 1),
u AS (SELECT geografia AS comunidad, anio, avg(valor) AS paro FROM facts
  WHERE indicador = 'Tasa_Paro' AND geografia <> 'Total Nacional' AND sexo = 'Ambos sexos' AND edad = 'Todas las edades' GROUP BY 1, 2),
n AS (SELECT anio, avg(valor) AS nominal FROM facts WHERE indicador = 'Salario_Coste_Trimestral' AND geografia = 'Total Nacional' GROUP BY 1),
e AS (SELECT anio, avg(valor) FILTER (indicador = 'Asalariados_Total') AS total, avg(valor) FILTER (indicador = 'Asalariados_Temporal') AS part
  FROM facts WHERE indicador IN ('Asalariados_Total', 'Asalariados_Temporal') AND geografia = 'Total Nacional' GROUP BY 1),
m AS (
  SELECT 'Relacion_Poder_Adquisitivo' AS mart, comunidad, w.anio, unnest(['salario_medio', 'ipc_valor', 'poder_adquisitivo']) AS variable,
    unnest([salario, ipc, salario / ipc]) AS value FROM w JOIN c ON w.anio = c.anio
  UNION ALL SELECT 'Relacion_Paro_Salarios', w.comunidad, w.anio, unnest(['salario_medio', 'tasa_paro_media']), unnest([salario, paro])
    FROM w JOIN u ON w.anio = u.anio AND w.comunidad = u.comunidad WHERE w.comunidad <> 'Total Nacional'
  UNION ALL SELECT 'Salario_Nominal_vs_Real', NULL, n.anio, unnest(['salario_nominal', 'ipc_valor', 'salario_real']),
    unnest([nominal, ipc, nominal / ipc * 100]) FROM n JOIN c ON n.anio = c.anio
  UNION ALL SELECT 'Calidad_Empleo', NULL, anio, unnest(['Asalariados_Total', 'Asalariados_Temporal', 'Temporal (%)', 'Indefinido (%)']),
    unnest([total, part, part / total * 100, (total - part) / total * 100]) FROM e)
SELECT mart, comunidad, anio, variable, round(value, 6) AS value FROM m""",
)
def q_star_mart(spark, sf_dir):
    """Documents are loaded into a star, the blocks
    are read from its partitioned facts, and the marts run on them with their
    own filters. A filter on the indicator's name prunes the fact partitions
    when the query runs."""
    store = ingest.StarStore(spark, shared_path(spark, "statloom-stars", uuid.uuid4().hex))
    ingest.load(_raw(spark, series_lines(Tables(spark, sf_dir).orders)), store)
    built = marts.build_marts(*star_blocks(store.tables()), reuse=lambda df: df.checkpoint(eager=True))
    out = None
    for name, measures in STAR_MARTS.items():
        df = built[name]
        if "comunidad" not in df.columns:
            df = df.withColumn("comunidad", F.lit(None).cast("string"))
        part = wide_to_long(df, ["comunidad", "anio"], measures).select(F.lit(name).alias("mart"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "json_schema_report",
    """WITH d AS (SELECT event_type, props, json_valid(props) AS ok FROM events),
k AS (SELECT event_type, '$.' || unnest(json_keys(props)) AS path, props FROM d WHERE ok AND json_type(props) = 'OBJECT'),
t AS (SELECT event_type, path, json_type(json_extract(props, path)) AS ty FROM k
      UNION ALL SELECT event_type, '$', json_type(props) FROM d WHERE ok)
SELECT event_type, path, CASE WHEN ty IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN ty = 'DOUBLE' THEN 'float' WHEN ty = 'VARCHAR' THEN 'string'
    WHEN ty = 'BOOLEAN' THEN 'bool' ELSE lower(ty) END AS type, count(*) AS n FROM t GROUP BY 1, 2, 3
UNION ALL
SELECT event_type, NULL, 'invalid', count(*) FILTER (WHERE NOT ok) FROM d GROUP BY event_type""",
)
def q_json_schema_report(spark, sf_dir):
    """Types of every path of every JSON document, per event type."""
    return schema_report(Tables(spark, sf_dir).events, "props", ("event_type",))
