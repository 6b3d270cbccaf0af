"""Queries exercising the ingest operators on the test tables.

Same registry as ``plans.testdata``: name -> (spark_fn, oracle_sql).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from statloom.functions.labels import contains
from statloom.functions.names import name_parts, norm_label, part, part_or
from statloom.functions.periods import normalise_period
from statloom.operators import star
from statloom.plans.testdata import REGISTRY, query
from statloom.session import shared_path
from statloom.sources.tables import Tables
from statloom.sources.versioned import VersionedTables


@query(
    "name_parts",
    """WITH s AS (
  SELECT p_partkey,
         list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: x <> '') AS parts
  FROM part)
SELECT p_partkey, CAST(len(parts) AS INTEGER) AS n_parts, parts[1] AS first, parts[2] AS second,
       coalesce(parts[3], 'N/A') AS third, lower(trim(parts[2])) AS second_norm
FROM s""",
)
def q_name_parts(spark, sf_dir):
    """Split on a separator, strip, drop blanks, pick by position."""
    p = Tables(spark, sf_dir).part.select("p_partkey", name_parts("p_name", " ").alias("parts"))
    return p.select(
        "p_partkey",
        F.size("parts").alias("n_parts"),
        part("parts", 0).alias("first"),
        part("parts", 1).alias("second"),
        part_or("parts", 2, "N/A").alias("third"),
        norm_label(part("parts", 1)).alias("second_norm"),
    )


LABEL_SQL = """WITH s AS (
  SELECT p_partkey, p_name, p_type,
         list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: x <> '') AS parts
  FROM part),
c AS (
  SELECT p_partkey, p_name, p_type, parts,
    contains(p_name, 'ring') OR (contains(p_name, 'gear') AND NOT contains(p_name, 'small')) AS kind_ok,
    CASE WHEN contains(p_name, 'ring') THEN 'Ring' WHEN contains(p_name, 'gear') THEN 'Gear' END AS kind,
    CASE lower(trim(parts[1])) WHEN 'small' THEN 'Size_S' WHEN 'large' THEN 'Size_L'
         WHEN 'hot' THEN 'Temp_H' WHEN 'cold' THEN 'Temp_C' END AS size_label
  FROM s)
SELECT p_partkey,
  CASE WHEN p_type = 'PROMO' THEN 'Promo Total' WHEN p_type = 'STANDARD' THEN 'Standard General'
       ELSE p_type END AS category,
  concat(upper(parts[1]), '_', kind) AS indicator,
  CASE WHEN kind = 'Gear' THEN 'units' ELSE '%' END AS unit,
  size_label
FROM c
WHERE len(parts) >= 2 AND kind_ok AND p_type <> 'SMALL' AND size_label IS NOT NULL"""


@query("label_map", LABEL_SQL)
def q_label_map(spark, sf_dir):
    """Contains-filters, normalised category, indicator
    name and unit, label mapping after lower+strip."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_type", name_parts("p_name", " ").alias("parts"))
    name = F.col("p_name")
    kind_ok = contains(name, "ring") | (contains(name, "gear") & ~contains(name, "small"))  # P14 shape
    kind = F.when(contains(name, "ring"), F.lit("Ring")).when(contains(name, "gear"), F.lit("Gear"))
    first = norm_label(part("parts", 0))
    size_label = (  # P18: fixed label map, others drop
        F.when(first == "small", F.lit("Size_S")).when(first == "large", F.lit("Size_L"))
        .when(first == "hot", F.lit("Temp_H")).when(first == "cold", F.lit("Temp_C"))
    )
    category = (  # F3
        F.when(F.col("p_type") == "PROMO", F.lit("Promo Total"))
        .when(F.col("p_type") == "STANDARD", F.lit("Standard General"))
        .otherwise(F.col("p_type"))
    )
    out = p.select(
        "p_partkey",
        category.alias("category"),
        F.concat(F.upper(part("parts", 0)), F.lit("_"), kind).alias("indicator"),  # F4
        F.when(kind == "Gear", F.lit("units")).otherwise(F.lit("%")).alias("unit"),  # F5
        size_label.alias("size_label"),
        (F.size("parts") >= 2).alias("_named"),  # P21
        kind_ok.alias("_kind_ok"),
        (F.col("p_type") != "SMALL").alias("_type_ok"),  # P15 shape
    )
    return out.filter("_named AND _kind_ok AND _type_ok AND size_label IS NOT NULL").drop(
        "_named", "_kind_ok", "_type_ok"
    )


@query(
    "json_observations",
    """WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
SELECT event_id, key, json_extract_string(props, '$.' || key) AS value_text,
  CAST(TRY_CAST(coalesce(nullif(json_extract_string(props, '$.k'), '0'), json_extract_string(props, '$.K'))
                AS INTEGER) AS DOUBLE) AS k_value
FROM k""",
    widen=("k_value",),
)
def q_json_observations(spark, sf_dir):
    """JSON text read with a declared map schema, flattened to one row
    per entry; a case-variant key read as either spelling (0 = missing)."""
    ev = Tables(spark, sf_dir).events.select(
        "event_id", F.from_json("props", "map<string,string>").alias("m")
    )
    m = F.col("m")
    k = F.coalesce(F.nullif(m["k"], F.lit("0")), m["K"]).try_cast("int")
    return ev.select("event_id", F.explode("m").alias("key", "value_text"), k.alias("k_value"))


PERIOD_SQL = """pk AS (
  SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS anio,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(month(o_orderdate) AS INTEGER) END AS mes,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
         WHEN o_orderpriority = '5-LOW' THEN NULL
         ELSE CAST(quarter(o_orderdate) AS INTEGER) END AS trimestre
  FROM orders),
pkd AS (
  SELECT o_orderkey, o_orderstatus, anio,
    CASE WHEN mes IS NOT NULL THEN mes WHEN trimestre IS NOT NULL THEN (trimestre - 1) * 3 + 1 END AS mes,
    trimestre
  FROM pk),
periods AS (
  SELECT o_orderkey, o_orderstatus, anio, mes, trimestre, make_date(anio, coalesce(mes, 1), 1) AS fecha_iso
  FROM pkd)"""


def _period_rows(t: Tables):
    o = t.orders
    monthly = F.col("o_orderpriority") == "1-URGENT"
    annual = F.col("o_orderpriority") == "5-LOW"
    code = F.when(annual, F.lit(28)).otherwise(F.lit(18) + F.quarter("o_orderdate"))  # F10, F12
    month = F.when(monthly, F.month("o_orderdate"))
    period = normalise_period(F.year("o_orderdate"), month, F.when(~monthly, code))
    return o.select("o_orderkey", "o_orderstatus", period.alias("p")).select(
        "o_orderkey", "o_orderstatus", "p.anio", "p.mes", "p.trimestre", "p.fecha_iso"
    )


PORTABLE_PERIOD = ("anio, CAST(mes AS DOUBLE) AS mes, CAST(trimestre AS DOUBLE) AS trimestre, "
                   "strftime(fecha_iso, '%Y-%m-%d') AS fecha_iso")


@query(
    "period_keys",
    "WITH " + PERIOD_SQL + f"\nSELECT o_orderkey, {PORTABLE_PERIOD} FROM periods",
    widen=("mes", "trimestre"),
)
def q_period_keys(spark, sf_dir):
    """Month / quarter / year periods with ISO dates."""
    return _period_rows(Tables(spark, sf_dir)).drop("o_orderstatus")


@query(
    "dim_extend",
    """WITH cand AS (
  SELECT p_type AS nombre, arg_min(p_brand, p_partkey) AS unidad, min(p_partkey) AS first_seen
  FROM part GROUP BY p_type),
new AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM region r WHERE r.r_name = c.nombre))
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS nombre, CAST(NULL AS VARCHAR) AS unidad FROM region
UNION ALL
SELECT CAST((SELECT max(r_regionkey) FROM region) + row_number() OVER (ORDER BY first_seen, nombre) AS BIGINT),
       nombre, unidad
FROM new""",
)
def q_dim_extend(spark, sf_dir):
    """Get-or-create members of a dimension; the attribute comes
    from the first occurrence; new ids follow the current maximum."""
    t = Tables(spark, sf_dir)
    existing = t.region.select(
        F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("nombre"),
        F.lit(None).cast("string").alias("unidad"),
    )
    batch = t.part.select(F.col("p_type").alias("nombre"), F.col("p_brand").alias("unidad"), "p_partkey")
    new = star.extend_dimension(existing, batch, ["nombre"], "id", ["p_partkey"], ["unidad"])
    return existing.unionByName(new)


@query(
    "dim_period",
    "WITH " + PERIOD_SQL + """,
ex_c AS (
  SELECT anio, mes, trimestre, arg_min(fecha_iso, o_orderkey) AS fecha_iso, min(o_orderkey) AS first_seen
  FROM periods WHERE o_orderstatus = 'F' GROUP BY anio, mes, trimestre),
ex AS (
  SELECT CAST(row_number() OVER (ORDER BY first_seen) AS BIGINT) AS id_periodo, anio, mes, trimestre, fecha_iso
  FROM ex_c),
all_c AS (
  SELECT anio, mes, trimestre, arg_min(fecha_iso, o_orderkey) AS fecha_iso, min(o_orderkey) AS first_seen
  FROM periods GROUP BY anio, mes, trimestre),
new AS (
  SELECT a.* FROM all_c a WHERE NOT EXISTS (
    SELECT 1 FROM ex e WHERE e.anio IS NOT DISTINCT FROM a.anio AND e.mes IS NOT DISTINCT FROM a.mes
      AND e.trimestre IS NOT DISTINCT FROM a.trimestre)),
dims AS (
  SELECT * FROM ex
  UNION ALL
  SELECT CAST((SELECT max(id_periodo) FROM ex) + row_number() OVER (ORDER BY first_seen) AS BIGINT),
         anio, mes, trimestre, fecha_iso
  FROM new)
SELECT id_periodo, """ + PORTABLE_PERIOD + " FROM dims",
    widen=("mes", "trimestre"),
)
def q_dim_period(spark, sf_dir):
    """D3: period dimension keyed on (year, month, quarter) where NULL = NULL;
    built in two loads (status F first, then everything)."""
    rows = _period_rows(Tables(spark, sf_dir))
    keys, attrs = ["anio", "mes", "trimestre"], ["fecha_iso"]
    empty = rows.sparkSession.createDataFrame(
        [], "id_periodo long, anio int, mes int, trimestre int, fecha_iso date"
    )
    first = star.extend_dimension(
        empty, rows.filter(F.col("o_orderstatus") == "F"), keys, "id_periodo", ["o_orderkey"], attrs
    )
    second = star.extend_dimension(first, rows, keys, "id_periodo", ["o_orderkey"], attrs)
    return first.unionByName(second)


CUT = "2024-01-16"


@query(
    "facts_ignore",
    f"""WITH e AS (SELECT user_id, nullif(event_type, 'view') AS event_type, CAST(ts AS DATE) AS day, event_id, value, ts FROM events),
ex AS (
  SELECT user_id, event_type, day, min(event_id) AS event_id, arg_min(value, event_id) AS value
  FROM e WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id, event_type, day),
b AS (
  SELECT user_id, event_type, day, min(event_id) AS event_id, arg_min(value, event_id) AS value
  FROM e GROUP BY user_id, event_type, day),
facts AS (
  SELECT * FROM ex
  UNION ALL
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM ex WHERE ex.user_id IS NOT DISTINCT FROM b.user_id
      AND ex.event_type IS NOT DISTINCT FROM b.event_type AND ex.day IS NOT DISTINCT FROM b.day))
SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id, value FROM facts""",
)
def q_facts_ignore(spark, sf_dir):
    """Insert-or-ignore a batch into stored facts (null-safe
    keys); inside the batch the first row by id wins; stored rows are kept. One event
    type counts as "not given", so keys have NULL parts."""
    ev = Tables(spark, sf_dir).events.select(
        "user_id", F.nullif("event_type", F.lit("view")).alias("event_type"), F.to_date("ts").alias("day"), "event_id", "value", "ts"
    )
    keys, order = ["user_id", "event_type", "day"], ["event_id"]
    cols = [*keys, "event_id", "value"]
    # the stored facts are a materialised table, as in a real load
    stored = star.first_wins(
        ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).select(*cols), keys, order
    ).checkpoint(eager=True)
    new = star.insert_or_ignore(stored, ev.select(*cols), keys, order, nullable=["event_type"])
    return stored.unionByName(new)


EVENT_FACTS = StructType(
    [StructField("user_id", LongType()), StructField("day", DateType()), StructField("event_id", LongType()), StructField("value", DoubleType()),
     StructField("event_type", StringType())]
)


@query(
    "facts_update",
    f"""WITH e AS (SELECT user_id, nullif(event_type, 'view') AS event_type, CAST(ts AS DATE) AS day, event_id, value, ts FROM events),
ex AS (
  SELECT user_id, event_type, day, min(event_id) AS event_id, arg_min(value, event_id) AS value
  FROM e WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id, event_type, day),
b AS (
  SELECT user_id, event_type, day, max(event_id) AS event_id, arg_max(value, event_id) AS value
  FROM e WHERE event_type IS DISTINCT FROM 'purchase' GROUP BY user_id, event_type, day),
facts AS (
  SELECT * FROM b
  UNION ALL
  SELECT * FROM ex WHERE NOT EXISTS (
    SELECT 1 FROM b WHERE ex.user_id IS NOT DISTINCT FROM b.user_id
      AND ex.event_type IS NOT DISTINCT FROM b.event_type AND ex.day IS NOT DISTINCT FROM b.day))
SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id, value FROM facts""",
)
def q_facts_update(spark, sf_dir):
    """I4-I6 T6 with ``update``: a batch of all events but purchases replaces
    stored facts of the same key (null-safe; the last by id wins) in a versioned
    table partitioned by event type. Only partitions in which a value changes
    are rewritten."""
    ev = Tables(spark, sf_dir).events.select(
        "user_id", F.nullif("event_type", F.lit("view")).alias("event_type"), F.to_date("ts").alias("day"), "event_id", "value", "ts"
    )
    keys, order, cols = ["user_id", "event_type", "day"], ["event_id"], EVENT_FACTS.fieldNames()
    store = VersionedTables(spark, shared_path(spark, "statloom-events", uuid.uuid4().hex), {"facts": EVENT_FACTS}, {"facts": "event_type"})
    store.append("facts", star.first_wins(ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).select(*cols), keys, order))
    new = store.begin()
    batch = ev.filter(~F.col("event_type").eqNullSafe("purchase")).select(*cols)
    rows, changed = star.insert_or_update(new.read("facts"), batch, keys, order, "event_type", nullable=["event_type"])
    new.write("facts", rows, replaces=[store.folder_name("facts", c) for c in changed])
    new.commit()
    return store.read("facts").select("user_id", "event_type", "day", "event_id", "value")


# Routing of event types to target tables (3 rows).
EVENT_ROUTES = [("view", "impressions"), ("click", "interactions"), ("purchase", "sales")]


@query(
    "route_codes",
    """SELECT event_id, event_type,
  CASE event_type WHEN 'view' THEN 'impressions' WHEN 'click' THEN 'interactions'
                  WHEN 'purchase' THEN 'sales' END AS target_table,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'routed' ELSE 'rejected' END AS status
FROM events""",
)
def q_route_codes(spark, sf_dir):
    """Route each row by a code through a fixed routing table
    (broadcast, 3 rows); unknown codes are kept as rejects."""
    routes = spark.createDataFrame(EVENT_ROUTES, "event_type string, target_table string")
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type")
    out = ev.join(F.broadcast(routes), "event_type", "left")
    status = F.when(F.col("target_table").isNull(), F.lit("rejected")).otherwise(F.lit("routed"))
    return out.select("event_id", "event_type", "target_table", status.alias("status"))


REQUIRED_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
# Dimensions that leave something out, so that facts have orphans: finished orders, all but the
# PROMO parts, suppliers in debt left out. Prices of small quantities count as not given.
LINE_KEYS = {"l_orderkey": ("orders", "o_orderkey", "o_orderstatus = 'F'"), "l_partkey": ("part", "p_partkey", "p_type <> 'PROMO'"),
             "l_suppkey": ("supplier", "s_suppkey", "s_acctbal >= 0")}
UNIQUE_KEYS = {"line": ("l_orderkey", "l_linenumber"), "price": ("l_suppkey", "l_linenumber", "l_extendedprice")}


@query(
    "quality_rejects",
    "WITH f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_quantity >= 5 THEN l_extendedprice END AS l_extendedprice FROM lineitem)\n"
    + "\nUNION ALL\n".join(
        [f"SELECT 'null_{c}' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS n_rows FROM f" for c in REQUIRED_LINE_COLS]
        + [f"SELECT 'orphan_{k}' AS check_name, count(*) AS n_rows FROM f WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{dk} = f.{k} AND {cond})"
           for k, (t, dk, cond) in LINE_KEYS.items()]
        + [f"SELECT 'unique_{name}' AS check_name, CAST(count(*) - count(DISTINCT ({', '.join(keys)})) AS BIGINT) AS n_rows FROM f" for name, keys in UNIQUE_KEYS.items()]
    ),
)
def q_quality_rejects(spark, sf_dir):
    """NOT NULL violations, orphan foreign keys and repeated
    unique keys (NULL key parts equal each other), counted. The price key repeats
    where prices are missing."""
    t = Tables(spark, sf_dir)
    price = F.when(F.col("l_quantity") >= 5, F.col("l_extendedprice")).alias("l_extendedprice")
    dims = {k: (getattr(t, table).filter(cond).select(dk), dk) for k, (table, dk, cond) in LINE_KEYS.items()}
    checks = star.constraint_counts(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", price), REQUIRED_LINE_COLS, dims, UNIQUE_KEYS)
    return checks.withColumnRenamed("check", "check_name")


@query("sink_roundtrip", REGISTRY["purchasing_ratio"][1])  # same rows as the mart written
def q_sink_roundtrip(spark, sf_dir):
    """Write a mart as CSV (header) and Parquet to the shared
    folder, read the CSV back with its declared schema."""
    from statloom.sources.marts_io import read_mart_csv, write_mart

    mart = REGISTRY["purchasing_ratio"][0](spark, sf_dir)
    folder = shared_path(spark, "statloom-sinks", uuid.uuid4().hex)
    write_mart(mart, folder, "Relacion_Poder_Adquisitivo")
    return read_mart_csv(spark, folder, "Relacion_Poder_Adquisitivo", mart.schema)
