"""Readers for raw series documents (JSON) and the schema report.

Two landing forms:

* JSON Lines, one series per line, with ``table_code`` and ``series_pos``
  added at landing (splittable: large files are read by many tasks);
* downloaded table files ``<code>.json`` (any prefix allowed before the code)
  holding one JSON array of series or a
  lone series object, also read by many tasks; the table code comes from the
  file name and the series position from the place inside the file. Streams
  read them whole per file (``multiLine``).

A document that breaks the declared schema is not lost: the fields that could
be read are kept and its text is in ``_bad_record`` (NULL for good documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.schemas import BAD_RECORD, READ_SERIES, READ_SERIES_FILE
from statloom.session import ensure_checkpoint_dir
from statloom.sources.json_arrays import read_elements

#: Options of every reader of raw documents (batch and stream).
KEEP_BAD = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}


def read_series_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(READ_SERIES).options(**KEEP_BAD).json(path)


def read_series_files(spark: SparkSession, path: str) -> DataFrame:
    """``<code>.json`` files: array of series or a lone object per file.

    Many tasks read a large file (see ``json_arrays``). ``series_pos`` grows in
    the order of the series in a file, and of the files by path. A folder
    ``table_code=<code>`` names the code as well as the file does. What is no
    object, and the rest of a file that ends too early, are broken documents;
    the series before stay.
    """
    found = read_elements(spark, path).withColumn("doc", F.when(~F.col("broken"), F.from_json("text", READ_SERIES_FILE, KEEP_BAD)))
    folder = F.regexp_extract("path", r"/table_code=(\d+)/", 1)
    code = F.when(folder != "", folder).otherwise(_code(F.col("file_name")))
    bad = F.when(F.col("broken"), F.col("text")).otherwise(F.col(f"doc.{BAD_RECORD}"))
    return found.select(code.try_cast("int").alias("table_code"), F.col("place").alias("series_pos"), "doc.Nombre", "doc.Data", bad.alias(BAD_RECORD))


def _code(file_name: Column) -> Column:
    """The table code is the last number in the file name: 50913.json, tabla_50913.json (none: empty)."""
    return F.regexp_extract(file_name, r"(\d+)(?=\D*$)", 1)


def files_to_series(df: DataFrame) -> DataFrame:
    """(Nombre, Data, file_name) rows of table files that a stream read whole -> the landing form."""
    code = _code(F.col("file_name"))
    bad = F.col(BAD_RECORD) if BAD_RECORD in df.columns else F.lit(None).cast("string")
    # A multiLine file is one task, so the id follows the order in the file.
    return df.select(
        F.when(code != "", code.cast("int")).alias("table_code"),
        F.monotonically_increasing_id().alias("series_pos"),
        "Nombre",
        "Data",
        bad.alias(BAD_RECORD),
    )


# ------------------------------------------------------------------ schema report

#: Name of a variant's SQL type -> JSON type.
_TYPES = {"OBJECT": "object", "ARRAY": "array", "BOOLEAN": "bool", "BIGINT": "int", "DOUBLE": "float", "FLOAT": "float", "STRING": "string", "VOID": "null"}
#: Levels that are counted in one pass over the documents; values nested deeper are kept and counted in further passes.
LEVELS_PER_PASS = 4


def _kind(v: Column) -> Column:
    """JSON type of a variant value; whole numbers are int whatever their size."""
    name = F.schema_of_variant(v)
    out = F.when(name.startswith("DECIMAL"), F.when(name.endswith(",0)"), F.lit("int")).otherwise(F.lit("float")))
    for prefix, kind in _TYPES.items():
        out = out.when(name.startswith(prefix), F.lit(kind))
    return out


def _step(key: Column) -> Column:
    """Path of a child: ``.key``, ``['a.b']`` for keys that are no plain names, ``[]`` for array elements (no key)."""
    quoted = F.concat(F.lit("['"), F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.when(key.isNull(), F.lit("[]")).when(key.rlike(r"^[\p{L}_][\p{L}\p{N}_]*$"), F.concat(F.lit("."), key)).otherwise(quoted)


def _with_children(rows: DataFrame, keys: list[str], themselves: bool = True) -> DataFrame:
    """Rows (keys, path, type, v), where v is an object or array not looked into yet (NULL: there is none): the rows
    ``themselves``, and a row for each child of v."""
    both = F.array(F.lit(True), F.lit(False)) if themselves else F.array(F.lit(False))
    again = F.when(F.col("v").isNotNull(), both).otherwise(F.array(F.lit(True)))
    rows = rows.select(*keys, "path", "type", "v", F.explode(again).alias("self"))
    rows = rows.select(*keys, "path", "type", "self", F.when(~F.col("self"), F.col("v")).alias("v"))
    inner = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("v").outer())).where("self OR value IS NOT NULL")
    inner = inner.select(*keys, "path", "self", "key", "value", "type", _kind(F.col("value")).alias("kind"))
    return inner.select(
        *keys,
        F.when(F.col("self"), F.col("path")).otherwise(F.concat("path", _step(F.col("key")))).alias("path"),
        F.when(F.col("self"), F.col("type")).otherwise(F.col("kind")).alias("type"),
        F.when(F.col("kind").isin("object", "array"), F.col("value")).alias("v"),
    )


def schema_report(df: DataFrame, json_col: str, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Types of every path of a JSON text column over all rows (per group), however deep.

    Rows (group columns, path, type, n): how many values a path has of each
    JSON type (object, array, bool, int, float, string, null). Paths are like
    ``$``, ``$.Data``, ``$.Data[]`` (elements of an array),
    ``$.Data[].Valor``, and ``$['a.b']`` for keys that are no plain names. One more row per group has the
    type ``invalid`` and no path: the texts that are not JSON (NULL included;
    Spark's parser also refuses texts nested deeper than 1,000 levels).

    A pass over the documents counts ``LEVELS_PER_PASS`` levels: each object or
    array stays a row and is exploded into its children. Values nested deeper
    are written to the shared folder and are the next pass's input, until there
    are none. The result has a row per path and type, and the counting has a partial
    aggregate: no value grows with the number of documents.
    """
    keys = list(group_cols)
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*keys, F.try_parse_json(F.col(json_col)).alias("doc"))
    rows = rows.select(*keys, F.when(F.col("doc").isNotNull(), F.lit("$")).alias("path"), "doc", _kind(F.col("doc")).alias("kind"))
    rows = rows.select(
        *keys, "path", F.coalesce("kind", F.lit("invalid")).alias("type"), F.when(F.col("kind").isin("object", "array"), F.col("doc")).alias("v")
    )
    first = result = None
    while True:
        for level in range(LEVELS_PER_PASS):
            rows = _with_children(rows, keys, themselves=first is None or level > 0)  # later passes begin with what is counted
        counted = rows.groupBy(*keys, "path", "type").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("open")).checkpoint(eager=True)
        first = counted if first is None else first
        part = counted.where("path IS NOT NULL").select(*keys, "path", "type", "n")
        result = part if result is None else result.unionByName(part)
        if counted.where("open > 0").isEmpty():
            break
        rows = rows.where(F.col("v").isNotNull()).checkpoint(eager=True)
    invalid = (first.groupBy(*keys) if keys else first).agg(F.coalesce(F.sum(F.when(F.col("path").isNull(), F.col("n"))), F.lit(0)).alias("n"))
    return result.unionByName(invalid.select(*keys, F.lit(None).cast("string").alias("path"), F.lit("invalid").alias("type"), "n"))


def series_schema_report(spark: SparkSession, path: str, files: bool = False) -> DataFrame:
    """Types of every path of raw series documents, over every document (the
    reference looked at the first one only): JSON Lines, one document a line,
    or with ``files`` whole ``<code>.json`` files (an array or a lone object)."""
    texts = spark.read.text(path, wholetext=files).filter(F.length(F.trim("value")) > 0)
    return schema_report(texts, "value")
