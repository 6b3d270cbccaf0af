"""Elements of large JSON array files, read by many tasks.

A file that holds one JSON array has no line a reader could split it at. Here
Spark's text source cuts every file at the character ``}``, which any byte
range of it can do on its own, and the structure comes from a prefix scan over
these pieces:

1. per byte range, in both cases (it starts inside a string or outside): does
   it end inside a string, how far does it change the depth of brackets, and
   where does it reach its least depth;
2. one row per byte range: a running sum gives each its true start, the text
   before it counted in;
3. per piece: the depth after it; an element ends where the depth is back at
   that of the array. The pieces between two ends are one element, also where
   a byte range ends between them.

Files are UTF-8. They hold an array of objects, a lone object, or several
objects one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = ["path", "block"]
#: Stands before the depth of a piece that does not end with a bracket: it is never the least.
_NO_END = 1 << 30
#: Blanks before the text, a byte order mark among them.
_BLANK = r"^[\s\x{FEFF}]+"


def _count(text: str, char: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(char)))


def _change(text: str) -> Column:
    """By how much the brackets of a piece change the depth (it holds no closing brace)."""
    return _count(text, "[") + _count(text, "{") - _count(text, "]")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of text up to each ``}`` with their place and both ways to read them."""
    text = spark.read.option("lineSep", "}").text(path)
    df = text.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
    )
    # a } is read alike after a backslash
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    df = df.withColumn("plain", plain)
    df = df.withColumns({"quotes": _count("plain", '"'), "both": _change("plain")})
    # what lies outside strings, if the piece starts outside of one (0), lies inside of them if it starts inside (1), and the other way round
    rest0 = F.when(F.col("quotes") > 0, F.regexp_replace("plain", r'"[^"]*"?', "")).otherwise(F.col("plain"))
    df = df.withColumn("rest0", rest0)
    df = df.withColumn("outside0", _change("rest0"))
    change = (F.col("outside0"), F.col("both") - F.col("outside0"))
    for case in (0, 1):
        df = df.withColumn(f"ends{case}", (F.col("quotes") + case) % 2 == 0)  # the } behind the piece is a bracket, no text
        df = df.withColumn(f"change{case}", (change[case] - F.col(f"ends{case}").cast("int")).cast("long"))
    return df.withColumn("bytes", F.octet_length("value").cast("long") + 1).drop("plain", "both", "rest0", "outside0")


def _scanned(pieces: DataFrame) -> DataFrame:
    """Running values inside each byte range: end of the piece (bytes), and in both cases depth after it and whether it ends with a bracket."""
    order = Window.partitionBy(*_RANGE).orderBy("id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = pieces.withColumns({
        "inside": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2,
        "upto": F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    flip = F.col("inside") == 1  # the range's case, turned over by the quotes before the piece
    df = df.withColumns({f"{what}_{case}": F.when(flip, F.col(f"{what}{1 - case}")).otherwise(F.col(f"{what}{case}")) for what in ("change", "ends") for case in (0, 1)})
    rows = order.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"depth_{case}": F.sum(f"change_{case}").over(rows) for case in (0, 1)})


def _ranges(scanned: DataFrame) -> DataFrame:
    """One row per byte range: how it starts, where the last element before it ended, and the file's own facts."""
    def lowest(case: int) -> Column:
        return F.max(F.struct((-F.when(F.col(f"ends_{case}"), F.col(f"depth_{case}")).otherwise(F.lit(_NO_END))).alias("rise"), "upto"))

    ranges = scanned.groupBy(*_RANGE).agg(
        F.sum("bytes").alias("bytes"), F.max("size").alias("size"), (F.sum("quotes") % 2).alias("turns"), F.min_by("value", "id").alias("head"),
        *(F.max_by(f"{what}_{case}", "id").alias(f"{what}_{case}") for what in ("depth", "ends") for case in (0, 1)),
        *(lowest(case).alias(f"low_{case}") for case in (0, 1)),
    )
    file = Window.partitionBy("path").orderBy("block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    ranges = ranges.withColumns({
        "start_inside": F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2,
        "start_byte": F.coalesce(F.sum("bytes").over(before), F.lit(0)),
        "base": F.first("head").over(file).startswith("[").cast("int"),
        "final": F.lead("block").over(file).isNull(),
        "total": F.sum("bytes").over(whole),
    })
    case = lambda name: F.when(F.col("start_inside") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    ranges = ranges.withColumns({"depth": case("depth"), "low": case("low"), "ended": case("ends")})
    ranges = ranges.withColumns({"start_depth": F.coalesce(F.sum("depth").over(before), F.lit(0)), "end_depth": F.sum("depth").over(whole)})
    meets = F.col("start_depth") - F.col("low.rise") <= F.col("base")
    ranges = ranges.withColumn("last_end", F.when(meets, F.col("start_byte") + F.col("low.upto")))
    # the text source does not say whether a file ends with a }: its size does, or the depth where that is not the size of the text (compressed)
    size = F.col("size")
    cut = F.when(F.col("total") == size, False).when(F.col("total") == size + 1, True).otherwise(F.col("end_depth") < 0)
    ranges = ranges.withColumns({
        "last_end": F.coalesce(F.max("last_end").over(before), F.lit(0)),
        "cut": cut,
        # files follow each other in the order of their paths; one row per byte range
        "before_file": F.coalesce(F.sum("bytes").over(Window.orderBy(*_RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("start_byte"),
    })
    unclosed = F.col("final") & (F.col("end_depth") + (F.col("cut") & F.col("ended")).cast("int") > 0)
    return ranges.select(*_RANGE, "start_inside", "start_depth", "start_byte", "last_end", "base", "final", "cut", "before_file", unclosed.alias("unclosed"))


def _assembled(scanned: DataFrame, ranges: DataFrame) -> DataFrame:
    """Texts between two ends of elements: (path, file_name, place, text, whole)."""
    # two scans of the same files in one query are cut alike; a piece without its range is an error, never lost
    df = scanned.join(ranges, _RANGE, "left")
    df = df.withColumn("start_inside", F.coalesce("start_inside", F.raise_error(F.lit("byte range without a start")).cast("long")))
    order = Window.partitionBy(*_RANGE).orderBy("id")
    inside = F.col("start_inside") == 1
    depth = F.col("start_depth") + F.when(inside, F.col("depth_1")).otherwise(F.col("depth_0"))
    last = F.col("final") & F.lead("id").over(order).isNull()
    df = df.withColumns({"depth": depth, "last": last, "end": F.col("start_byte") + F.col("upto")})
    df = df.withColumn("closed", ~(F.col("last") & F.col("cut")))
    ends = F.when(inside, F.col("ends_1")).otherwise(F.col("ends_0")) & (F.col("depth") <= F.col("base")) & F.col("closed")
    df = df.withColumn("ends", ends)
    own = F.max(F.when(F.col("ends"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("from", F.coalesce(own, F.col("last_end")))
    part = F.struct("end", F.concat("value", F.when(F.col("closed"), F.lit("}")).otherwise(F.lit(""))).alias("value"))
    # the place tells the file, too
    out = df.groupBy((F.col("before_file") + F.col("from")).alias("place")).agg(
        F.first("path").alias("path"), F.first("file_name").alias("file_name"),
        F.sort_array(F.collect_list(part)).alias("parts"), F.max("ends").alias("whole"), F.max(F.col("last") & F.col("unclosed")).alias("unclosed"),
    )
    return out.select("path", "file_name", "place", F.array_join(F.col("parts.value"), "").alias("text"), "whole", "unclosed")


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of JSON array files: (path, file_name, place, text, broken).

    ``place`` grows in the order of the elements in a file, and of the files by
    path; it counts bytes. ``broken`` rows are text that is no object of the
    array: other values between the objects, what follows the array, and the
    rest of a file that ends too early (empty if it ends right behind an
    element). The text of an object may still not be JSON inside. Empty files
    give no row.

    A task holds the pieces of one byte range, or one element where it is put
    together. The files are read twice in one query, first for the structure,
    of which only numbers are shuffled; the second time the text is shuffled
    by range and, aggregated before, by element.
    """
    pieces = _pieces(spark, path)
    head = F.when(F.col("block") == 0, F.substring(F.regexp_replace("value", _BLANK, ""), 1, 1)).otherwise(F.lit(""))
    ranges = _ranges(_scanned(pieces.withColumn("value", head).drop("file_name")))
    parts = _assembled(_scanned(pieces.drop("size")), ranges)
    # commas and the array's own brackets stand between the objects
    lead = F.when(F.col("whole"), F.substring_index("text", "{", 1)).otherwise(F.col("text"))
    parts = parts.withColumn("lead", lead)
    inner = F.regexp_replace(F.regexp_replace("lead", _BLANK, ""), r"^\[?[\s,]*|^,[\s,]*", "")
    junk = F.when(F.col("whole"), F.regexp_replace(inner, r"[\s,]+$", "")).otherwise(F.regexp_replace(inner, r"^\]?\s*$", ""))
    parts = parts.withColumn("junk", junk)
    piece = lambda when, add, text, broken: F.when(when, F.struct((F.col("place") + add).alias("place"), text.alias("text"), F.lit(broken).alias("broken")))
    rows = F.array(
        piece((F.col("junk") != "") | (~F.col("whole") & F.col("unclosed")), 0, F.col("junk"), True),
        piece(F.col("whole"), 1, F.substr("text", F.length("lead") + 1), False),
        piece(F.col("whole") & F.col("unclosed"), 2, F.lit(""), True),
    )
    return parts.select("path", "file_name", F.explode(F.array_compact(rows)).alias("e")).select("path", "file_name", "e.*")
