"""Mart sinks (CSV with header, Parquet) and readers.

Writers are plain DataFrame writers: each task writes its own file, so a mart
of any size is written in parallel. Marts are sorted at the sink (the
reference's order) only when ``sort`` is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def write_mart(df: DataFrame, folder: str, name: str, order: tuple[str, ...] = (), csv: bool = True) -> None:
    """Write ``df`` to ``folder/parquet/name`` and ``folder/csv/name``.

    The mart is computed once: the Parquet copy is written first and the CSV
    is written from it, so the sources are not scanned a second time. With
    ``order``, both copies are sorted by those columns (ascending, NULLs
    first); reading files back does not keep row order, so the CSV is sorted
    again from the stored copy.
    """
    from statloom.operators.measures import order_by

    parquet_path = _join(folder, "parquet", name)
    # unsorted marts: AQE sizes the files (a small mart becomes one file)
    (order_by(df, *order) if order else df.hint("rebalance")).write.mode("overwrite").parquet(parquet_path)
    if csv:
        stored = df.sparkSession.read.parquet(parquet_path)
        stored = order_by(stored, *order) if order else stored
        stored.write.mode("overwrite").option("header", True).csv(_join(folder, "csv", name))


def read_mart_csv(spark: SparkSession, folder: str, name: str, schema: StructType | str) -> DataFrame:
    """Read a CSV mart back with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(_join(folder, "csv", name))


def read_mart_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(_join(folder, "parquet", name))


def write_marts(marts: dict[str, DataFrame], folder: str, order: dict[str, tuple] | None = None) -> None:
    """Write every mart, sorted by its keys when ``order`` names them."""
    for name, df in marts.items():
        write_mart(df, folder, name, tuple((order or {}).get(name) or ()))
