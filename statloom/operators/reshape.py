"""Reporting shapes: wide to long, long-form series, latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Unpivot ``values`` into (variable, value) rows; a narrow, shuffle-free
    projection (Expand) per input row."""
    return df.unpivot(list(ids), list(values), variable, value)


def series_points(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Long-form (series, x, y) points, one series per group."""
    return df.select(F.col(group).alias("series"), F.col(x).alias("x"), F.col(y).alias("y"))
