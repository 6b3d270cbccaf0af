"""Generic panel measures (aggregations, ratios, pivots, snapshots).

Every operator is ``DataFrame -> DataFrame`` and takes column names, so the
same code runs on the indicator star schema and on any other panel.

Scale notes:

* Aggregations have a partial (map-side) step, so only one row per group and
  task crosses the shuffle, however hot a group is.
* Scalars (a base-period value, the latest period) are scalar subqueries: Spark
  runs them as their own small job and inlines the value; nothing is pulled
  into this program and no cross join is planned. Their (small, aggregated)
  input is checkpointed first, so the scalar does not rescan the sources.
* Pivots take an explicit level list: fixed column order, no extra job to find
  the levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from statloom.functions.safe import col, pct, pearson, safe_div


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def where_all(df: DataFrame, *predicates: Column | None) -> DataFrame:
    """Conjunction of predicates; ``None`` entries are skipped."""
    preds = [p for p in predicates if p is not None]
    if not preds:
        return df
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return df.filter(cond)


def eq(c: str, value) -> Column | None:
    """Equality predicate, or ``None`` (no filter) when value is None."""
    return None if value is None else F.col(c) == F.lit(value)


def ne(c: str, value) -> Column | None:
    """Inequality predicate; NULL rows drop too, as in the reference."""
    return None if value is None else F.col(c) != F.lit(value)


def isin(c: str, values: Sequence | None) -> Column | None:
    return None if values is None else F.col(c).isin(list(values))


def not_isin(c: str, values: Sequence | None) -> Column | None:
    """Negated membership; NULL rows drop (NULL NOT IN (...) is NULL)."""
    return None if values is None else ~F.col(c).isin(list(values))


def annual_mean(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    out: str,
    *predicates: Column | None,
) -> DataFrame:
    """Mean of ``value`` per group, over rows passing the predicates and with
    a non-null value."""
    ks = _keys(keys)
    rows = where_all(df, *predicates, F.col(value).isNotNull())
    return rows.groupBy(*ks).agg(F.avg(value).alias(out))


def ratio(df: DataFrame, num: str, den: str, out: str, scale: float = 1.0) -> DataFrame:
    """``out = num / den * scale`` (NULL on a zero denominator)."""
    expr = safe_div(num, den)
    if scale != 1.0:
        expr = expr * F.lit(float(scale))
    return df.withColumn(out, expr)


def share(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """Share of a part in a total, in percent."""
    return df.withColumn(out, pct(part, total))


def complement_share(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """``(total - part) / total * 100``."""
    return df.withColumn(out, pct(F.col(total) - F.col(part), total))


def base_value(df: DataFrame, time_col: str, base, value: str) -> Column:
    """The value at the base period as a scalar subquery.

    Exactly one row must hold the base period; zero or several raise an error
    when the query runs, as the reference's ``.item()`` did. The base row is
    picked by a conditional aggregate, not by a filter: the subquery then has
    the frame's own plan, and Spark reuses the frame's shuffle for it.
    """
    hit = F.col(time_col) == F.lit(base)
    one = df.agg(
        F.when(F.count_if(hit) == 1, F.max(F.when(hit, F.col(value)))).otherwise(
            F.raise_error(F.lit(f"base period {time_col}={base} must hold exactly one row"))
        )
    )
    return one.scalar()


def rebase(df: DataFrame, time_col: str, base, value: str, out: str) -> DataFrame:
    """Index with value 100 at the base period."""
    return df.withColumn(out, pct(value, base_value(df, time_col, base, value)))


def pivot_mean(
    df: DataFrame,
    index: str | Sequence[str],
    on: str,
    levels: Sequence[str],
    value: str,
) -> DataFrame:
    """Pivot with mean: one column per level, in the given order."""
    return df.groupBy(*_keys(index)).pivot(on, list(levels)).agg(F.avg(value))


def pivot_unique(
    df: DataFrame,
    index: str | Sequence[str],
    on: str,
    levels: Sequence[str],
    value: str,
) -> DataFrame:
    """Pivot of already-unique cells; a duplicate cell raises an error."""
    cell = F.when(F.count(value) <= 1, F.first(value, ignorenulls=True)).otherwise(
        F.raise_error(F.lit(f"pivot on {on}: duplicate cell"))
    )
    return df.groupBy(*_keys(index)).pivot(on, list(levels)).agg(cell)


def gap_pct(df: DataFrame, ref: str, other: str, out: str) -> DataFrame:
    """Percentage gap ``(ref - other) / ref * 100``."""
    return df.withColumn(out, pct(F.col(ref) - F.col(other), ref))


def clean_gap(df: DataFrame, gap: str, a: str, b: str, lo: float = -100.0, hi: float = 100.0) -> DataFrame:
    """Drop anomalies: gap within [lo, hi] and both levels positive."""
    return df.filter(F.col(gap).between(lo, hi) & (F.col(a) > 0) & (F.col(b) > 0))


def grouped_corr(df: DataFrame, keys: str | Sequence[str], x: str, y: str, out: str) -> DataFrame:
    """Pearson correlation per group (NULL for zero variance or one point)."""
    return df.groupBy(*_keys(keys)).agg(pearson(x, y).alias(out))


def latest(df: DataFrame, time_col: str) -> DataFrame:
    """Rows of the latest period (global max, as a scalar subquery over the
    same plan, whose shuffle Spark reuses)."""
    return df.filter(F.col(time_col) == df.agg(F.max(time_col)).scalar())


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (for comparing with another engine)."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def order_by(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending sort, NULLs first (the reference's order); apply at the sink."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])


__all__ = [
    "annual_mean", "base_value", "clean_gap", "col", "complement_share", "eq",
    "gap_pct", "grouped_corr", "isin", "latest", "ne", "not_isin", "order_by",
    "pivot_mean", "pivot_unique", "ratio", "rebase", "round_doubles", "share",
    "where_all",
]
