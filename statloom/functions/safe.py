"""Column expressions that stay defined where ANSI mode would raise.

Spark 4 runs with ANSI on: ``x / 0`` and ``corr`` on a constant column raise.
The reference's engine returned inf/NaN there; here the result is NULL, which
later filters drop the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Python's str.strip() removes all whitespace; Spark's trim() only spaces.
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den * 100 (NULL on a zero denominator)."""
    return safe_div(num, den) * F.lit(100.0)


def strip(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace, including tabs and no-break spaces."""
    return F.regexp_replace(col(c), _EDGE_SPACE, "")


def pearson(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation over complete (x, y) pairs, as an aggregate.

    Each of x and y is nulled where the other is null, so the three moments see
    the same rows. Zero variance or a single point gives NULL instead of an
    ANSI error.
    """
    xc, yc = col(x), col(y)
    both = xc.isNotNull() & yc.isNotNull()
    xp = F.when(both, xc)
    yp = F.when(both, yc)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))
