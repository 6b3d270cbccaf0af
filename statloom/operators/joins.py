"""Join conditions.

No side is hinted. Spark broadcasts a side whose files are small, and AQE one
whose shuffled size it has measured to be small (``session.py`` sets the
bound); everything else is a sort-merge join, which AQE splits where skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], nullable: Sequence[str] | None = None) -> Column:
    """Join condition on ``keys``: ``=`` where a key can't be NULL, ``<=>``
    (NULL matches NULL) for those in ``nullable`` (all, if not given).

    Both sides must be aliased DataFrames (``df.alias(name)``)."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if nullable is None or k in nullable else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond
