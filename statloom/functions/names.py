"""Series-name parsing as column expressions (no UDF).

A series name holds all its dimensions as dot-separated text, read by
position. ``name_parts`` splits, strips and drops blank parts; ``part`` picks a
position and gives NULL when the name is too short (ANSI ``arr[i]`` would
raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.safe import ColumnOrName, col, strip


def name_parts(name: ColumnOrName, sep_regex: str = r"\.") -> Column:
    """split(name, sep) -> strip each part -> drop empty parts.

    One regex split that also swallows the whitespace around each separator,
    then ``array_remove`` of blanks: same result as stripping every part, but
    without a lambda, so the expression stays in generated code.
    """
    around = rf"(?U)\s*(?:{sep_regex})\s*"
    return F.array_remove(F.split(strip(name), around), "")


def part(parts: ColumnOrName, index: int) -> Column:
    """0-based positional pick; NULL when missing."""
    return F.get(col(parts), F.lit(index))


def part_or(parts: ColumnOrName, index: int, default: str) -> Column:
    """Positional pick with a default for a missing part."""
    return F.coalesce(part(parts, index), F.lit(default))


def norm_label(c: ColumnOrName) -> Column:
    """lower(strip(x)): the comparison form of a free-text label."""
    return F.lower(strip(c))
