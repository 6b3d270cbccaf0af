"""Period normalisation (month / quarter / year) as column expressions.

A source period code becomes (anio, mes, trimestre, fecha_iso). Monthly
sources pass the month; other sources pass a period code:

Fixed values (statistics-office period codes):
    28 -> annual:     mes NULL, trimestre NULL, date YYYY-01-01
    19 -> quarter 1:  mes 1,  trimestre 1, date YYYY-01-01
    20 -> quarter 2:  mes 4,  trimestre 2, date YYYY-04-01
    21 -> quarter 3:  mes 7,  trimestre 3, date YYYY-07-01
    22 -> quarter 4:  mes 10, trimestre 4, date YYYY-10-01
    missing code   -> mes NULL, trimestre NULL, date YYYY-01-01
Any other code is invalid (``period_ok`` false) and the row is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.safe import ColumnOrName, col

ANNUAL_CODE = 28


def quarter_first_month(quarter: Column) -> Column:
    return (quarter - F.lit(1)) * F.lit(3) + F.lit(1)


def normalise_period(year: ColumnOrName, month: ColumnOrName | None, code: ColumnOrName | None) -> Column:
    """Struct (anio, mes, trimestre, fecha_iso, period_ok).

    ``month`` wins when not NULL (monthly source); otherwise ``code`` is read
    with the table above.
    """
    y = col(year).cast("int")
    mo = col(month).cast("int") if month is not None else F.lit(None).cast("int")
    cd = col(code).cast("int") if code is not None else F.lit(None).cast("int")
    # quarter number for codes 19..22 (F12: plain integer arithmetic)
    q = F.when(cd.between(19, 22), cd - F.lit(18))
    monthly = mo.isNotNull()
    mes = F.when(monthly, mo).when(q.isNotNull(), quarter_first_month(q))
    trimestre = F.when(~monthly, q)
    ok = y.isNotNull() & F.when(monthly, mo.between(1, 12)).otherwise(
        cd.isNull() | (cd == F.lit(ANNUAL_CODE)) | q.isNotNull()
    )
    fecha = F.when(ok, F.make_date(y, F.coalesce(mes, F.lit(1)), F.lit(1)))
    return F.struct(
        y.alias("anio"),
        mes.cast("int").alias("mes"),
        trimestre.cast("int").alias("trimestre"),
        fecha.alias("fecha_iso"),
        ok.alias("period_ok"),
    )


def month_or_code(source_is_monthly: Column, fk: ColumnOrName) -> tuple[Column, Column]:
    """a monthly source's key is the month; any other source's is a code."""
    f = col(fk)
    return F.when(source_is_monthly, f), F.when(~source_is_monthly, f)
