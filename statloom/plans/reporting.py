"""Report-ready shapes of the marts (the data side of the charts).

Each function turns a mart into the long form a chart draws from: one row per
(series, x, y) point, a latest-period snapshot, two share columns unpivoted,
or the LOWESS trend across all regions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from statloom.operators import measures as m
from statloom.operators.lowess import lowess
from statloom.operators.reshape import series_points, wide_to_long


def wage_lines(by_region: DataFrame) -> DataFrame:
    """Regional wage per year, one series per region."""
    return series_points(by_region, "comunidad", "anio", "salario_medio")


def purchasing_lines(purchasing: DataFrame) -> DataFrame:
    """Purchasing power per year, one series per region."""
    return series_points(purchasing, "comunidad", "anio", "poder_adquisitivo")


def housing_vs_wage_long(housing: DataFrame) -> DataFrame:
    """House-price index and rebased wage as two series over the years."""
    return wide_to_long(housing, ["anio"], ["ipv", "indice_salario"], "serie", "valor")


def latest_gap(gap: DataFrame) -> DataFrame:
    """Occupation gaps of the latest year, smallest gap first."""
    return m.order_by(m.latest(gap, "anio"), "brecha_porcentual")


# Fixed value: the chart library's default LOWESS fraction (not exactly 2/3).
CHART_TREND_FRAC = 0.6666666


def unemployment_wage_trend(q5: DataFrame, frac: float = CHART_TREND_FRAC, iterations: int = 3) -> DataFrame:
    """One LOWESS trend of wage against unemployment over all regions and
    years (the scatter's trend line)."""
    return lowess(q5, "tasa_paro_media", "salario_medio", frac=frac, iterations=iterations, out="tendencia")


def unemployment_lines(q5: DataFrame) -> DataFrame:
    """Unemployment rate per year, one series per region (one panel each)."""
    return series_points(q5, "comunidad", "anio", "tasa_paro_media")


def correlation_bars(corr: DataFrame) -> DataFrame:
    """Correlation per region, most negative first."""
    return m.order_by(corr, "correlacion_pearson")


def real_wage_long(real: DataFrame) -> DataFrame:
    """Nominal and deflated wage as two series."""
    return wide_to_long(real, ["anio"], ["salario_nominal", "salario_real"], "serie", "valor")


def job_quality_long(quality: DataFrame) -> DataFrame:
    """Temporary and permanent shares as two stacked series."""
    return wide_to_long(quality, ["anio"], ["Indefinido (%)", "Temporal (%)"], "variable", "value")


def inequality_lines(inequality: DataFrame) -> DataFrame:
    """One series per wage statistic."""
    return series_points(inequality, "indicador", "anio", "salario")


def build_reports(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "wage_lines": wage_lines(marts["Evolucion_Salario_Comunidades"]),
        "purchasing_lines": purchasing_lines(marts["Relacion_Poder_Adquisitivo"]),
        "housing_vs_wage": housing_vs_wage_long(marts["Comparativa_Vivienda_Salario"]),
        "latest_gap": latest_gap(marts["Brecha_Salarial_Ocupacion"]),
        "unemployment_wage_trend": unemployment_wage_trend(marts["Relacion_Paro_Salarios"]),
        "unemployment_lines": unemployment_lines(marts["Relacion_Paro_Salarios"]),
        "correlation_bars": correlation_bars(marts["Correlacion_Paro_Salarios"]),
        "real_wage": real_wage_long(marts["Salario_Nominal_vs_Real"]),
        "job_quality": job_quality_long(marts["Calidad_Empleo"]),
        "inequality_lines": inequality_lines(marts["Desigualdad_Salarial"]),
    }
