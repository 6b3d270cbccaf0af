"""The nine result tables (marts), composed from the generic operators.

Inputs are the three master blocks (see ``plans.blocks``):

* salaries   (salario, comunidad, anio, indicador, sexo, ocupacion)
* prices     (precio, comunidad, anio, indicador, categoria_gasto)
* employment (valor_empleo, comunidad, anio, indicador, sexo, grupo_edad)

Every filter value is a parameter whose default is the reference's constant;
``None`` drops that filter. The functions return unsorted frames;
``MART_ORDER`` holds each mart's sort keys, applied at the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators import measures as m

# Filter constants of the reference's marts.
NATIONAL = "Total Nacional"
WAGE_MEAN = "Salario_Anual_Media"
CPI_INDEX = "IPC_Indice"
CPI_GENERAL = "IPC General"
HPI_INDEX = "IPV_Indice"
WAGE_OCCUPATION = "Salario_Anual_Ocupacion"
SEX_LEVELS = ("Mujeres", "Hombres")
OCCUPATION_EXCLUDED = ("Total", "N/A")
UNEMPLOYMENT = "Tasa_Paro"
BOTH_SEXES = "Ambos sexos"
ALL_AGES = "Todas las edades"
LABOUR_COST = "Salario_Coste_Trimestral"
EMPLOYEES_TOTAL = "Asalariados_Total"
EMPLOYEES_TEMPORARY = "Asalariados_Temporal"
WAGE_STATS = (
    "Salario_Anual_Media",
    "Salario_Anual_Mediana",
    "Salario_Anual_Percentil 10",
    "Salario_Anual_Cuartil inferior",
)
SEX_TOTAL = "Total"
BASE_YEAR = 2015

MART_ORDER = {
    "Evolucion_Salario_Comunidades": ("comunidad", "anio"),
    "Relacion_Poder_Adquisitivo": ("comunidad", "anio"),  # inherits Q1's order through the join
    "Comparativa_Vivienda_Salario": ("anio",),
    "Brecha_Salarial_Ocupacion": (),
    "Relacion_Paro_Salarios": ("anio", "comunidad"),
    "Correlacion_Paro_Salarios": ("correlacion_pearson",),
    "Salario_Nominal_vs_Real": ("anio",),
    "Calidad_Empleo": ("anio",),
    "Desigualdad_Salarial": ("anio", "salario"),
}


def salary_by_region(salaries: DataFrame, indicator: str | None = WAGE_MEAN, sex: str | None = None) -> DataFrame:
    """Q1: mean wage per (region, year). ``sex`` optionally fixes one level
    (the reference averages over all sex levels; see SURVEY T2)."""
    return m.annual_mean(
        salaries, ["comunidad", "anio"], "salario", "salario_medio",
        m.eq("indicador", indicator), m.eq("sexo", sex),
    )


def annual_cpi(
    prices: DataFrame,
    indicator: str | None = CPI_INDEX,
    region: str | None = NATIONAL,
    category: str | None = CPI_GENERAL,
    out: str = "ipc_valor",
) -> DataFrame:
    """Annual mean of a monthly index (12 months -> 1)."""
    return m.annual_mean(
        prices, "anio", "precio", out,
        m.eq("indicador", indicator), m.eq("comunidad", region), m.eq("categoria_gasto", category),
    )


def annual_hpi(prices: DataFrame, indicator: str | None = HPI_INDEX, region: str | None = NATIONAL) -> DataFrame:
    """Annual mean of a quarterly index (4 quarters -> 1)."""
    return annual_cpi(prices, indicator, region, None, out="ipv")


def purchasing_power(by_region: DataFrame, cpi: DataFrame) -> DataFrame:
    """Q2: wage / CPI per region and year (join on year)."""
    joined = by_region.join(cpi, "anio")
    return m.ratio(joined, "salario_medio", "ipc_valor", "poder_adquisitivo").select(
        "comunidad", "anio", "salario_medio", "ipc_valor", "poder_adquisitivo"
    )


def housing_vs_wage(
    by_region: DataFrame,
    hpi: DataFrame,
    national: str | None = NATIONAL,
    base_year: int = BASE_YEAR,
) -> DataFrame:
    """Q3: national wage next to the house-price index, wage rebased to 100."""
    total = m.where_all(by_region, m.eq("comunidad", national)).select("anio", "salario_medio")
    both = total.join(hpi, "anio").select("anio", "salario_medio", "ipv")
    return m.rebase(both, "anio", base_year, "salario_medio", "indice_salario")


def occupation_gap(
    salaries: DataFrame,
    indicator: str | None = WAGE_OCCUPATION,
    levels: Sequence[str] = SEX_LEVELS,
    excluded: Sequence[str] | None = OCCUPATION_EXCLUDED,
    index: Sequence[str] = ("anio", "ocupacion"),
    on: str = "sexo",
    out: str = "brecha_porcentual",
) -> DataFrame:
    """Q4: pivot the two levels (mean), keep complete rows, percentage gap of
    the second level over the first, anomalies removed."""
    low, ref = levels
    rows = m.where_all(
        salaries,
        m.eq("indicador", indicator),
        m.isin(on, levels),
        m.not_isin(index[-1], excluded),
        F.col("salario").isNotNull(),
    )
    wide = m.pivot_mean(rows, list(index), on, list(levels), "salario").dropna(how="any")
    gap = m.gap_pct(wide, ref, low, out)
    return m.clean_gap(gap, out, low, ref)


def annual_unemployment(
    employment: DataFrame,
    indicator: str | None = UNEMPLOYMENT,
    excluded_region: str | None = NATIONAL,
    sex: str | None = BOTH_SEXES,
    age: str | None = ALL_AGES,
) -> DataFrame:
    return m.annual_mean(
        employment, ["comunidad", "anio"], "valor_empleo", "tasa_paro_media",
        m.eq("indicador", indicator), m.ne("comunidad", excluded_region),
        m.eq("sexo", sex), m.eq("grupo_edad", age),
    )


def unemployment_vs_wage(
    by_region: DataFrame, unemployment: DataFrame, excluded_region: str | None = NATIONAL
) -> DataFrame:
    """Q5: regional wage next to the regional unemployment rate."""
    regional = m.where_all(by_region, m.ne("comunidad", excluded_region))
    return regional.join(unemployment, ["comunidad", "anio"]).select(
        "comunidad", "anio", "salario_medio", "tasa_paro_media"
    )


def unemployment_wage_corr(q5: DataFrame) -> DataFrame:
    """Q6: Pearson correlation of unemployment and wage per region."""
    return m.grouped_corr(q5, "comunidad", "tasa_paro_media", "salario_medio", "correlacion_pearson")


def nominal_vs_real(
    salaries: DataFrame,
    cpi: DataFrame,
    indicator: str | None = LABOUR_COST,
    region: str | None = NATIONAL,
) -> DataFrame:
    """Q7: annual nominal wage and its CPI-deflated value."""
    nominal = m.annual_mean(
        salaries, "anio", "salario", "salario_nominal", m.eq("indicador", indicator), m.eq("comunidad", region)
    )
    joined = nominal.join(cpi, "anio").select("anio", "salario_nominal", "ipc_valor")
    return m.ratio(joined, "salario_nominal", "ipc_valor", "salario_real", scale=100.0)


def job_quality(
    employment: DataFrame,
    total: str = EMPLOYEES_TOTAL,
    part: str = EMPLOYEES_TEMPORARY,
    region: str | None = NATIONAL,
    part_out: str = "Temporal (%)",
    rest_out: str = "Indefinido (%)",
) -> DataFrame:
    """Q8: annual means of a total and a part, side by side, with shares."""
    means = m.annual_mean(
        employment, ["anio", "indicador"], "valor_empleo", "valor_empleo",
        m.isin("indicador", [total, part]), m.eq("comunidad", region),
    )
    wide = m.pivot_unique(means, "anio", "indicador", [total, part], "valor_empleo")
    wide = m.share(wide, part, total, part_out)
    return m.complement_share(wide, part, total, rest_out)


def wage_inequality(
    salaries: DataFrame,
    indicators: Sequence[str] = WAGE_STATS,
    region: str | None = NATIONAL,
    sex: str | None = SEX_TOTAL,
) -> DataFrame:
    """Q9: annual level of each wage statistic."""
    return m.annual_mean(
        salaries, ["anio", "indicador"], "salario", "salario",
        m.isin("indicador", indicators), m.eq("comunidad", region), m.eq("sexo", sex),
    )


def build_marts(
    salaries: DataFrame,
    prices: DataFrame,
    employment: DataFrame,
    reuse: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All nine marts from the three blocks, with the reference's filters.

    The Q1 frame feeds four marts, the annual CPI two and Q5 two. ``reuse`` (for
    example ``lambda df: df.checkpoint()``) materialises these small
    aggregates once, so the nine separate writes do not recompute them. The
    blocks themselves are not kept: each mart reads only its indicator's
    partitions.
    """
    by_region = salary_by_region(salaries)
    cpi = annual_cpi(prices)
    if reuse is not None:
        by_region, cpi = reuse(by_region), reuse(cpi)
    q5 = unemployment_vs_wage(by_region, annual_unemployment(employment))
    if reuse is not None:
        q5 = reuse(q5)  # feeds the Q5 mart and the Q6 correlation
    return {
        "Evolucion_Salario_Comunidades": by_region,
        "Relacion_Poder_Adquisitivo": purchasing_power(by_region, cpi),
        "Comparativa_Vivienda_Salario": housing_vs_wage(by_region, annual_hpi(prices)),
        "Brecha_Salarial_Ocupacion": occupation_gap(salaries),
        "Relacion_Paro_Salarios": q5,
        "Correlacion_Paro_Salarios": unemployment_wage_corr(q5),
        "Salario_Nominal_vs_Real": nominal_vs_real(salaries, cpi),
        "Calidad_Empleo": job_quality(employment),
        "Desigualdad_Salarial": wage_inequality(salaries),
    }


def sorted_mart(name: str, df: DataFrame) -> DataFrame:
    keys = MART_ORDER.get(name, ())
    return m.order_by(df, *keys) if keys else df


def run_marts(spark, star_root: str, out_folder: str) -> dict[str, DataFrame]:
    """Read the star at ``star_root``, build the nine marts and write each as
    sorted CSV and Parquet under ``out_folder``."""
    from statloom.plans.blocks import star_blocks
    from statloom.plans.ingest import StarStore
    from statloom.session import ensure_checkpoint_dir
    from statloom.sources.marts_io import write_marts

    ensure_checkpoint_dir(spark)
    sal, pri, emp = star_blocks(StarStore(spark, star_root).tables())
    marts = build_marts(sal, pri, emp, reuse=lambda df: df.checkpoint(eager=True))
    write_marts(marts, out_folder, MART_ORDER)
    return marts
