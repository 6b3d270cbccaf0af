"""Source tables, name layouts, series filters and indicator labels.

Everything here is a column expression over a parsed series row with columns
``table_code`` and ``parts`` (the name parts, see ``functions.names``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.names import norm_label, part
from statloom.functions.safe import strip

# Statistics-office table codes, in load order.
CPI = 50913  # consumer prices, monthly
HPI = 25171  # house prices, quarterly
UNEMPLOYMENT_RATE = 65334
EMPLOYEES_BY_CONTRACT = 65132
WAGES_BY_OCCUPATION = 28186
WAGE_PERCENTILES = 28191
LABOUR_COST = 6061
LOAD_ORDER = (CPI, HPI, UNEMPLOYMENT_RATE, EMPLOYEES_BY_CONTRACT, WAGES_BY_OCCUPATION, WAGE_PERCENTILES, LABOUR_COST)

# Code -> (family, fact table).
ROUTES = {
    CPI: ("prices", "T_precios"),
    HPI: ("prices", "T_precios"),
    UNEMPLOYMENT_RATE: ("employment", "T_empleo"),
    EMPLOYEES_BY_CONTRACT: ("employment", "T_empleo"),
    WAGES_BY_OCCUPATION: ("wages", "T_salarios"),
    WAGE_PERCENTILES: ("wages", "T_salarios"),
    LABOUR_COST: ("wages", "T_salarios"),
}

# Position of each field in the dot-separated series name.
LAYOUTS = {
    UNEMPLOYMENT_RATE: {"sexo": 1, "geografia": 2, "grupo_edad": 3},
    EMPLOYEES_BY_CONTRACT: {"geografia": 0, "sexo": 2, "tipo_contrato": 3, "tipo_jornada": 4},
    CPI: {"geografia": 0, "categoria": 1, "tipo_dato": 2},
    HPI: {"geografia": 0, "categoria": 1, "tipo_dato": 2},
    LABOUR_COST: {"geografia": 0, "sector": 1, "indicador": 2},
    WAGE_PERCENTILES: {"sexo": 0, "geografia": 1, "indicador": 3},
    WAGES_BY_OCCUPATION: {"ocupacion": 0, "sexo": 1, "geografia": 3},
}

FIELDS = ("geografia", "sexo", "grupo_edad", "tipo_contrato", "tipo_jornada", "categoria", "tipo_dato",
          "sector", "indicador", "ocupacion")

# Labels, units and defaults.
NATIONAL = "Total Nacional"
SEX_DEFAULT = "Total"
NOT_APPLICABLE = "N/A"
INDEX_WORD = "Índice"
CHANGE_WORD = "Variación"
ANNUAL_CHANGE = "Variación anual"
HPI_CATEGORY = "General"
HPI_CATEGORY_LABEL = "Vivienda Total"
CPI_GENERAL = "Índice general"
CPI_GENERAL_LABEL = "IPC General"
UNIT_PERCENT = "%"
UNIT_CPI_BASE = "Base 2021=100"
UNIT_HPI_BASE = "Base 2015=100"
UNIT_THOUSANDS = "Miles de personas"
UNIT_EUROS = "Euros"
FULL_DAY_WORD = "Total"
CONTRACT_TOTAL = "Total asalariados"
CONTRACT_TEMPORARY = "Asalariados con contrato temporal"
LABOUR_COST_WORD = "Coste salarial total"
PERCENTILE_LABELS = {
    "media": "Salario_Anual_Media",
    "50": "Salario_Anual_Mediana",
    "25": "Salario_Anual_Cuartil inferior",
    "10": "Salario_Anual_Percentil 10",
}


def field(name: str, code: Column | None = None, parts: Column | None = None) -> Column:
    """The named field by the layout of each table code (NULL if the table has
    no such field or the name is too short)."""
    code = F.col("table_code") if code is None else code
    parts = F.col("parts") if parts is None else parts
    expr = None
    for c, layout in LAYOUTS.items():
        if name in layout:
            pick = part(parts, layout[name])
            expr = F.when(code == F.lit(c), pick) if expr is None else expr.when(code == F.lit(c), pick)
    return expr if expr is not None else F.lit(None).cast("string")


def required_parts(code: Column | None = None) -> Column:
    """Minimum number of name parts each layout needs."""
    code = F.col("table_code") if code is None else code
    expr = None
    for c, layout in LAYOUTS.items():
        n = max(layout.values()) + 1
        expr = F.when(code == F.lit(c), F.lit(n)) if expr is None else expr.when(code == F.lit(c), F.lit(n))
    return expr


def contains(c: Column, word: str) -> Column:
    """Case- and accent-sensitive substring test; NULL text counts as absent."""
    return F.coalesce(F.contains(c, F.lit(word)), F.lit(False))


def price_series(code: Column, tipo: Column, categoria: Column) -> dict[str, Column]:
    """Price-type filter, category normalisation, indicator name and unit."""
    is_annual_change = contains(tipo, ANNUAL_CHANGE)
    is_index = contains(tipo, INDEX_WORD) & ~contains(tipo, CHANGE_WORD)
    cat = strip(categoria)
    is_hpi = code == F.lit(HPI)
    keep = (is_index | is_annual_change) & (~is_hpi | (cat == F.lit(HPI_CATEGORY)))
    label = (
        F.when(is_hpi, F.lit(HPI_CATEGORY_LABEL))
        .when(cat == F.lit(CPI_GENERAL), F.lit(CPI_GENERAL_LABEL))
        .otherwise(cat)
    )
    base = F.when(is_hpi, F.lit("IPV")).otherwise(F.lit("IPC"))
    indicator = F.concat(base, F.when(is_annual_change, F.lit("_Variacion_Anual")).otherwise(F.lit("_Indice")))
    unit = (
        F.when(is_annual_change, F.lit(UNIT_PERCENT))
        .when(is_hpi, F.lit(UNIT_HPI_BASE))
        .otherwise(F.lit(UNIT_CPI_BASE))
    )
    return {"keep": keep, "categoria_gasto": label, "indicador": indicator, "unidad": unit}


def employment_series(code: Column, contrato: Column, jornada: Column) -> dict[str, Column]:
    """Unemployment rate kept as is; contract table keeps full-day totals of
    all employees and of temporary employees."""
    is_rate = code == F.lit(UNEMPLOYMENT_RATE)
    contract_label = F.when(contains(contrato, CONTRACT_TOTAL), F.lit("Asalariados_Total")).when(
        contains(contrato, CONTRACT_TEMPORARY), F.lit("Asalariados_Temporal")
    )
    keep = is_rate | (contains(jornada, FULL_DAY_WORD) & contract_label.isNotNull())
    indicator = F.when(is_rate, F.lit("Tasa_Paro")).otherwise(contract_label)
    unit = F.when(is_rate, F.lit(UNIT_PERCENT)).otherwise(F.lit(UNIT_THOUSANDS))
    return {"keep": keep, "indicador": indicator, "unidad": unit}


def wage_series(code: Column, indicador: Column) -> dict[str, Column]:
    """Labour cost keeps the total wage cost; percentiles keep mean, median,
    lower quartile and 10th percentile; occupations keep everything."""
    label = norm_label(indicador)
    pct_label = None
    for k, v in PERCENTILE_LABELS.items():
        pct_label = (F.when(label == F.lit(k), F.lit(v)) if pct_label is None
                     else pct_label.when(label == F.lit(k), F.lit(v)))
    indicator = (
        F.when(code == F.lit(LABOUR_COST),
               F.when(contains(indicador, LABOUR_COST_WORD), F.lit("Salario_Coste_Trimestral")))
        .when(code == F.lit(WAGE_PERCENTILES), pct_label)
        .when(code == F.lit(WAGES_BY_OCCUPATION), F.lit("Salario_Anual_Ocupacion"))
    )
    return {"keep": indicator.isNotNull(), "indicador": indicator, "unidad": F.lit(UNIT_EUROS)}
