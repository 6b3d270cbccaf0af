"""Declared schemas: raw series documents, the star schema and its keys."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _f(name, dtype, nullable=True):
    return StructField(name, dtype, nullable)


# Raw series document. ``Data`` is read as maps so both spellings of the period
# key (FK_Periodo / Fk_Periodo) survive; values are typed after the explode.
RAW_SERIES = StructType(
    [
        _f("table_code", IntegerType()),
        _f("series_pos", LongType()),
        _f("Nombre", StringType()),
        _f("Data", ArrayType(MapType(StringType(), StringType()))),
    ]
)

# Text of a document that could not be read with the schema, in whole or in part.
BAD_RECORD = "_bad_record"
# Same document without the landing fields (a downloaded table file).
RAW_SERIES_FILE = StructType([_f("Nombre", StringType()), _f("Data", ArrayType(MapType(StringType(), StringType())))])
# What the readers produce: a document that breaks the schema keeps its text.
READ_SERIES = StructType([*RAW_SERIES.fields, _f(BAD_RECORD, StringType())])
READ_SERIES_FILE = StructType([*RAW_SERIES_FILE.fields, _f(BAD_RECORD, StringType())])

PERIOD = StructType(
    [
        _f("id_periodo", LongType(), False),
        _f("anio", IntegerType(), False),
        _f("trimestre", IntegerType()),
        _f("mes", IntegerType()),
        _f("fecha_iso", DateType(), False),
    ]
)

INDICATOR = StructType(
    [_f("id_indicador", LongType(), False), _f("nombre", StringType(), False), _f("unidad", StringType())]
)

REGION = StructType([_f("id_geografia", LongType(), False), _f("nombre", StringType(), False)])

PRICES = StructType(
    [
        _f("id_periodo", LongType(), False),
        _f("id_indicador", LongType(), False),
        _f("id_geografia", LongType(), False),
        _f("categoria_gasto", StringType(), False),
        _f("valor", DoubleType(), False),
    ]
)

WAGES = StructType(
    [
        _f("id_periodo", LongType(), False),
        _f("id_indicador", LongType(), False),
        _f("id_geografia", LongType(), False),
        _f("sexo", StringType()),
        _f("sector_cnae", StringType()),
        _f("ocupacion_cno11", StringType()),
        _f("valor", DoubleType(), False),
    ]
)

EMPLOYMENT = StructType(
    [
        _f("id_periodo", LongType(), False),
        _f("id_indicador", LongType(), False),
        _f("id_geografia", LongType(), False),
        _f("sexo", StringType(), False),
        _f("grupo_edad", StringType()),
        _f("tipo_jornada", StringType()),
        _f("tipo_contrato", StringType()),
        _f("valor", DoubleType(), False),
    ]
)

FACT_SCHEMAS = {"T_precios": PRICES, "T_salarios": WAGES, "T_empleo": EMPLOYMENT}

# Unique keys of the fact tables (everything but the value).
FACT_KEYS = {name: [f.name for f in schema.fields if f.name != "valor"] for name, schema in FACT_SCHEMAS.items()}

# Columns that must be non-null before a fact row is stored.
FACT_REQUIRED = {
    name: [f.name for f in schema.fields if not f.nullable] for name, schema in FACT_SCHEMAS.items()
}

DIMENSION_SCHEMAS = {"tbl_periodo": PERIOD, "tbl_indicador": INDICATOR, "tbl_geografia": REGION}

# Result tables (marts).
MARTS = {
    "Evolucion_Salario_Comunidades": "comunidad string, anio int, salario_medio double",
    "Relacion_Poder_Adquisitivo": "comunidad string, anio int, salario_medio double, ipc_valor double, "
    "poder_adquisitivo double",
    "Comparativa_Vivienda_Salario": "anio int, salario_medio double, ipv double, indice_salario double",
    "Brecha_Salarial_Ocupacion": "anio int, ocupacion string, Mujeres double, Hombres double, "
    "brecha_porcentual double",
    "Relacion_Paro_Salarios": "comunidad string, anio int, salario_medio double, tasa_paro_media double",
    "Correlacion_Paro_Salarios": "comunidad string, correlacion_pearson double",
    "Salario_Nominal_vs_Real": "anio int, salario_nominal double, ipc_valor double, salario_real double",
    "Calidad_Empleo": "anio int, Asalariados_Total double, Asalariados_Temporal double, "
    "`Temporal (%)` double, `Indefinido (%)` double",
    "Desigualdad_Salarial": "anio int, indicador string, salario double",
}
