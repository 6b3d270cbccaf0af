"""The nine marts end to end: raw series -> star -> blocks -> marts -> sinks."""

import pytest
import series_fixture as sf
from pyspark.sql import functions as F

from statloom.plans import blocks, ingest, marts
from statloom.schemas import MARTS
from statloom.sources.marts_io import read_mart_csv, read_mart_parquet, write_marts
from statloom.sources.series_json import read_series_lines


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    store = ingest.StarStore(spark, root + "/star")
    ingest.load(read_series_lines(spark, sf.write_lines(root + "/land")), store)
    sal, pri, emp = blocks.star_blocks(store.tables())
    return root, marts.build_marts(sal, pri, emp)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_salary_by_region_averages_sex_levels(built):
    _, ms = built
    got = rows(ms["Evolucion_Salario_Comunidades"], "comunidad", "anio", "salario_medio")
    assert got == [("Andalucía", 2015, 22000.0), ("Total Nacional", 2015, 25000.0), ("Total Nacional", 2016, 26000.0)]


def test_purchasing_power(built):
    _, ms = built
    got = {(r.comunidad, r.anio): (r.ipc_valor, r.poder_adquisitivo) for r in ms["Relacion_Poder_Adquisitivo"].collect()}
    assert got[("Total Nacional", 2015)] == pytest.approx((106.5, 25000 / 106.5))
    assert got[("Total Nacional", 2016)] == pytest.approx((110.5, 26000 / 110.5))
    assert ms["Relacion_Poder_Adquisitivo"].columns == ["comunidad", "anio", "salario_medio", "ipc_valor",
                                                         "poder_adquisitivo"]


def test_housing_rebased(built):
    _, ms = built
    got = rows(ms["Comparativa_Vivienda_Salario"], "anio", "salario_medio", "ipv", "indice_salario")
    assert got == [(2015, 25000.0, 110.5, 100.0)]


def test_occupation_gap(built):
    _, ms = built
    (r,) = ms["Brecha_Salarial_Ocupacion"].collect()
    assert (r.anio, r.ocupacion, r.Mujeres, r.Hombres) == (2015, "Directores", 50000.0, 60000.0)
    assert r.brecha_porcentual == pytest.approx(100 / 6)


def test_unemployment_and_correlation(built):
    _, ms = built
    assert rows(ms["Relacion_Paro_Salarios"], "comunidad", "anio", "salario_medio", "tasa_paro_media") == [
        ("Andalucía", 2015, 22000.0, 29.0)]
    assert rows(ms["Correlacion_Paro_Salarios"], "comunidad", "correlacion_pearson") == [("Andalucía", None)]


def test_nominal_vs_real(built):
    _, ms = built
    (r,) = ms["Salario_Nominal_vs_Real"].collect()
    assert (r.anio, r.salario_nominal) == (2015, 2050.0)
    assert r.salario_real == pytest.approx(2050 / 106.5 * 100)


def test_job_quality(built):
    _, ms = built
    (r,) = ms["Calidad_Empleo"].collect()
    assert (r.anio, r.Asalariados_Total, r.Asalariados_Temporal) == (2015, 1050.0, 262.5)
    assert (r["Temporal (%)"], r["Indefinido (%)"]) == pytest.approx((25.0, 75.0))


def test_wage_inequality(built):
    _, ms = built
    assert rows(ms["Desigualdad_Salarial"], "anio", "indicador", "salario") == [
        (2015, "Salario_Anual_Media", 25000.0), (2015, "Salario_Anual_Mediana", 21000.0),
        (2016, "Salario_Anual_Media", 26000.0)]


def test_marts_write_and_read_back(spark, built):
    root, ms = built
    write_marts(ms, root + "/out", marts.MART_ORDER)
    for name, df in ms.items():
        back = read_mart_csv(spark, root + "/out", name, MARTS[name])
        assert back.columns == df.columns
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
        assert read_mart_parquet(spark, root + "/out", name).count() == df.count()


def test_run_marts_end_to_end(spark, built):
    root, ms = built
    out = marts.run_marts(spark, root + "/star", root + "/run")
    assert set(out) == set(MARTS)
    back = read_mart_csv(spark, root + "/run", "Evolucion_Salario_Comunidades", MARTS["Evolucion_Salario_Comunidades"])
    assert [(r.comunidad, r.anio) for r in back.collect()] == [
        ("Andalucía", 2015), ("Total Nacional", 2015), ("Total Nacional", 2016)]


def test_csv_quotes_commas_and_keeps_full_doubles(spark, scratch):
    from statloom.sources.marts_io import write_mart

    df = spark.createDataFrame([("Navarra, Comunidad Foral de", 0.1 + 0.2)], "comunidad string, v double")
    write_mart(df, scratch, "m")
    back = read_mart_csv(spark, scratch, "m", "comunidad string, v double").first()
    assert back.comunidad == "Navarra, Comunidad Foral de" and back.v == 0.1 + 0.2


def test_indicator_filter_reaches_partitioned_facts(spark, built, capsys):
    root, _ = built
    store = ingest.StarStore(spark, root + "/star")
    sal, _, _ = blocks.star_blocks(store.tables())
    sal.filter(F.col("indicador") == "Salario_Anual_Media").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(id_indicador" in plan


def test_report_shapes(spark, built):
    from statloom.plans.reporting import build_reports

    _, ms = built
    reps = build_reports(ms)
    jq = sorted((r.variable, r.value) for r in reps["job_quality"].collect())
    assert jq == [("Indefinido (%)", 75.0), ("Temporal (%)", 25.0)]
    assert [r.ocupacion for r in reps["latest_gap"].collect()] == ["Directores"]
    assert reps["wage_lines"].columns == ["series", "x", "y"]
    (trend,) = reps["unemployment_wage_trend"].collect()
    assert trend.tendencia == 22000.0  # one point: the trend is the point
    assert reps["housing_vs_wage"].count() == 2 and reps["real_wage"].count() == 2
    assert [tuple(r) for r in reps["unemployment_lines"].collect()] == [("Andalucía", 2015, 29.0)]
    assert reps["correlation_bars"].count() == 1


def test_fixture_edge_cases(spark, scratch):
    from statloom.sources.series_json import read_series_lines

    store = ingest.StarStore(spark, scratch + "/star")
    ingest.load(read_series_lines(spark, sf.write_lines(scratch + "/a")), store)
    rejects = ingest.load(read_series_lines(spark, sf.write_lines(scratch + "/b", sf.extra_cases())), store)
    geo = {r.nombre for r in store.read("tbl_geografia").collect()}
    assert "Murcia" in geo  # series without observations still registers its dimensions
    ind = {r.nombre for r in store.read("tbl_indicador").collect()}
    assert {"Salario_Anual_Cuartil inferior", "Salario_Anual_Percentil 10"} <= ind
    assert [r.reject_reason for r in rejects["T_salarios"].collect()] == ["null_valor"]
    sal, pri, emp = blocks.star_blocks(store.tables())
    got = {(r.indicador, r.anio): r.salario for r in sal.filter(F.col("anio") == 2017).collect()}
    assert got == {("Salario_Anual_Cuartil inferior", 2017): 18000.0, ("Salario_Anual_Percentil 10", 2017): 9000.0}
    gap = {r.ocupacion for r in marts.occupation_gap(sal).collect()}
    assert gap == {"Directores"}  # one-sex occupation and zero wage are dropped
