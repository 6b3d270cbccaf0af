"""Ingest: routing, name parsing, periods, dimensions, insert-or-ignore."""

import json
import os

import series_fixture as sf
from pyspark.sql import functions as F

from statloom.plans import ingest
from statloom.sources.series_json import read_series_files, read_series_lines, schema_report


def _load(spark, scratch, times=1):
    raw = read_series_lines(spark, sf.write_lines(scratch + "/land"))
    store = ingest.StarStore(spark, scratch + "/star")
    rejects = None
    for _ in range(times):
        rejects = ingest.load(raw, store)
    return store, rejects


def _counted(frames):
    """Rows of the reject tables by kind and reason."""
    out = {}
    for kind, df in frames.items():
        reasons = [r[0] for r in df.select("reject_reason").collect()] if kind != "filtered" else ["filtered"] * df.count()
        out[kind] = {r: reasons.count(r) for r in set(reasons)}
    return out


def test_load_counts_what_it_leaves_out(spark, scratch):
    folder = sf.write_lines(scratch + "/land")
    with open(folder + "/more.json", "w", encoding="utf-8") as fh:
        fh.write('{"table_code": 50913, "Nomb\n')
        doc = {"table_code": 50913, "series_pos": 90, "Nombre": "Total Nacional. General. Índice."}
        fh.write(json.dumps(doc | {"Data": {"Anyo": 2015}}, ensure_ascii=False) + "\n")
        data = [{"Anyo": None, "FK_Periodo": 1, "Valor": 1}, {"Anyo": 2015, "FK_Periodo": "x", "Valor": 1}, {"Anyo": 2015, "FK_Periodo": 1}]
        fh.write(json.dumps(doc | {"Data": data}, ensure_ascii=False) + "\n")
    raw = read_series_lines(spark, folder)
    store = ingest.StarStore(spark, scratch + "/star")
    first, again = ingest.load(raw, store), ingest.load(raw, store, conflict="update")
    assert first.counts == again.counts == _counted(first)
    assert set(first.counts["series"]) == {"bad_document", "bad_data", "unmapped_code", "short_name", "null_year", "bad_period"}
    assert first.counts["T_precios"] == {"null_valor": 2} and first.counts["filtered"]["filtered"] > 0


def test_load_builds_star_and_is_idempotent(spark, scratch):
    store, rejects = _load(spark, scratch, times=2)
    t = store.tables()
    counts = {k: v.count() for k, v in t.items()}
    assert counts == {"tbl_geografia": 2, "tbl_indicador": 10, "tbl_periodo": 20,
                      "T_precios": 20, "T_salarios": 9, "T_empleo": 7}
    reasons = sorted(r.reject_reason for r in rejects["series"].collect())
    assert reasons == ["bad_period", "short_name", "unmapped_code"]
    assert [r.reject_reason for r in rejects["T_precios"].collect()] == ["null_valor"]


def test_dimension_ids_follow_first_seen_order(spark, scratch):
    store, _ = _load(spark, scratch)
    geo = {r.nombre: r.id_geografia for r in store.read("tbl_geografia").collect()}
    assert geo == {"Total Nacional": 1, "Andalucía": 2}
    ind = {r.nombre: (r.id_indicador, r.unidad) for r in store.read("tbl_indicador").collect()}
    assert ind["IPC_Indice"] == (1, "Base 2021=100")
    assert ind["IPC_Variacion_Anual"] == (2, "%")
    assert ind["IPV_Indice"] == (3, "Base 2015=100")
    assert ind["Salario_Coste_Trimestral"][0] == 10


def test_periods_are_normalised(spark, scratch):
    store, _ = _load(spark, scratch)
    per = {(r.anio, r.mes, r.trimestre): str(r.fecha_iso) for r in store.read("tbl_periodo").collect()}
    assert per[(2015, 7, 3)] == "2015-07-01"  # third quarter stored as 3
    assert per[(2015, 10, 4)] == "2015-10-01"  # fourth quarter has its date
    assert per[(2015, None, None)] == "2015-01-01"  # annual
    assert per[(2016, 2, None)] == "2016-02-01"  # FK_Periodo 0 falls back to Fk_Periodo


def test_series_filters_and_labels(spark, scratch):
    store, _ = _load(spark, scratch)
    prices = store.read("T_precios").join(store.read("tbl_indicador"), "id_indicador")
    cats = {r.categoria_gasto for r in prices.collect()}
    assert cats == {"IPC General", "Alimentos", "Vivienda Total"}  # 'Vivienda nueva' dropped
    emp = store.read("T_empleo").join(store.read("tbl_indicador"), "id_indicador")
    assert {r.nombre for r in emp.collect()} == {"Tasa_Paro", "Asalariados_Total", "Asalariados_Temporal"}
    assert emp.filter(F.col("valor") == 10.0).count() == 0  # part-time and other contracts dropped
    wages = store.read("T_salarios").join(store.read("tbl_indicador"), "id_indicador")
    names = {r.nombre for r in wages.collect()}
    assert "Salario_Anual_Mediana" in names  # tab around '50' stripped
    assert wages.filter(F.col("valor") == 30000.0).count() == 0  # 75th percentile dropped
    # duplicate key inside the batch: first series wins
    men = wages.filter((F.col("sexo") == "Hombres") & (F.col("ocupacion_cno11") == "Directores"))
    assert [r.valor for r in men.collect()] == [60000.0]


def test_revised_value_does_not_replace(spark, scratch):
    store, _ = _load(spark, scratch)
    docs = sf.series_by_code()
    docs[6061][0]["Data"][0]["Valor"] = 9999.0
    raw = read_series_lines(spark, sf.write_lines(scratch + "/land2", docs))
    ingest.load(raw, store)
    vals = sorted(r.valor for r in store.read("T_salarios").filter(F.col("sector_cnae") == "Industria").collect())
    assert vals == [2000.0, 2100.0]


def test_null_key_parts_are_not_duplicated(spark, scratch):
    store, _ = _load(spark, scratch, times=3)
    emp = store.read("T_empleo")
    assert emp.count() == 7  # grupo_edad / jornada / contrato are NULL for some rows


def test_downloaded_files_lone_object_and_array(spark, scratch):
    raw = read_series_files(spark, sf.write_files(scratch + "/files"))
    by_code = {r.table_code: r.n for r in raw.groupBy("table_code").agg(F.count("*").alias("n")).collect()}
    assert by_code[50913] == 6 and by_code[99999] == 1
    firsts = raw.filter(F.col("table_code") == 50913).orderBy("series_pos").first()
    assert firsts.Nombre.startswith("Total Nacional. Índice general. Índice")


def test_empty_batch_loads_nothing(spark, scratch):
    from statloom.schemas import RAW_SERIES

    store = ingest.StarStore(spark, scratch + "/star")
    rejects = ingest.load(spark.createDataFrame([], RAW_SERIES), store)
    assert rejects["series"].count() == 0 and not any(rejects.counts.values())
    assert all(df.count() == 0 for df in store.tables().values())


def test_series_schema_report_counts_every_path(spark, scratch):
    from statloom.sources.series_json import series_schema_report

    n = sum(len(v) for v in sf.series_by_code().values())
    folder = sf.write_lines(scratch + "/land")
    with open(folder + "/broken.json", "w") as fh:
        fh.write('{"table_code": 1, "Nomb\n')
    rows = {(r.path, r.type): r.n for r in series_schema_report(spark, folder).collect()}
    assert rows[("$", "object")] == n and rows[("$.Nombre", "string")] == n and rows[(None, "invalid")] == 1
    assert rows[("$.Data[].Fk_Periodo", "int")] == 2 and ("$.Data[].FK_Periodo", "int") in rows
    assert rows[("$.Data[].Valor", "null")] == 2

    files = {(r.path, r.type): r.n for r in series_schema_report(spark, sf.write_files(scratch + "/files"), files=True).collect()}
    assert files[("$", "object")] == 1 and files[("$", "array")] == len(sf.series_by_code()) - 1
    assert files[("$[].Nombre", "string")] + files[("$.Nombre", "string")] == n


def test_schema_report_has_no_depth_limit(spark):
    deep = '{"a": {"b": {"c": {"d": {"e": {"f": [1, [2.5, {"g h": null}]]}}}}}, "a.b": {"it\'s": {}, "x]": [], "back\\\\": true}, "ñ_1": "t", "": 1}'
    deeper = '{"k": ' * 30 + "[]" + "}" * 30
    rows = spark.createDataFrame([("p", deep), ("p", '{"a": 1}'), ("p", "{"), ("q", deeper), ("q", None), ("r", "[[[[[[7]]]]]]"), ("s", "x{")], "g string, t string")
    got = {(r.g, r.path, r.type): r.n for r in schema_report(rows, "t", ("g",)).collect()}
    want = {"$": "object", "$.a": "object", "$.a.b": "object", "$.a.b.c": "object", "$.a.b.c.d": "object", "$.a.b.c.d.e": "object", "$.a.b.c.d.e.f": "array",
            "$.a.b.c.d.e.f[]": "int", "$.a.b.c.d.e.f[][]": "float", "$.a.b.c.d.e.f[][]['g h']": "null", "$['a.b']": "object", "$['a.b']['it\\'s']": "object",
            "$['a.b']['x]']": "array", "$['a.b']['back\\\\']": "bool", "$.ñ_1": "string", "$['']": "int"}
    p = {("p", path, kind): 1 for path, kind in want.items()} | {("p", "$", "object"): 2, ("p", "$.a", "int"): 1, ("p", None, "invalid"): 1}
    p |= {("p", "$.a.b.c.d.e.f[]", "array"): 1, ("p", "$.a.b.c.d.e.f[][]", "object"): 1}
    q = {("q", "$" + ".k" * i, "object"): 1 for i in range(30)} | {("q", "$" + ".k" * 30, "array"): 1, ("q", None, "invalid"): 1}
    r = {("r", "$" + "[]" * i, "array"): 1 for i in range(6)} | {("r", "$" + "[]" * 6, "int"): 1, ("r", None, "invalid"): 0}
    assert got == p | q | r | {("s", None, "invalid"): 1}
    assert [tuple(x) for x in schema_report(rows.where("false"), "t").collect()] == [(None, "invalid", 0)]


def _write(folder, lines):
    os.makedirs(folder, exist_ok=True)
    with open(folder + "/batch.json", "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return folder


def _doc(code, pos, name, data):
    return json.dumps({"table_code": code, "series_pos": pos, "Nombre": name, "Data": data}, ensure_ascii=False)


PERCENTILE = "Total. Total Nacional. Dato base. Media."
PRICE = "Total Nacional. General. Índice."


def test_nothing_is_lost_silently(spark, scratch):
    lines = [
        '{"table_code": 28191, "series_pos": 0, "Nombre": "Total. To',  # cut off
        _doc(28191, 1, PERCENTILE, {"Anyo": 2015}),  # an object is no list
        _doc(28191, 2, PERCENTILE, "none"),
        _doc(28191, 3, PERCENTILE, [sf.obs(2015, "T1", 1.0), sf.obs(2016, 0, 2.0), sf.obs(2017, 28.0, 3.0), sf.obs(2018, None, 4.0), sf.obs("x", 28, 5.0)]),
        _doc(25171, 4, PRICE, [sf.obs(2015, 0, 6.0), sf.obs(2016, 19.0, 7.0), sf.obs(2017, "", 8.0)]),
        _doc(28191, 5, "Total. Total Nacional. Dato base. 75.", [sf.obs(2015, 28, 9.0)]),
    ]
    raw = read_series_lines(spark, _write(scratch + "/land", lines))
    store = ingest.StarStore(spark, scratch + "/star")
    rejects = ingest.load(raw, store)
    got = sorted((r.series_pos if r.reject_reason != "bad_document" else -1, r.obs_pos if r.obs_pos is not None else -1, r.reject_reason)
                 for r in rejects["series"].collect())
    assert got == [(-1, -1, "bad_document"), (1, -1, "bad_data"), (2, -1, "bad_data"), (3, 0, "bad_period"), (3, 1, "bad_period"),
                   (3, 4, "null_year"), (4, 2, "bad_period")]
    assert {r.raw for r in rejects["series"].collect() if r.reject_reason == "bad_document"} == {lines[0]}
    assert [r.series_pos for r in rejects["filtered"].collect()] == [5]
    assert sorted(r.valor for r in store.read("T_salarios").collect()) == [3.0, 4.0]
    prices = store.read("T_precios").join(store.read("tbl_periodo"), "id_periodo")
    assert sorted((r.anio, r.trimestre, r.valor) for r in prices.collect()) == [(2015, None, 6.0), (2016, 1, 7.0)]  # 0 counts as missing in prices only


def test_second_load_reads_only_its_indicators(spark, scratch, capsys):
    store, _ = _load(spark, scratch)
    raw = read_series_lines(spark, sf.write_lines(scratch + "/again", {6061: sf.series_by_code()[6061]}))
    batch = ingest.prepare(raw)
    dims = {t: store.read(t) for t in ingest.DIMENSIONS}
    good, _ = ingest.fact_batches(batch, dims)["T_salarios"]
    stored = ingest.stored_facts(store.begin(), "T_salarios", good)
    only = store.read("tbl_indicador").where("nombre = 'Salario_Coste_Trimestral'").first().id_indicador
    assert {f.split("/")[-2] for f in stored.inputFiles()} == {f"id_indicador={only}"}
    store.read("T_salarios").where(f"id_indicador = {only}").explain("formatted")
    assert "PartitionFilters: [isnotnull(id_indicador" in capsys.readouterr().out


def test_quality_report_counts_orphans(spark, scratch):
    store, _ = _load(spark, scratch)
    rep = {(r.table, r.check): r.n_rows for r in ingest.quality_report(store).collect()}
    assert rep[("T_precios", "orphan_id_periodo")] == 0 and rep[("T_empleo", "null_valor")] == 0
    orphan = spark.createDataFrame([(999, 1, 1, "X", 1.0)], store.schema("T_precios"))
    store.append("T_precios", orphan)
    rep = {(r.table, r.check): r.n_rows for r in ingest.quality_report(store).collect()}
    assert rep[("T_precios", "orphan_id_periodo")] == 1


def test_landing_conversion_round_trip(spark, scratch):
    from statloom.sources.series_json import read_series_lines

    ingest.land_series_files(spark, sf.write_files(scratch + "/files"), scratch + "/landed")
    landed = read_series_lines(spark, scratch + "/landed")
    store = ingest.StarStore(spark, scratch + "/star")
    ingest.load(landed, store)
    assert store.read("T_precios").count() == 20 and store.read("T_salarios").count() == 9


def test_filters_do_not_repeat_the_parsing(spark, scratch):
    with open(scratch + "/50913.json", "w", encoding="utf-8") as fh:
        json.dump([{"Nombre": "Total Nacional. Alimentos. Índice. ", "Data": [{"Anyo": 2020, "FK_Periodo": 3, "Valor": 1.5}]}], fh)
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, 10_000)
    try:
        obs = ingest.prepare(read_series_files(spark, scratch)).obs.where("valor IS NOT NULL")
        plan = obs._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert plan.count("split(") == 1 and plan.count("make_date(") == 1
    assert [(r.anio, r.mes, r.valor, r.categoria_gasto) for r in obs.collect()] == [(2020, 3, 1.5, "Alimentos")]
