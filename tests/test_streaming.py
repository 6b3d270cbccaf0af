"""Landing-folder stream: two micro-batches, one replayed file, same star."""

import json
import os

import series_fixture as sf

from statloom.plans import ingest
from statloom.streaming.landing import start_landing_stream


def test_stream_loads_new_files_idempotently(spark, scratch):
    land = scratch + "/land"
    sf.write_lines(land)
    q = start_landing_stream(spark, land, scratch + "/star", checkpoint=scratch + "/ckpt",
                             rejects_dir=scratch + "/rejects", available_now=True)
    q.awaitTermination(300)
    store = ingest.StarStore(spark, scratch + "/star")
    first = {t: df.count() for t, df in store.tables().items()}
    assert first["T_precios"] == 20 and first["T_empleo"] == 7

    # a second file: the same series again plus one new observation
    docs = sf.series_by_code()
    docs[6061][0]["Data"].append({"Anyo": 2016, "FK_Periodo": 19, "Valor": 2200.0})
    with open(os.path.join(land, "batch2.json"), "w", encoding="utf-8") as fh:
        for code, series in docs.items():
            for pos, s in enumerate(series):
                fh.write(json.dumps({"table_code": code, "series_pos": pos, **s}, ensure_ascii=False) + "\n")
    q = start_landing_stream(spark, land, scratch + "/star", checkpoint=scratch + "/ckpt", available_now=True)
    q.awaitTermination(300)
    second = {t: df.count() for t, df in store.tables().items()}
    assert second["T_salarios"] == first["T_salarios"] + 1
    assert second["tbl_periodo"] == first["tbl_periodo"] + 1
    assert second["T_precios"] == first["T_precios"]
    assert os.path.isdir(scratch + "/rejects/series")


def test_stream_of_downloaded_table_files(spark, scratch):
    land = sf.write_files(scratch + "/files")
    q = start_landing_stream(spark, land, scratch + "/star", checkpoint=scratch + "/ckpt", available_now=True,
                             files=True)
    q.awaitTermination(300)
    store = ingest.StarStore(spark, scratch + "/star")
    assert store.read("T_precios").count() == 20 and store.read("T_salarios").count() == 9
