"""The three command-line phases in order, in-process."""

import os

import series_fixture as sf

from statloom.__main__ import COMMANDS, parser


def test_load_marts_reports(spark, scratch):
    series = sf.write_files(scratch + "/files")
    for argv in (
        ["load", "--series", series, "--files", "--star", scratch + "/star", "--rejects", scratch + "/rej"],
        ["marts", "--star", scratch + "/star", "--out", scratch + "/out"],
        ["reports", "--out", scratch + "/out"],
    ):
        args = parser().parse_args(argv)
        COMMANDS[args.cmd](spark, args)
    assert os.path.isdir(scratch + "/out/csv/Calidad_Empleo")
    assert os.path.isdir(scratch + "/out/reports/parquet/latest_gap")
    assert os.path.isdir(scratch + "/rej/series")
    quality = spark.read.parquet(scratch + "/out/parquet/Calidad_Empleo").first()
    assert quality["Temporal (%)"] == 25.0


def test_schema_command(spark, scratch, capsys):
    args = parser().parse_args(["schema", "--series", sf.write_lines(scratch + "/land")])
    text = COMMANDS[args.cmd](spark, args)
    n_docs = sum(len(v) for v in sf.series_by_code().values())
    assert f"$\tobject\t{n_docs}" in text and "$.Nombre\tstring" in capsys.readouterr().out


def test_stream_command_once(spark, scratch):
    from statloom.plans import ingest

    land = sf.write_lines(scratch + "/land")
    args = parser().parse_args(["stream", "--landing", land, "--star", scratch + "/star",
                                "--checkpoint", scratch + "/ckpt", "--once"])
    COMMANDS[args.cmd](spark, args)
    assert ingest.StarStore(spark, scratch + "/star").read("T_empleo").count() == 7
