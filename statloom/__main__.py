"""Command line: the three phases of a run.

    python -m statloom load    --series DIR --star DIR [--files] [--rejects DIR] [--load-id ID] [--conflict ignore|update|fail]
    python -m statloom marts   --star DIR --out DIR
    python -m statloom reports --out DIR
    python -m statloom schema  --series DIR [--files]
    python -m statloom stream  --landing DIR --star DIR --checkpoint DIR [--files] [--once]

``load`` reads JSON Lines series documents (or ``<code>.json`` table files
with ``--files``) into the star; ``marts`` builds and writes the nine marts
(CSV and Parquet); ``reports`` writes the chart-ready shapes of those marts;
``schema`` prints the types of every path over all raw documents;
``stream`` keeps loading new files from a landing folder (``--once``: load
what is there, then stop).
The session comes from the environment (``spark-submit`` settings); with no
master set, a local one is used.
"""

from __future__ import annotations

import argparse
import hashlib
import sys

from statloom.session import build_session


def _session(args):
    return build_session(master=args.master, app_name=f"statloom-{args.cmd}")


def cmd_load(spark, args) -> dict:
    from statloom.plans import ingest
    from statloom.sources.series_json import read_series_files, read_series_lines

    raw = read_series_files(spark, args.series) if args.files else read_series_lines(spark, args.series)
    rejects = ingest.load(raw, ingest.StarStore(spark, args.star), args.conflict)
    if args.rejects:
        # one folder per load, overwritten: a retried load writes its rejects once
        load_id = args.load_id or hashlib.sha256(args.series.encode()).hexdigest()[:16]
        for name, df in rejects.items():
            df.write.mode("overwrite").parquet(f"{args.rejects.rstrip('/')}/{name}/load_id={load_id}")
    return rejects


def cmd_marts(spark, args) -> dict:
    from statloom.plans.marts import run_marts

    return run_marts(spark, args.star, args.out)


def cmd_reports(spark, args) -> dict:
    from statloom.plans.reporting import build_reports
    from statloom.schemas import MARTS
    from statloom.sources.marts_io import read_mart_parquet, write_mart

    marts = {name: read_mart_parquet(spark, args.out, name) for name in MARTS}
    reports = build_reports(marts)
    for name, df in reports.items():
        write_mart(df, f"{args.out.rstrip('/')}/reports", name)
    return reports


def cmd_schema(spark, args) -> str:
    from statloom.sources.series_json import series_schema_report

    rows = series_schema_report(spark, args.series, files=args.files).collect()  # one row per path and type
    text = "\n".join(f"{r['path'] or ''}\t{r['type']}\t{r['n']}" for r in sorted(rows, key=lambda r: (r["path"] or "", r["type"])))
    print(text)
    return text


def cmd_stream(spark, args):
    from statloom.streaming.landing import start_landing_stream

    q = start_landing_stream(spark, args.landing, args.star, checkpoint=args.checkpoint,
                             rejects_dir=args.rejects, available_now=args.once, files=args.files)
    q.awaitTermination()
    return q


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="statloom")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="load series documents into the star")
    load.add_argument("--series", required=True)
    load.add_argument("--star", required=True)
    load.add_argument("--files", action="store_true", help="input is <code>.json table files")
    load.add_argument("--rejects", default=None)
    load.add_argument("--load-id", default=None, help="name of this load's reject folders (default: from --series)")
    load.add_argument("--conflict", default="ignore", choices=["ignore", "update", "fail"], help="what becomes of a fact that is stored already")
    marts = sub.add_parser("marts", help="build and write the nine marts")
    marts.add_argument("--star", required=True)
    marts.add_argument("--out", required=True)
    rep = sub.add_parser("reports", help="write chart-ready shapes of the marts")
    rep.add_argument("--out", required=True)
    sch = sub.add_parser("schema", help="print the types of every path of raw documents")
    sch.add_argument("--series", required=True)
    sch.add_argument("--files", action="store_true", help="input is <code>.json table files")
    st = sub.add_parser("stream", help="load new landing files continuously")
    st.add_argument("--landing", required=True)
    st.add_argument("--star", required=True)
    st.add_argument("--checkpoint", required=True, help="stream progress, the same folder at each start")
    st.add_argument("--rejects", default=None)
    st.add_argument("--files", action="store_true", help="input is <code>.json table files")
    st.add_argument("--once", action="store_true", help="load the files present now, then stop")
    return p


COMMANDS = {"load": cmd_load, "marts": cmd_marts, "reports": cmd_reports, "schema": cmd_schema,
            "stream": cmd_stream}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = _session(args)
    COMMANDS[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
