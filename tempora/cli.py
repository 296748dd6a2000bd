"""Command-line launcher for the jobs (``python -m tempora …`` or ``spark-submit``).

    python -m tempora batch     --input CSV_PATH --base ROOT [--exact] [--rerun-years-only] [--with-grain]
    python -m tempora notebook  --input CSV_PATH --out DIR [--exact]
    python -m tempora consumer  --base ROOT --checkpoints DIR (--input LANDING_DIR | --kafka SERVERS --topic T)
                                [--no-console] [--no-parquet] [--available-now] [--fail-late] [--state-partitions N]
                                [--with-grain]
    python -m tempora read      --base ROOT [--source batch|streaming] [--since YEAR] [--with-grain]

The session comes from the environment (``spark-submit`` settings); ``--master``
is only for runs outside ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("tempora")
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    if not spark.sparkContext.getConf().contains("spark.sql.session.timeZone"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # unless the caller chose a zone
    return spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tempora", description=__doc__.splitlines()[0])
    parser.add_argument("--master", default=None)
    sub = parser.add_subparsers(dest="command", required=True)

    batch = sub.add_parser("batch", help="historical CSV → yearly means per city → batch root")
    batch.add_argument("--input", required=True)
    batch.add_argument("--base", required=True)
    batch.add_argument("--exact", action="store_true")
    batch.add_argument("--rerun-years-only", action="store_true")
    batch.add_argument("--with-grain", action="store_true", help="also write n (measurements per row)")

    nb = sub.add_parser("notebook", help="profile, clean, analyse; seven datasets and a report")
    nb.add_argument("--input", required=True)
    nb.add_argument("--out", required=True)
    nb.add_argument("--exact", action="store_true")

    cons = sub.add_parser("consumer", help="windowed stream measures → console and streaming root")
    cons.add_argument("--base", required=True)
    cons.add_argument("--checkpoints", required=True)
    cons.add_argument("--input", help="CSV landing directory")
    cons.add_argument("--kafka", help="bootstrap servers")
    cons.add_argument("--topic", default=None, help="topic (with --kafka)")
    cons.add_argument("--no-console", action="store_true")
    cons.add_argument("--no-parquet", action="store_true")
    cons.add_argument("--available-now", action="store_true")
    cons.add_argument("--fail-late", action="store_true", help="fail if rows came behind the watermark and were dropped")
    cons.add_argument("--state-partitions", type=int, default=None)
    cons.add_argument("--with-grain", action="store_true", help="also write window_start and n")

    rd = sub.add_parser("read", help="reports over the unified batch + streaming table")
    rd.add_argument("--base", required=True)
    rd.add_argument("--source", choices=["batch", "streaming"], default=None)
    rd.add_argument("--since", type=int, default=2010)
    rd.add_argument("--with-grain", action="store_true", help="also report means weighted by n")

    args = parser.parse_args(argv)
    spark = _session(args.master)
    from tempora.plans import jobs
    from tempora.sinks.files import show
    from tempora.streaming.queries import await_all

    if args.command == "batch":
        print(json.dumps(jobs.batch_job(spark, args.input, args.base, args.exact, args.rerun_years_only,
                                        with_grain=args.with_grain)))
    elif args.command == "notebook":
        print(json.dumps(jobs.notebook_job(spark, args.input, args.out, exact=args.exact), default=str))
    elif args.command == "consumer":
        from tempora.sources.stream import read_kafka, read_record_csv_stream

        if bool(args.input) == bool(args.kafka):
            parser.error("give exactly one of --input or --kafka")
        if args.kafka and not args.topic:
            parser.error("--kafka needs --topic")
        stream = read_record_csv_stream(spark, args.input) if args.input else read_kafka(spark, args.kafka, args.topic)
        started = jobs.consumer_job(stream, args.base, args.checkpoints, console=not args.no_console,
                                    parquet=not args.no_parquet, available_now=args.available_now,
                                    state_partitions=args.state_partitions, with_grain=args.with_grain)
        await_all(started, allow_late=not args.fail_late)
    elif args.command == "read":
        reports = jobs.reader_job(spark, args.base, since=args.since, with_grain=args.with_grain)
        table = reports[args.source] if args.source else reports["table"]
        table.printSchema()
        for name in ("stats", "distinct", "recent_top", "compare", "weighted"):
            if name not in reports:
                continue
            show(reports[name])
        show(table, 10)
    return 0


if __name__ == "__main__":  # spark-submit tempora/cli.py …
    import sys

    sys.exit(main())
