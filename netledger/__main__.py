"""Command line: ``spark-submit`` or ``python -m netledger <job> ...``.

    load       dimension files -> tables
    ingest     flow files -> JSON messages (folder or Kafka topic); unusable lines go aside
    settle     messages in a folder -> detail and totals, as a batch
    stream     messages of a Kafka topic or folder -> detail and totals, until stopped
    export     totals of a run -> ``merchant, total`` lines
    query      SQL over the detail views of a run -> table, or a preview of some rows
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from netledger import schemas
from netledger.plans import load, sides
from netledger.plans.export import export_summary
from netledger.plans.settlement import INCRE, NORMAL
from netledger.session import RECOMMENDED_CONF
from netledger.sinks import messages as message_sinks
from netledger.sinks import tables
from netledger.sources import messages
from netledger.streaming.jobs import SettlementStream

JOBS = {"normal": NORMAL, "incre": INCRE}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="netledger", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="command", required=True)

    p = jobs.add_parser("load")
    for name in schemas.DIMENSION_COLUMNS:
        p.add_argument(f"--{name}", default="")
    p.add_argument("--target", required=True)

    p = jobs.add_parser("ingest")
    p.add_argument("--flow", choices=JOBS, required=True)
    p.add_argument("--files", required=True, help="comma separated")
    p.add_argument("--target", help="folder for JSON text")
    p.add_argument("--rejects", help="folder for unusable lines; default: the target with _rejects")
    p.add_argument("--servers")
    p.add_argument("--topic")

    for name in ("settle", "stream"):
        p = jobs.add_parser(name)
        p.add_argument("--flow", choices=JOBS, required=True)
        p.add_argument("--dimensions", required=True)
        p.add_argument("--run", required=True, help="folder of this run's tables")
        p.add_argument("--messages", help="folder of JSON text")
        if name == "stream":
            p.add_argument("--servers")
            p.add_argument("--topics", help="comma separated")
            p.add_argument("--max-per-trigger", type=int)
            p.add_argument("--fan-out", type=int)
            p.add_argument("--once", action="store_true", help="stop when all messages are done")

    p = jobs.add_parser("export")
    p.add_argument("--run", required=True)
    p.add_argument("--target", required=True)

    p = jobs.add_parser("query")
    p.add_argument("--flow", choices=JOBS, required=True)
    p.add_argument("--run", required=True)
    p.add_argument("--target", help="folder for the whole result")
    p.add_argument("--show", type=int, help="print so many rows")
    p.add_argument("sql")
    args = parser.parse_args(argv)
    if args.command == "query" and not args.target and args.show is None:
        parser.error("query needs --target or --show")
    if args.command == "ingest" and not args.target and not args.rejects:
        parser.error("ingest to a topic needs --rejects")
    return args


def _settle_batch(spark: SparkSession, args) -> None:
    """The whole message folder as batch 0 of the run."""
    run = SettlementStream(JOBS[args.flow], lambda s: load.open_dimensions(s, args.dimensions), args.run)
    run.process_all(messages.file_messages(spark, args.messages))


def _stream(spark: SparkSession, args) -> None:
    stream = SettlementStream(JOBS[args.flow], lambda s: sides.open_sides(s, None, args.dimensions), args.run,
                              fan_out=args.fan_out, version=lambda s: sides.sides_version(s, args.dimensions))
    if args.messages:
        source = messages.file_stream(spark, args.messages, args.max_per_trigger)
    else:
        source = messages.kafka_stream(spark, args.servers, args.topics, args.max_per_trigger)
    try:
        stream.start(source, once=args.once).awaitTermination()
    finally:
        stream.close()


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    builder = SparkSession.builder.appName(f"netledger-{args.command}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.command == "load":
        files = {n: getattr(args, n) for n in schemas.DIMENSION_COLUMNS if getattr(args, n)}
        load.load_dimensions(spark, files, args.target)
    elif args.command == "ingest":
        out, bad = load.ingest(spark, args.flow, args.files)
        bad.write.mode("append").parquet(args.rejects or f"{args.target.rstrip('/')}_rejects")
        if args.topic:
            message_sinks.to_kafka(message_sinks.keyed(out, args.topic), args.servers, args.topic)
        else:
            out.write.mode("append").text(args.target)
    elif args.command == "settle":
        _settle_batch(spark, args)
    elif args.command == "stream":
        _stream(spark, args)
    elif args.command == "export":
        export_summary(SettlementStream(NORMAL, None, args.run).totals(spark), args.target)
    else:
        job = JOBS[args.flow]
        tables.create_views(spark, **{job.name: SettlementStream(job, None, args.run).detail(spark)})
        result = spark.sql(args.sql)
        if args.target:
            result.write.mode("overwrite").parquet(args.target)
        if args.show is not None:
            result.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
