"""Run the order flow: ``spark-submit`` this module or ``python -m parcelflow``.

    python -m parcelflow --landing DIR --tables DIR --checkpoint DIR --app NAME
    python -m parcelflow --topic ORDERS --servers HOST:PORT --tables DIR ...

Envelopes come from the files of a landing folder, or as JSON records from a
topic. Without ``--every`` the flow takes what is there and ends.
"""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from pyspark.sql import SparkSession

from parcelflow.plans.order_flow import OrderTables, run_order_flow
from parcelflow.schemas import ENVELOPE, RAW_RECORD
from parcelflow.sources import readers
from parcelflow.streaming import AVAILABLE_NOW, every, finish, large_state


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="parcelflow", description="Run the order flow.")
    origin = parser.add_mutually_exclusive_group(required=True)
    origin.add_argument("--landing", help="folder of envelope files")
    origin.add_argument("--topic", help="topic of JSON records")
    parser.add_argument("--servers", help="brokers of the topic")
    parser.add_argument("--raw", action="store_true", help="the landing files hold raw records")
    parser.add_argument("--tables", required=True, help="root folder of the tables")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--app", required=True, help="name of this feed, new per checkpoint")
    parser.add_argument("--every", help="interval between batches, for instance '5 seconds'")
    parser.add_argument("--batch-bytes", type=int, help="size limit of a batch")
    parser.add_argument("--package-slices", type=int, default=64)
    parser.add_argument(
        "--compact-every", type=int, default=0, help="join old slices after so many batches"
    )
    parser.add_argument(
        "--once-within", help="leave out envelopes that came before within this time, '7 days'"
    )
    args = parser.parse_args(argv)
    if args.topic and not args.servers:
        parser.error("--topic needs --servers")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"parcelflow-{args.app}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw = args.raw or args.topic is not None
    if args.topic:
        stream = readers.stream_kafka(spark, args.servers, args.topic).select("data")
    else:
        schema = RAW_RECORD if raw else ENVELOPE
        stream = readers.stream_files(
            spark, args.landing, schema, bytes_per_batch=args.batch_bytes
        )
    tables = OrderTables.at(spark, args.tables, args.package_slices)
    trigger = every(args.every) if args.every else AVAILABLE_NOW
    with large_state(spark) if args.once_within else nullcontext():
        flow = run_order_flow(
            stream,
            tables,
            args.checkpoint,
            args.app,
            raw=raw,
            trigger=trigger,
            compact_every=args.compact_every,
            once_within=args.once_within,
        )
        finish(flow)


if __name__ == "__main__":
    main()
