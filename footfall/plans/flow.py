"""Running traffic report: a stream of log lines into a table of totals per location.

``python -m footfall.plans.flow --servers host:9092 --topic event_log --rules /ip_rules
--table /flow --checkpoint /checkpoints/flow --out /reports``; with ``--dir`` lines come from
new files instead, with ``--tail`` from files that grow.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.dims import resolve_report_ids
from footfall.operators.parse import rejected
from footfall.plans.daily import grow_dims
from footfall.session import build_session
from footfall.sinks.streams import trigger
from footfall.sinks.tables import merge_partitions
from footfall.sources import read_ip_rules, read_kafka, stream_growing_files, stream_text_dir
from footfall.streaming.flow import read_flow, stream_location_flow


def publish_flow(
    spark: SparkSession, table: str, out: str, days: Sequence[date] | None = None
) -> None:
    """Write the current totals with dimension ids, next to the daily reports in ``out``.

    Only the given days are read and replaced, by default all, and the dimensions get a new
    version only if a key is new. Doing it again changes nothing.
    """
    flow = read_flow(spark, table, days)
    report = resolve_report_ids(flow, grow_dims(spark, [flow], f"{out}/dims"))
    path = f"{out}/stats_location_flow"
    merge_partitions(report, path, lambda old, new: new, f"{path}__staging/{uuid.uuid4().hex}")


def run_flow(
    lines: DataFrame, rules: DataFrame, table: str, checkpoint: str, out: str, **settings
) -> StreamingQuery:
    """The running totals, published after each batch for the days it touched."""

    def publish(spark: SparkSession, days: list[date]) -> None:
        publish_flow(spark, table, out, days)

    return stream_location_flow(lines, rules, table, checkpoint, after=publish, **settings)


def keep_rejected(
    lines: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """The lines the report leaves out, with the reason, as rows of ``table``.

    A query of its own over the same source, with its own checkpoint.
    """
    writer = rejected(lines).writeStream.format("parquet").option("path", table)
    return trigger(writer.option("checkpointLocation", checkpoint), every).start()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic")
    source.add_argument("--dir", help="folder to which files are added")
    source.add_argument("--tail", help="folder whose files grow")
    parser.add_argument("--servers")
    parser.add_argument("--reset", default="latest")
    parser.add_argument("--rules", required=True)
    parser.add_argument("--table", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--out", required=True, help="folder of the reports and dimensions")
    parser.add_argument("--rejected", help="table of the lines that are left out")
    parser.add_argument("--every", default="5 seconds")
    parser.add_argument("--delay", help="let the state of days go that are this far behind")
    parser.add_argument("--per-batch", type=int, help="most offsets or files in one batch")
    parser.add_argument("--state-partitions", type=int)
    parser.add_argument("--time-zone", default="UTC")
    args = parser.parse_args(argv)
    spark = build_session("footfall-flow", time_zone=args.time_zone)
    if args.dir:
        lines = stream_text_dir(spark, args.dir, args.per_batch)
    elif args.tail:
        lines = stream_growing_files(spark, args.tail).select("value")
    else:
        lines = read_kafka(
            spark,
            args.servers,
            args.topic,
            reset=args.reset,
            max_offsets_per_trigger=args.per_batch,
        )
    if args.rejected:
        keep_rejected(lines, args.rejected, f"{args.checkpoint}__rejected", args.every)
    run_flow(
        lines,
        read_ip_rules(spark, args.rules),
        args.table,
        args.checkpoint,
        args.out,
        every=args.every,
        delay=args.delay,
        state_partitions=args.state_partitions,
    ).awaitTermination()


if __name__ == "__main__":
    main()
