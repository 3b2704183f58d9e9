"""Daily load: raw lines of a day into the event table.

``python -m footfall.plans.etl 2024-01-01 --logs /logs --rules /rules --table /event_log``
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import Observation, SparkSession

from footfall import storage
from footfall.operators.parse import enrich, rejected, with_row_key
from footfall.plans.days import parse_day
from footfall.session import build_session
from footfall.sinks.tables import in_read_order, replace_day, store_parsed, write_event_log
from footfall.sources import read_ip_rules, read_logs


def run_etl(
    spark: SparkSession, logs: str, rules: str, table: str, day: date
) -> dict[str, int]:
    """Load one day; gives the number of lines read and of those left out.

    The lines left out are kept, with the reason, as that day of ``<table>__rejected``.
    Running a day again changes nothing, as its records meet their own row keys.
    """
    counts = Observation("etl")
    table = table.rstrip("/")
    lines = in_read_order(read_logs(spark, logs, day))
    rules = read_ip_rules(spark, rules)
    judged = with_row_key(enrich(lines, rules, counts, keep_rejected=True))
    staging = f"{table}__staging/{day:%Y-%m-%d}"
    # Lines are read and judged once; records and lines left out are parts of what is stored.
    stored = store_parsed(judged, staging)
    write_event_log(stored.where("reason IS NULL"), table, staging, stored=True)
    replace_day(rejected(stored, judged=True), f"{table}__rejected", day)
    storage.remove(spark, staging)
    return dict(counts.get)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("day", type=parse_day)
    parser.add_argument("--logs", required=True)
    parser.add_argument("--rules", required=True)
    parser.add_argument("--table", required=True)
    parser.add_argument("--time-zone", default="UTC")
    args = parser.parse_args(argv)
    spark = build_session("footfall-etl", time_zone=args.time_zone)
    counts = run_etl(spark, args.logs, args.rules, args.table, args.day)
    print(", ".join(f"{name}={value}" for name, value in counts.items()))


if __name__ == "__main__":
    main()
