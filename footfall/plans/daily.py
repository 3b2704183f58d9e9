"""Daily reports: five report tables out of the event table.

``python -m footfall.plans.daily 2024-01-01 --table /event_log --out /reports``
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import storage
from footfall.operators import products, reports
from footfall.operators.dims import (
    DIM_KEYS,
    dims_of,
    get_or_create_dim,
    report_keys,
    resolve_report_ids,
)
from footfall.operators.visits import visit_grain
from footfall.plans.days import parse_day
from footfall.schemas import DIM_DATE, DIM_EVENT, DIM_LOCATION, DIM_PLATFORM
from footfall.session import build_session, remove_work_dirs
from footfall.sinks.tables import replace_day
from footfall.sources import read_event_log

DIM_SCHEMAS = {
    "date": DIM_DATE,
    "platform": DIM_PLATFORM,
    "location": DIM_LOCATION,
    "event": DIM_EVENT,
}

VISIT_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "session_aggr_stat": reports.session_aggr_stat,
    "stats_user": reports.user_stats,
    "stats_device_location": reports.device_location_stats,
}


def top_products(events: DataFrame) -> DataFrame:
    counts = products.area_product_counts(products.product_views(events))
    return products.area_top_products(products.area_product_rollup(counts))


def daily_reports(events: DataFrame, visits: DataFrame) -> dict[str, DataFrame]:
    """The five reports on natural keys. ``visits`` is the full grain of ``events``."""
    return {
        **{name: build(visits) for name, build in VISIT_REPORTS.items()},
        "stats_event": reports.event_stats(events),
        "area_top3_product": top_products(events),
    }


def empty_dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in DIM_SCHEMAS.items()}


def extend_dims(
    dims: dict[str, DataFrame], found: list[DataFrame], names: tuple[str, ...] = tuple(DIM_KEYS)
) -> dict[str, DataFrame]:
    """Dimensions that also hold every key of the reports."""
    out = dict(dims)
    keyed = [report_keys(report) for report in found]
    for name in names:
        keys = DIM_KEYS[name]
        having = [k.select(*keys).distinct() for k in keyed if name in dims_of(k)]
        if having:
            wanted = having[0]
            for other in having[1:]:
                wanted = wanted.unionByName(other)
            out[name] = get_or_create_dim(wanted, dims[name], keys)
    return out


def load_dims(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The newest complete version of each dimension; empty where there is none yet."""
    dims = empty_dims(spark)
    for name in dims:
        version = _newest(spark, f"{root}/{name}")
        if version is not None:
            dims[name] = spark.read.schema(DIM_SCHEMAS[name]).parquet(
                f"{root}/{name}/version={version}"
            )
    return dims


def _newest(spark: SparkSession, folder: str) -> int | None:
    versions = [
        int(name.split("=", 1)[1])
        for name in storage.children(spark, folder)
        if name.startswith("version=")
    ]
    done = [v for v in versions if storage.exists(spark, f"{folder}/version={v}/_SUCCESS")]
    return max(done, default=None)


def save_dims(spark: SparkSession, dims: dict[str, DataFrame], root: str) -> None:
    """Write a new version of each given dimension and keep the one before, which may be in
    use. Only one job at a time may extend the dimensions.
    """
    for name, dim in dims.items():
        newest = _newest(spark, f"{root}/{name}")
        version = 0 if newest is None else newest + 1
        dim.write.mode("overwrite").parquet(f"{root}/{name}/version={version}")
        storage.remove(spark, f"{root}/{name}/version={version - 2}")


def grow_dims(spark: SparkSession, found: list[DataFrame], root: str) -> dict[str, DataFrame]:
    """The stored dimensions, after a new version of those that lack a key of the reports."""
    stored = load_dims(spark, root)
    grown = extend_dims(stored, found)
    changed = {n: d for n, d in grown.items() if d is not stored[n]}
    first = {n: d for n, d in stored.items() if _newest(spark, f"{root}/{n}") is None}
    save_dims(spark, first | changed, root)
    return load_dims(spark, root)


def run_daily(spark: SparkSession, table: str, out: str, day: date) -> None:
    """Write the reports of one day to ``out``, replacing what is there for that day.

    The event table is scanned once for the visit grain, once for the event counts and once
    for the products, each time with its own columns. The reports are written on natural
    keys first: that breaks the lineage before the dimensions are extended and looked up.
    """
    events = read_event_log(spark, table, day)
    visits = visit_grain(events).persist(StorageLevel.MEMORY_AND_DISK)
    natural = {}
    for name, report in daily_reports(events, visits).items():
        path = f"{out}/_natural/{name}"
        replace_day(report, path, day)
        natural[name] = (
            spark.read.schema(report.schema)
            .parquet(f"{path}/dt={day:%Y-%m-%d}")
            .withColumn("date" if "date" in report.columns else "dt", F.lit(day))
        )
    visits.unpersist()
    dims = grow_dims(spark, list(natural.values()), f"{out}/dims")
    for name, report in natural.items():
        replace_day(resolve_report_ids(report, dims), f"{out}/{name}", day)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("day", type=parse_day)
    parser.add_argument("--table", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--time-zone", default="UTC")
    args = parser.parse_args(argv)
    spark = build_session("footfall-daily", time_zone=args.time_zone)
    run_daily(spark, args.table, args.out, args.day)
    remove_work_dirs(spark)


if __name__ == "__main__":
    main()
