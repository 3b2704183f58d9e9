"""Dimension tables with surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import date_parts, event_category, event_description
from footfall.schemas import (
    ALL,
    DATE_KEYS,
    DATE_TYPE_DAY,
    EVENT_KEYS,
    LOCATION_KEYS,
    PLATFORM_KEYS,
)
from footfall.session import work_dir


def date_rows(df: DataFrame, day: str = "dt") -> DataFrame:
    """Natural keys of the date dimension for each row."""
    parts = {k: v.alias(k) for k, v in date_parts(day).items()}
    return df.select(
        *parts.values(),
        F.date_format(day, "yyyy-MM-dd").alias("calendar"),
        F.lit(DATE_TYPE_DAY).alias("type"),
    )


def platform_rows(df: DataFrame, platform: str = "platform") -> DataFrame:
    return df.select(F.col(platform).alias("platform_name"))


def location_rows(df: DataFrame) -> DataFrame:
    return df.select(*LOCATION_KEYS)


def event_rows(df: DataFrame, event: str = "event_name") -> DataFrame:
    return df.select(
        F.col(event).alias("event_name"),
        event_description(event).alias("event_description"),
        event_category(event).alias("category"),
    )


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


def number_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_number``: 1, 2, 3 … in the order of the keys, which must be distinct.

    The rows are placed in key ranges, which are numbered side by side and shifted by the
    sizes of the ranges before. The ranges are checkpointed, since their bounds come from a
    sample that a second run might draw differently.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_dir(spark, "numbering"))
    placed = (
        df.repartitionByRange(max(2, context.defaultParallelism), *keys)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range.
    shifts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(shifts), "_range")
        .withColumn("_number", F.col("_inside") + F.col("_shift"))
        .drop("_range", "_inside", "_shift")
    )


def get_or_create_dim(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension, extended by the keys of the facts it lacks; without any, it itself.

    New ids follow the largest old one in key order. A null in a key is a value that is
    found again.
    """
    wanted = facts.select(*keys).distinct()
    new = wanted.join(dim, _same(wanted, dim, keys), "left_anti")
    if new.isEmpty():
        return dim
    largest = dim.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered = number_rows(new, keys)
    fresh = numbered.select((F.col("_number") + largest).cast("bigint").alias("id"), *keys)
    return dim.select(F.col("id").cast("bigint").alias("id"), *keys).unionByName(fresh)


def add_dim_id(facts: DataFrame, dim: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Look up the id of each row by the natural keys, null-safe.

    How to join is left to the optimizer, or to a hint the dimension carries.
    """
    other = dim.select(F.col("id").alias(name), *[F.col(k).alias(f"_dim_{k}") for k in keys])
    on = reduce(
        Column.__and__, [facts[k].eqNullSafe(other[f"_dim_{k}"]) for k in keys]
    )
    return facts.join(other, on, "left").drop(*[f"_dim_{k}" for k in keys])


def report_keys(report: DataFrame) -> DataFrame:
    """A report with the natural keys of every dimension it has.

    Recognised columns: dt or date, platform, country/province/city, event_name. A report
    per province has the city ``all``.
    """
    day = "dt" if "dt" in report.columns else "date"
    parts = date_parts(day)
    out = report.select(
        *report.columns,
        *[v.alias(k) for k, v in parts.items()],
        F.date_format(day, "yyyy-MM-dd").alias("calendar"),
        F.lit(DATE_TYPE_DAY).alias("type"),
    )
    if "platform" in report.columns:
        out = out.withColumn("platform_name", F.col("platform"))
    if "event_name" in report.columns:
        out = out.withColumn("event_description", event_description("event_name")).withColumn(
            "category", event_category("event_name")
        )
    if "country" in report.columns and "city" not in report.columns:
        out = out.withColumn("city", F.lit(ALL))
    return out


DIM_KEYS = {
    "date": DATE_KEYS,
    "platform": PLATFORM_KEYS,
    "location": LOCATION_KEYS,
    "event": EVENT_KEYS,
}


def dims_of(report: DataFrame) -> list[str]:
    """Names of the dimensions a report has, after :func:`report_keys`."""
    return [name for name, keys in DIM_KEYS.items() if set(keys) <= set(report.columns)]


def resolve_report_ids(report: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Replace the natural keys of a report by the ids of its dimensions.

    The dimensions must hold every key; :func:`get_or_create_dim` sees to that. The day
    stays as ``dt``, by which the report tables are partitioned, and as the text ``created``.
    """
    keyed = report_keys(report)
    names = dims_of(keyed)
    out = keyed
    for name in names:
        out = add_dim_id(out, dims[name], DIM_KEYS[name], f"{name}_dimension_id")
    natural = {"dt", "date", "platform", "rank", *[k for n in names for k in DIM_KEYS[n]]}
    measures = [c for c in report.columns if c not in natural]
    day = "dt" if "dt" in report.columns else "date"
    return out.select(
        *[f"{n}_dimension_id" for n in names],
        *measures,
        F.col("calendar").alias("created"),
        F.col(day).alias("dt"),
    )
