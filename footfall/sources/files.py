from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import storage
from footfall.functions import java_split
from footfall.schemas import EVENT_LOG, LOG_COLUMNS


class MissingLogs(ValueError):
    """The day has no log files."""


def log_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}"


def log_exists(spark: SparkSession, root: str, day: date) -> bool:
    """Whether the folder of the day holds at least one data file."""
    names = storage.children(spark, log_path(root, day))
    return any(not name.startswith(("_", ".")) for name in names)


def read_logs(spark: SparkSession, root: str, day: date) -> DataFrame:
    """The raw lines of ``<root>/yyyy/MM/dd``; raises where the day has none."""
    if not log_exists(spark, root, day):
        raise MissingLogs(f"no logs for {day} in {log_path(root, day)}")
    return spark.read.text(log_path(root, day))


def read_landed(spark: SparkSession, root: str, day: date | None = None) -> DataFrame:
    """Lines a stream landed in ``root``, of one day or all.

    Reading from the root lets Spark use the sink's own log, so files of a failed attempt
    are not seen; the day is a partition filter.
    """
    lines = spark.read.text(root)
    if day is not None:
        lines = lines.where(F.col("dt") == F.lit(day))
    return lines.select("value")


def read_ip_rules(spark: SparkSession, path: str) -> DataFrame:
    """IP rules: numeric start and end, country, province, city.

    Lines are split by hand, since a city may be empty and must stay so. A line that is no
    rule keeps its place with null bounds, for :func:`check_rules` to refuse.
    """
    fields = java_split("value", "|")
    return (
        spark.read.text(path)
        .select(
            F.when(F.size(fields) >= 8, F.get(fields, F.lit(2)).try_cast("bigint")).alias(
                "start_num"
            ),
            F.get(fields, F.lit(3)).try_cast("bigint").alias("end_num"),
            F.get(fields, F.lit(5)).alias("country"),
            F.get(fields, F.lit(6)).alias("province"),
            F.get(fields, F.lit(7)).alias("city"),
        )
    )


def read_event_log(
    spark: SparkSession, path: str, start: date, stop: date | None = None
) -> DataFrame:
    """Events of the days ``[start, stop)``, by default of one day.

    The days select partitions; only the columns the reports use are read.
    """
    stop = stop or start + timedelta(days=1)
    return (
        spark.read.schema(EVENT_LOG)
        .parquet(path)
        .where((F.col("dt") >= F.lit(start)) & (F.col("dt") < F.lit(stop)))
        .select(*LOG_COLUMNS, "access_time_ms", "dt")
    )
