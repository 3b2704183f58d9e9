"""What several operators share: scratch tables, row names, and a distributed running count."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import work_dir

# The white space the contracts name: space and the controls 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but on the same path."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    This cuts the lineage: what is lost with an executor is read again, not computed again, and
    every reader sees the same rows.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a file scan, but for chosen columns and filtered rows."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def identified(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that names each row alike in every scan of what is returned.

    A row number given while reading depends on how the files are packed into tasks, and so on
    the number of cores that are alive. The name is made from the row's file and its place there
    instead: two hashes of 64 bits, so among a million million rows two share one with a
    probability of 1.5e-15. A frame that is no scan of files that know places is stored first.
    """
    if _is_scan(df):
        meta = df.metadataColumn("_metadata")
        place = (meta["file_path"], meta["row_index"])
        try:
            hashes = F.xxhash64(*place).alias("a"), F.xxhash64(*reversed(place)).alias("b")
            return df.withColumn(name, F.struct(*hashes))
        except AnalysisException:
            pass
    return identified(stored(df, "rows"), name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names are compared without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    bucket: str,
    into: str,
) -> DataFrame:
    """Adds ``into``: the sum of ``amount`` over the rows before this one among those of ``keys``.

    The order is (``bucket``, ``order``). Only rows of one bucket are sorted together; the sums
    of whole buckets are added up in a second window that sees one row per bucket. A key with a
    third of all rows is thus spread over as many tasks as it has buckets. ``keys`` and
    ``bucket`` must not be null. Rows equal in all of these are interchangeable.
    """
    keys = list(keys)
    earlier = (Window.unboundedPreceding, -1)
    start = fresh(df, "bucket_start")
    starts = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(amount).alias(start))
        .withColumn(
            start,
            F.sum(start).over(Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*earlier)),
        )
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(*earlier)
    rows = df.withColumn(into, F.sum(amount).over(inside))
    return (
        rows.join(starts, [*keys, bucket])
        .withColumn(into, F.coalesce(into, F.lit(0)) + F.coalesce(start, F.lit(0)))
        .select(*[quoted(c) for c in df.columns], into)
    )
