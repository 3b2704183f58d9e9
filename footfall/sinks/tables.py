"""Parquet tables partitioned by day, with replacement and upsert by partition.

An upsert never overwrites what it reads. It first writes the new rows to a staging folder,
which computes them once and shows the days they touch. The stored rows of those days are
merged with them into new partitions, again in staging, and these are moved into place once
all are complete. A run that dies while moving leaves the rest in staging; the next one
moves it first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import storage
from footfall.functions import day_of
from footfall.operators.sizes import BROADCAST_BYTES
from footfall.schemas import EVENT_LOG, KNOWN_CELLS

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def replace_day(df: DataFrame, path: str, day: date) -> None:
    """Make ``df`` the whole content of one day's partition, also when it is empty.

    The rows are complete in a staging folder next to the table before the old ones go, so
    ``df`` may read the table itself, and a write that fails leaves the day as it was.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"dt={day:%Y-%m-%d}"
    staging = f"{path}__staging/replace-{uuid.uuid4().hex}"
    try:
        df.drop("dt").write.parquet(f"{staging}/{name}")
        _move_days(spark, [name], staging, path)
    finally:
        storage.remove(spark, staging)


def _days(spark: SparkSession, path: str) -> list[str]:
    return [name for name in storage.children(spark, path) if name.startswith("dt=")]


def _move_days(spark: SparkSession, names: list[str], source: str, target: str) -> None:
    for name in names:
        storage.move(spark, f"{source}/{name}", f"{target}/{name}")


def _dates(names: list[str]) -> list[date]:
    return [date.fromisoformat(name.split("=", 1)[1]) for name in sorted(names)]


def is_ready(spark: SparkSession, staging: str) -> bool:
    """Whether all that :func:`merge_partitions` made is complete in ``staging``."""
    return storage.exists(spark, f"{staging}/_READY")


def merge_partitions(
    new: DataFrame,
    path: str,
    merge: Merge,
    staging: str,
    once: bool = False,
    fresh_as_is: bool = True,
) -> list[date]:
    """Rewrite the partitions that hold a day of ``new`` as ``merge(old rows, new)``.

    Days the table does not have yet take the new rows as they are, unless ``fresh_as_is``
    is off; then ``merge`` sees them too, with None for a table without any of the days.
    ``staging`` must be a folder no other job writes. With ``once``, a staging folder that
    is ready means that this very work was done before: what is left of it is moved, and
    nothing is computed. Gives the days of ``new``.
    """
    spark, path = new.sparkSession, path.rstrip("/")
    incoming, ready, mark = f"{staging}/incoming", f"{staging}/ready", f"{staging}/_READY"
    if is_ready(spark, staging):
        _move_days(spark, _days(spark, ready), ready, path)
        if once:
            return _dates(_days(spark, incoming))
    storage.remove(spark, staging)
    new.write.partitionBy("dt").parquet(incoming)
    arrived = _days(spark, incoming)
    stored = sorted(set(arrived) & set(_days(spark, path)))
    fresh = [name for name in arrived if name not in stored]
    if stored or not fresh_as_is:
        touched = [name.split("=", 1)[1] for name in stored]
        on_days = F.col("dt").cast("string").isin(touched)
        rows = spark.read.schema(new.schema).parquet(incoming).select(*new.columns)
        old = None
        if stored:
            # Only the folders of these days are listed, not the table.
            folders = spark.read.schema(new.schema).option("basePath", path)
            old = folders.parquet(*[f"{path}/{n}" for n in stored]).select(*new.columns)
        if fresh_as_is:
            rows = rows.where(on_days)
        merge(old, rows).write.partitionBy("dt").parquet(ready)
    if fresh_as_is:
        _move_days(spark, fresh, incoming, ready)
    storage.touch(spark, mark)
    _move_days(spark, _days(spark, ready), ready, path)
    if not once:
        storage.remove(spark, staging)
    return _dates(arrived)


def upsert(
    df: DataFrame, path: str, keys: Sequence[str], staging: str, once: bool = False
) -> None:
    """Insert rows, or replace those with the same keys; ``keys`` must include ``dt`` or be
    unique within a day. The keys of ``df`` must be distinct."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        a, b = old.alias("a"), new.alias("b")
        on = reduce(
            Column.__and__,
            [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in dict.fromkeys(("dt", *keys))],
        )
        return a.join(b, on, "left_anti").unionByName(new)

    merge_partitions(df, path, merge, staging, once)


def _params() -> Column:
    return F.coalesce("params", F.create_map().cast("map<string,string>"))


def _cells() -> Column:
    """All cells of a record that are present, in one map."""
    known = F.map_from_entries(
        F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in KNOWN_CELLS])
    )
    return F.map_concat(F.map_filter(known, lambda _, v: v.isNotNull()), _params())


def _present() -> list[Column]:
    """Which cells of a record are present: the known ones as bits, and the names of the others."""
    bits = [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(KNOWN_CELLS)]
    return [sum(bits, F.lit(0)).alias("_known"), F.sort_array(F.map_keys(_params())).alias("_names")]


def _with_day(records: DataFrame) -> DataFrame:
    """Time and day of merged records, which follow from their cells."""
    timed = records.withColumn("access_time_ms", F.col("access_time").try_cast("bigint"))
    return timed.withColumn("dt", day_of("access_time_ms")).select(*EVENT_LOG.names)


def merge_cells(records: DataFrame, order: str = "seq") -> DataFrame:
    """One record per row key: each cell keeps its latest value, and a cell that a later
    record lacks survives.

    Of the records of a key with the same cells present the latest says all, so these are
    combined as whole records before the shuffle, and a key that repeats without end sends one
    row per task and set of cells. Only what is left is merged cell by cell.
    """
    record = F.struct(*KNOWN_CELLS, "params")
    packed = records.select("row_key", *_present(), F.col(order).alias("_order"), record.alias("_r"))
    latest = packed.groupBy("row_key", "_known", "_names").agg(
        F.max("_order").alias("_order"), F.max_by("_r", "_order").alias("_r")
    )
    cells = F.map_entries(_cells()).alias("_cells")
    sets = latest.select("row_key", "_order", "_r.*").select("row_key", "_order", cells)
    merged = sets.groupBy("row_key").agg(
        F.array_sort(F.collect_list(F.struct("_order", "_cells"))).alias("_records")
    )
    # Of a name that comes several times the map keeps the last value (RUNTIME_CONF).
    later = F.map_from_entries(F.flatten(F.col("_records._cells")))
    return _with_day(
        merged.select("row_key", F.explode(F.array(later)).alias("_c")).select(
            "row_key",
            *[F.col("_c")[c].alias(c) for c in KNOWN_CELLS],
            F.map_filter("_c", lambda k, _: ~k.isin(*KNOWN_CELLS)).alias("params"),
        )
    )


def merge_whole(records: DataFrame, order: str = "seq") -> DataFrame:
    """:func:`merge_cells` for keys all of whose records have the same cells present: the latest
    record of each key. It is shuffled once, and no cell is looked at."""
    record = F.struct(*KNOWN_CELLS, _params().alias("params"))
    packed = records.select("row_key", F.col(order).alias("_order"), record.alias("_r"))
    latest = packed.groupBy("row_key").agg(F.max_by("_r", "_order").alias("_r"))
    return _with_day(latest.select("row_key", "_r.*"))


def merge_repeats(
    records: DataFrame, order: str = "seq", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`merge_cells`, but records whose key does not repeat are passed on where they are,
    and keys whose records have the same cells present are merged as wholes.

    Only hashes are shuffled to find the keys that repeat, and those with several sets of cells.
    As long as the former are few they are broadcast, and only their records are shuffled and
    merged; otherwise all are. As long as the latter are few they are broadcast, and only their
    records are merged cell by cell; otherwise all are. Two keys with the same hash are merged
    too, each with itself. ``records`` should be a stored table, since it is read more than once.
    """
    code = F.xxhash64("row_key")
    present = _present()
    # A set of cells goes by two hashes of 64 bits; names of known cells among the parameters are
    # put where they belong only cell by cell.
    astray = F.arrays_overlap(F.map_keys(_params()), F.array(*map(F.lit, KNOWN_CELLS)))
    marked = records.select(
        code.alias("_code"),
        F.xxhash64(*present).alias("_a"),
        F.xxhash64(F.lit(1), *present).alias("_b"),
        F.when(F.size("params") > 0, astray).otherwise(F.lit(False)).alias("_astray"),
    )
    differ = F.min("_a") != F.max("_a")
    differ |= F.min("_b") != F.max("_b")
    repeated = (
        marked.groupBy("_code")
        .agg(F.count(F.lit(1)).alias("_n"), (differ | F.bool_or("_astray")).alias("_mixed"))
        .where("_n > 1")
        .select("_code", "_mixed")
    )
    found = repeated.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_mixed").alias("mixed")
    ).first()
    # A row is a number and a flag: 16 bytes.
    if found["mixed"] * 16 > broadcast_bytes:
        return merge_cells(records, order)
    few = found["n"] * 16 <= broadcast_bytes
    if few or found["mixed"]:
        marks = repeated if few else repeated.where("_mixed")
        records = records.join(F.broadcast(marks), code == F.col("_code"), "left")
    parts = []
    if few:
        parts.append(records.where(F.col("_mixed").isNull()).select(*EVENT_LOG.names))
    whole = ~F.col("_mixed") if few else F.col("_mixed").isNull()
    parts.append(merge_whole(records.where(whole) if few or found["mixed"] else records, order))
    if found["mixed"]:
        parts.append(merge_cells(records.where("_mixed"), order))
    return reduce(DataFrame.unionByName, parts)


def in_read_order(records: DataFrame) -> DataFrame:
    """Add ``seq`` to a scan of files: path, place of the block in it, and row in the block.

    The row number alone would follow the packing of files into tasks, which depends on their
    sizes and on the cluster.
    """
    return records.withColumn(
        "seq",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def store_parsed(records: DataFrame, staging: str) -> DataFrame:
    """The records as a table in ``staging``, so that lines are parsed once."""
    parsed = f"{staging}/parsed"
    records.write.mode("overwrite").parquet(parsed)
    return records.sparkSession.read.schema(records.schema).parquet(parsed)


def write_event_log(
    records: DataFrame, path: str, staging: str, order: str = "seq", stored: bool = False
) -> None:
    """Upsert records by row key into the event table.

    The records are stored in staging, so that lines are parsed once, and merged among
    themselves in ``order``. Only days the table holds already are merged once more, with
    what is stored there counting as earlier; so a few late lines of the day before do not
    cost that day its other events. With ``stored``, ``records`` is part of what
    :func:`store_parsed` gave, and ``staging`` is left for the caller to remove.
    """

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge_repeats(
            old.withColumn(order, F.lit(0)).unionByName(new.withColumn(order, F.lit(1))), order
        )

    columns = [*[c for c in EVENT_LOG.names if c != "dt"], order, "dt"]
    placed = records.select(*columns)
    if not stored:
        placed = store_parsed(placed, staging)
    merge_partitions(merge_repeats(placed, order), path, merge, f"{staging}/merge")
    if not stored:
        storage.remove(records.sparkSession, staging)
