"""Range join by a sweep: rows and range starts in one order, the last start carried forward.

The order is cut into parts at quantiles of the rows. A row's part is found by binary search over
the cuts, so rows and starts meet after a single exchange of the rows, and nothing is copied. What
a part needs from the parts before it is one range: the last that started there. A value that many
rows share is cut too, by a salt behind it, and each of its parts is handed the range it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BITS = 16
#: Parts per shuffle partition: they are dealt out by hash, and more even out better.
PARTS_PER_TASK = 4
#: Rank error of the cuts is one in so many rows. It moves the borders, not the results.
ACCURACY = 10_000
NO_CUT = 2**63 - 1


def hashable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form that can be hashed; a map as its entries."""
    return [
        F.map_entries(name) if kind.startswith("map") else F.col(name)
        for name, kind in df.dtypes
        if not (kind.startswith(("array", "struct")) and "map<" in kind)
    ]


def find_cuts(rows: DataFrame, place: str, parts: int) -> list[int]:
    """At most ``parts - 1`` places that cut the rows into parts of about the same size."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = rows.agg(F.percentile_approx(place, shares, ACCURACY)).first()[0]
    return sorted(set(found or []))


def with_part(df: DataFrame, place: str, cuts: list[int], into: str) -> DataFrame:
    """Adds the number of cuts at or below ``place``, by binary search in as many projections as
    the number of cuts has digits."""
    size = 1 << len(cuts).bit_length()
    padded = F.array(*[F.lit(c) for c in [*cuts, *[NO_CUT] * (size - len(cuts))]])
    out = df.withColumn(into, F.lit(0))
    while size > 1:
        size //= 2
        beyond = F.get(padded, F.col(into) + (size - 1)) <= F.col(place)
        out = out.withColumn(into, F.col(into) + F.when(beyond, size).otherwise(0))
    return out


def sweep_join(
    rows: DataFrame,
    at: str,
    ranges: DataFrame,
    start: str,
    value: Column,
    into: str,
    parts: int | None = None,
    cuts: list[int] | None = None,
) -> DataFrame:
    """``rows`` with ``into``: the ``value`` of the last range that starts at or before ``at``.

    ``at`` and ``start`` are numbers of at most 46 bits, ``at`` perhaps null: such rows get null.
    The caller compares ``at`` with the range's end, which should be in ``value``. Starts must
    not repeat. ``cuts`` are those of :func:`find_cuts`, for instance of the day before; without
    them the rows are read once more for their quantiles. Rows that are equal in all columns
    share a salt.
    """
    spark = rows.sparkSession
    if parts is None:
        parts = PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*hashable(rows)), F.lit(1 << SALT_BITS))
    here = F.shiftleft(F.coalesce(F.col(at), F.lit(0)).cast("bigint"), SALT_BITS)
    placed = rows.withColumn("_place", here + salt)
    if cuts is None:
        cuts = find_cuts(placed, "_place", parts)
    placed = with_part(placed, "_place", cuts, "_part").withColumn("_known", F.lit(None))
    starts = ranges.select(
        F.shiftleft(F.col(start).cast("bigint"), SALT_BITS).alias("_place"), value.alias("_known")
    )
    starts = with_part(starts, "_place", cuts, "_part")
    # One row per part, so this window is as small as the number of parts.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = spark.range(len(cuts) + 1).select(F.col("id").cast("int").alias("_part"))
    last = starts.groupBy("_part").agg(F.max_by("_known", "_place").alias("_last"))
    carried = every.join(last, "_part", "left").select(
        F.lit(-1).cast("bigint").alias("_place"),
        "_part",
        F.last("_last", ignorenulls=True).over(before).alias("_known"),
    )
    marks = starts.select("_place", "_part", "_known").union(carried)
    both = placed.withColumn("_is_row", F.lit(True)).unionByName(
        marks.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
    )
    # Of a start and rows at its place, the start comes first.
    so_far = (
        Window.partitionBy("_part")
        .orderBy("_place", "_is_row")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = F.last("_known", ignorenulls=True).over(so_far)
    return (
        both.withColumn(into, F.when(F.col(at).isNotNull(), found))
        .where("_is_row")
        .select(*rows.columns, into)
    )
