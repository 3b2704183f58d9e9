"""Region of an IP address by a range join.

A rule covers the numbers from start to end, both included. Rules are cut into aligned
buckets, so that the range condition comes with an equality and the join can hash. The
width of the buckets follows the width of the rule: a rule of up to 256 addresses uses
buckets of 256, one of up to 65,536 uses buckets of 65,536, a wider one buckets of 2^24.
Since rules do not overlap, a bucket then holds at most 258 rules and a rule fills at most
257 buckets: neither the lookups per address nor the table can blow up.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import ip_parts, parts_to_long
from footfall.operators.sizes import BROADCAST_BYTES
from footfall.operators.sweep import hashable, sweep_join
from footfall.schemas import REGION_COLUMNS, UNKNOWN

BUCKET_BITS = (8, 16, 24)
MAX_IP = 2**32 - 1
SALTS = 64


class BadRules(ValueError):
    """Rules that overlap, lie outside the address space or are no rules."""


def _with_bits(rules: DataFrame) -> DataFrame:
    width = F.col("end_num") - F.col("start_num")
    return rules.withColumn(
        "_bits", F.when(width < 2**8, 8).when(width < 2**16, 16).otherwise(24)
    )


def bucket_rules(rules: DataFrame, bits: int) -> DataFrame:
    """The rules of one width class, one row per bucket they touch."""
    first = F.shiftright("start_num", bits)
    last = F.shiftright("end_num", bits)
    return (
        _with_bits(rules)
        .where(F.col("_bits") == bits)
        .select(
            "start_num",
            "end_num",
            F.struct(*REGION_COLUMNS).alias("_region"),
            F.explode(F.sequence(first, last)).alias("_bucket"),
        )
    )


class RuleSize(NamedTuple):
    """Rows of one width class after bucketing, and about how many bytes they take."""

    rows: int
    bytes: int


def check_rules(rules: DataFrame) -> dict[int, RuleSize]:
    """The size of each width class; raises for rules that cannot be joined.

    These are rules without numeric bounds, with a start behind their end, outside the
    address space, or overlapping. Two rules that overlap share a slot of 65,536 addresses,
    so a window per slot finds every overlap. One check serves any number of joins.
    """
    def slot(number: str) -> Column:
        return F.shiftright(F.greatest(F.lit(0), F.least(F.col(number), F.lit(MAX_IP))), 16)

    def bucket(number: str) -> Column:
        shifted = [F.when(F.col("_bits") == b, F.shiftright(number, b)) for b in BUCKET_BITS]
        return F.coalesce(*shifted)

    fine = F.coalesce(F.col("start_num") <= F.col("end_num"), F.lit(False))
    slots = F.when(fine, F.sequence(slot("start_num"), slot("end_num")))
    first = F.col("_slot") == slot("start_num")
    before = (
        Window.partitionBy("_slot")
        .orderBy("start_num", "end_num")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    buckets = F.when(first, bucket("end_num") - bucket("start_num") + 1)
    # Two bounds, a bucket and the headers of three texts, besides the texts themselves.
    texts = [F.octet_length(F.coalesce(c, F.lit(""))) for c in REGION_COLUMNS]
    width = sum(texts, F.lit(72))
    found = (
        _with_bits(rules)
        .withColumn("_slot", F.explode_outer(slots))
        .withColumn("_reach", F.max("end_num").over(before))
        .groupBy("_bits", fine.alias("fine"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(buckets).alias("rows"),
            F.sum(buckets * width).alias("bytes"),
            F.bool_or((F.col("start_num") < 0) | (F.col("end_num") > MAX_IP)).alias("outside"),
            F.bool_or(F.col("start_num") <= F.col("_reach")).alias("overlap"),
        )
        .collect()
    )
    broken = sum(row["n"] for row in found if not row["fine"])
    if broken:
        raise BadRules(f"{broken} lines are no IP rules")
    if any(row["outside"] for row in found):
        raise BadRules("an IP rule lies outside the address space")
    if any(row["overlap"] for row in found):
        raise BadRules("IP rules overlap")
    return {row["_bits"]: RuleSize(row["rows"], row["bytes"]) for row in found}


def ip_region_join(
    logs: DataFrame,
    rules: DataFrame,
    ip: str = "ip",
    broadcast_bytes: int = BROADCAST_BYTES,
    sizes: dict[int, RuleSize] | None = None,
    cuts: list[int] | None = None,
) -> DataFrame:
    """Add country, province and city of the address; ``unknown`` where no rule covers it.

    Classes are broadcast, the smallest first, as long as they take no more than
    ``broadcast_bytes`` together; each of these is one left join. The rules of all others meet
    the log in one sweep along the addresses, which shuffles the log once and copies no rule
    (:mod:`footfall.operators.sweep`, also for ``cuts``). A stream has no quantiles to cut it at:
    there both sides are shuffled on bucket and a salt taken from the record, class by class. In
    either way no single address can fill one task. ``sizes`` is what :func:`check_rules` found;
    without it the rules are checked here.
    """
    sizes = check_rules(rules) if sizes is None else sizes
    left, sent = broadcast_bytes, set()
    for bits in sorted(sizes, key=lambda b: sizes[b].bytes):
        left -= sizes[bits].bytes
        if left >= 0:
            sent.add(bits)
    split = logs.withColumn("_parts", ip_parts(ip))
    out = split.withColumn("_ip", parts_to_long("_parts")).drop("_parts")
    found: list[Column] = []
    if not logs.isStreaming and len(sent) < len(sizes):
        wide = [bits for bits in sizes if bits not in sent]
        rest = _with_bits(rules).where(F.col("_bits").isin(wide))
        rule = F.struct("end_num", F.struct(*REGION_COLUMNS).alias("region"))
        out = sweep_join(out, "_ip", rest, "start_num", rule, "_swept", cuts=cuts)
        covered = F.col("_ip") <= F.col("_swept.end_num")
        found.append(F.when(covered, F.col("_swept.region")))
        sizes = {bits: sizes[bits] for bits in sent}
    for bits in sorted(sizes):
        side = bucket_rules(rules, bits).select(
            F.col("_bucket").alias(f"_bucket{bits}"),
            F.col("start_num").alias(f"_start{bits}"),
            F.col("end_num").alias(f"_end{bits}"),
            F.col("_region").alias(f"_region{bits}"),
        )
        on = (
            (F.shiftright("_ip", bits) == F.col(f"_bucket{bits}"))
            & (F.col("_ip") >= F.col(f"_start{bits}"))
            & (F.col("_ip") <= F.col(f"_end{bits}"))
        )
        if bits in sent:
            out = out.join(F.broadcast(side), on, "left")
        else:
            out = _salted(out, side, on, bits)
        found.append(F.col(f"_region{bits}"))
    kept = [c for c in logs.columns if c not in REGION_COLUMNS]
    if not found:
        return logs.select(*kept, *[F.lit(UNKNOWN).alias(c) for c in REGION_COLUMNS])
    region = F.coalesce(*found)
    # An empty city of a rule stays empty; only a miss is unknown.
    return out.select(
        *kept,
        *[
            F.when(region.isNull(), UNKNOWN).otherwise(region[c]).alias(c)
            for c in REGION_COLUMNS
        ],
    )


def _salted(logs: DataFrame, side: DataFrame, on: Column, bits: int) -> DataFrame:
    spread = hashable(logs)
    salt, copy = f"_salt{bits}", f"_copy{bits}"
    left = logs.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    right = side.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, on & (F.col(salt) == F.col(copy)), "left")
