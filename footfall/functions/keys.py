from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col

INT_MIN = -(2**31)


def java_string_hash(c: Column | str) -> Column:
    """The 32-bit hash the JVM gives a string, over UTF-16 units; 0 for null."""
    return F.java_method(
        F.lit("java.util.Objects"), F.lit("hashCode"), col(c).cast("string")
    ).cast("int")


def row_key(access_time: Column | str, uid: Column | str, event: Column | str) -> Column:
    """``<access time>_<absolute hash of uid and event>``.

    The smallest 32-bit integer has no positive counterpart and keeps its sign.
    """
    code = java_string_hash(F.concat(col(uid), col(event))).cast("string")
    # Named once, so that it is computed once.
    positive = F.regexp_replace(code, f"^-(?!{-INT_MIN}$)", "")
    return F.concat(col(access_time).cast("string"), F.lit("_"), positive)
