from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col
from footfall.functions.text import java_split


def _shifted_in(number: Column, part: Column) -> Column:
    return F.shiftleft(number, 8).bitwiseOR(part.try_cast("bigint"))


def ip_parts(ip: Column | str) -> Column:
    """The parts of a dotted address."""
    return java_split(col(ip), ".")


def parts_to_long(parts: Column | str) -> Column:
    """The number of an address from its parts; a column of its own, as it is named often."""
    number = F.lit(0).cast("bigint")
    # The usual four parts need no loop.
    usual = reduce(_shifted_in, [F.get(col(parts), F.lit(i)) for i in range(4)], number)
    looped = F.aggregate(col(parts), number, _shifted_in)
    return F.when(F.size(col(parts)) == 4, usual).otherwise(looped)


def ip_to_long(ip: Column | str) -> Column:
    """The number of a dotted address; null where any part is not a number.

    Parts are not checked against 255, and there may be more or fewer than four: each one
    shifts the number by eight bits, so eight parts fill it and earlier ones fall out.
    """
    return F.aggregate(ip_parts(ip), F.lit(0).cast("bigint"), _shifted_in)
