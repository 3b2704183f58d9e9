from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


# What a ``?`` may stand in without being a mark: comments and quoted text or names.
SKIPPED = re.compile(
    r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`|[?]", re.DOTALL
)


def _literal(value: object) -> str:
    """A literal that means the same in every database, or an error.

    Whether a backslash escapes depends on the database and its settings, so text with one
    is refused, as are control characters and numbers that are not finite.
    """
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        if not math.isfinite(value):
            raise ValueError(f"no literal for {value}")
        return repr(value)
    text = str(value)
    if "\\" in text or any(ord(c) < 32 for c in text):
        raise ValueError("a text parameter holds a backslash or a control character")
    return "'" + text.replace("'", "''") + "'"


def bind(query: str, params: Sequence[object]) -> str:
    """Put literals in place of the ``?`` marks outside comments, quotes and quoted names."""
    values = iter(params)

    def put(found: re.Match) -> str:
        if found[0] != "?":
            return found[0]
        try:
            return _literal(next(values))
        except StopIteration:
            raise ValueError("more marks than parameters") from None

    text = SKIPPED.sub(put, query)
    if any(True for _ in values):
        raise ValueError("more parameters than marks")
    return text


def jdbc_options(
    url: str,
    query: str,
    params: Sequence[object] = (),
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetch_size: int = 10_000,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read. A large result needs a partition column: without one,
    a single task fetches it."""
    text = bind(query, params)
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column:
        options |= {
            "dbtable": f"({text}) q",
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    else:
        options["query"] = text
    optional = {"user": user, "password": password, "driver": driver}
    return options | {k: v for k, v in optional.items() if v is not None}


def read_jdbc(
    spark: SparkSession, url: str, query: str, params: Sequence[object] = (), **settings
) -> DataFrame:
    """The rows of a query with ``?`` marks; see :func:`jdbc_options` for settings."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, params, **settings)).load()
