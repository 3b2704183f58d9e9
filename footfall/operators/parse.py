"""From raw lines to event records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from footfall.functions import (
    day_of,
    is_not_blank,
    java_split,
    parse_query_string,
    row_key,
)
from footfall.operators.geo import ip_region_join
from footfall.schemas import (
    EVENT_BROWSE_PRODUCT,
    KNOWN_CELLS,
    LOG_COLUMNS,
    REGION_COLUMNS,
)

# The first and last millisecond a date of four digits can hold.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A plain projection would be copied by the optimizer into every filter above it, and an
    expensive expression evaluated again for each use. The output of a generator is not. The value
    itself is made below the generator, where it is compiled even if it holds a lambda.
    """
    made = df.withColumn(f"{name}_made", value)
    return made.select(*df.columns, F.explode(F.array(f"{name}_made")).alias(name))


def _split_lines(lines: DataFrame, line: str) -> DataFrame:
    return once(lines, "_fields", java_split(line, "|"))


def _named_fields(split: DataFrame, line: str) -> DataFrame:
    """ip, access_time and request of lines with four fields, and their parameters."""
    others = [c for c in split.columns if c not in (line, "_fields")]
    named = split.select(
        *others,
        F.get("_fields", F.lit(0)).alias("ip"),
        F.get("_fields", F.lit(1)).alias("access_time"),
        F.get("_fields", F.lit(3)).alias("request"),
    )
    return once(named, "params", parse_query_string("request"))


IS_RECORD = "size(_fields) = 4"
# Holds the text of a line that is not stored.
REJECTED_LINE = "_line"


def parse_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Replace the line by ip, access_time, request and params; drop what is no record."""
    return _named_fields(_split_lines(lines, line).where(IS_RECORD), line)


# Why a line is not stored.
NO_RECORD, NO_USER, NO_EVENT, BAD_TIME = "no four fields", "no uid", "no event", "bad time"


def judge_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """All lines with their fields and parameters, and two marks: ``is_record`` where there
    are four fields, and ``reason``, which is null where the record can be stored."""
    split = _split_lines(lines, line).withColumn("is_record", F.expr(IS_RECORD))
    reason = F.when(~F.col("is_record"), NO_RECORD).otherwise(why_incomplete())
    return _named_fields(split, line).withColumn("reason", reason)


def rejected(lines: DataFrame, line: str = "value", judged: bool = False) -> DataFrame:
    """The lines that are not stored, each with its reason; batch or stream.

    With ``judged``, ``lines`` comes from :func:`enrich` with ``keep_rejected``, which has found
    them already.
    """
    if not judged:
        lines = judge_lines(lines.withColumn(REJECTED_LINE, F.col(line)), line)
    return lines.where("reason IS NOT NULL").select(F.col(REJECTED_LINE).alias(line), "reason")


def line_counts() -> list[Column]:
    """Aggregates over judged lines: read, no record, and record that cannot be stored."""
    return [
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(~F.col("is_record")).alias("n_filtered"),
        F.count_if(F.col("is_record") & F.col("reason").isNotNull()).alias("n_incomplete"),
    ]


def drop_unparsed(
    lines: DataFrame, counts: Observation | str, line: str = "value"
) -> DataFrame:
    """:func:`parse_log` and :func:`complete_records`, with counts of what each drops.

    With an Observation the counts are ready once an action has run; with a name, as on a
    stream, each batch reports them under it in the query's progress. A retried task does
    not count twice.
    """
    judged = judge_lines(lines, line).observe(counts, *line_counts())
    return judged.where("reason IS NULL").drop("is_record", "reason")


def effective(name: str, derived: Column | str | None = None) -> Column:
    """A cell of the record: the parameter of this name, else the derived value."""
    value = F.col("params")[name]
    return value if derived is None else F.coalesce(value, F.col(derived))


def why_incomplete() -> Column:
    """Why a record cannot be stored: it needs a uid, an event and a time in milliseconds
    that lies in the years 1 to 9999, which a date can hold. Null where it can."""
    ms = effective("access_time", "access_time").try_cast("bigint")
    return (
        F.when(effective("uid").isNull(), NO_USER)
        .when(effective("en").isNull(), NO_EVENT)
        .when(~F.coalesce(ms.between(FIRST_MS, LAST_MS), F.lit(False)), BAD_TIME)
    )


def is_complete() -> Column:
    return why_incomplete().isNull()


def complete_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_complete())


def merge_params(records: DataFrame) -> DataFrame:
    """Promote the named cells to columns.

    A parameter called ip, country and so on takes the place of the value derived from the
    line. Parameters outside the known names stay in ``params``.
    """
    derived = {"ip", "access_time", *REGION_COLUMNS} & set(records.columns)
    others = [
        c
        for c in records.columns
        if c not in (*KNOWN_CELLS, "params", "request", "access_time_ms", "dt")
    ]
    cells = [effective(c, c if c in derived else None).alias(c) for c in KNOWN_CELLS]
    # Most records have known names alone; only where there are others are the names filtered.
    known = sum((F.col("params")[c].isNotNull().cast("int") for c in KNOWN_CELLS), F.lit(0))
    others_of = F.map_filter("params", lambda k, _: ~k.isin(*KNOWN_CELLS))
    none = F.create_map().cast("map<string,string>")
    rest = F.when(F.size("params") == known, none).otherwise(others_of).alias("params")
    return (
        records.select(*others, *cells, rest)
        .withColumn("access_time_ms", F.col("access_time").try_cast("bigint"))
        .withColumn("dt", day_of("access_time_ms"))
    )


def _without_rejected(judged: DataFrame) -> DataFrame:
    """Keep the text of lines that are not stored, and nothing else of them."""
    good = F.col("reason").isNull()
    text = F.when(~good, F.col(REJECTED_LINE)).alias(REJECTED_LINE)
    cells = [F.when(good, F.col(c)).alias(c) for c in ("ip", "access_time", "request", "params")]
    others = [
        c
        for c in judged.columns
        if c not in (REJECTED_LINE, "is_record", "ip", "access_time", "request", "params")
    ]
    return judged.select(*others, text, *cells)


def enrich(
    lines: DataFrame,
    rules: DataFrame,
    counts: Observation | str | None = None,
    keep_rejected: bool = False,
) -> DataFrame:
    """Lines to event records with a region: the transform shared by batch and stream.

    Lines that are left out are counted by ``counts`` and listed by :func:`rejected`. With
    ``keep_rejected`` they stay between the records, as rows of their text and ``reason``, which
    is null for a record; so lines are judged once for both.
    """
    if keep_rejected:
        judged = judge_lines(lines.withColumn(REJECTED_LINE, F.col("value")))
        if counts is not None:
            judged = judged.observe(counts, *line_counts())
        records = _without_rejected(judged)
    elif counts is None:
        records = complete_records(parse_log(lines))
    else:
        records = drop_unparsed(lines, counts)
    return merge_params(ip_region_join(records, rules))


def with_row_key(records: DataFrame) -> DataFrame:
    return records.withColumn("row_key", row_key("access_time", "uid", "en"))


def project_event_log(records: DataFrame) -> DataFrame:
    """The eleven columns the reports read."""
    return records.select(*LOG_COLUMNS)


def filter_product_views(records: DataFrame) -> DataFrame:
    """Product views that name a product."""
    return records.where((F.col("en") == EVENT_BROWSE_PRODUCT) & is_not_blank("pid"))


def union_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several inputs with the same columns; batch or stream."""
    return reduce(DataFrame.unionByName, others, first)
