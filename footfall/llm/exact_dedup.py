"""Exact deduplication by skew-safe combining.

Copies are combined three times: inside each task, inside each salted digest group, and over the
salts. Every step groups by digest *and* full normalised text, so two texts that share a digest
never merge; a weak digest costs time, not correctness.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import BLANKS, fresh, identified, quoted, stored, text_or_empty

SALTS = 16


def normalised(text: Column | str) -> Column:
    """Null becomes empty, and each run of white space becomes one space."""
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_groups(
    docs: DataFrame,
    row_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per different normalised text: ``digest text first group_size``.

    ``row_col`` names each row. ``first`` is the struct (id missing?, id, row) of the row that
    stays: the smallest id, ids that are null last, and among repeated ids the row of the smallest
    name. The salt comes from the task, so the copies of one text that survive the tasks (one per
    task) spread over ``salts`` tasks before the last step combines ``salts`` rows.
    """
    text = normalised(text_col)
    rows = docs.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(row_col).alias("row"),
        text.alias("text"),
    ).select(
        digest(F.col("text")).alias("digest"),
        F.spark_partition_id().alias("part"),
        "text",
        F.struct(F.col("id").isNull().alias("missing"), "id", "row").alias("first"),
    )
    # Within a task all rows carry the same salt, so the partial aggregate below leaves one
    # row per text and task before anything is shuffled.
    merged = rows.groupBy(
        "digest", F.pmod(F.xxhash64("part"), F.lit(salts)).alias("salt"), "text"
    ).agg(F.min("first").alias("first"), F.count("*").alias("n"))
    return (
        merged.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id group_size kept text_digest`` after its own columns.

    Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became one
    space; null counts as empty. Of equal texts exactly one row is kept: the one with the
    smallest id; a null id comes last; of repeated rows with that id always the same one. So
    ``keep_id`` is null only where every id of a group is null. An empty table gives no rows.
    Own columns of the names above are replaced.

    The rows find their group by digest alone where the last combining step saw one text under
    that digest; where digests collide, the full text is compared again.
    """
    added = {"keep_id", "group_size", "kept", "text_digest"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    text = fresh(docs, "normal_text")
    row = fresh(docs, "row_name")
    rows = identified(docs, row)
    groups = _groups(rows, row, id_col, text_col, digest, salts)
    rows = rows.withColumn(text, normalised(text_col))
    rows = rows.withColumn("text_digest", digest(F.col(text)))
    by_digest = F.col("doc.text_digest") == F.col("group.digest")
    parts = [(groups.filter("text IS NULL"), by_digest)]
    if not groups.filter("text IS NOT NULL").isEmpty():
        known = groups.filter("text IS NOT NULL")
        parts.append((known, by_digest & (F.col(f"doc.{text}") == F.col("group.text"))))
    found = [
        rows.alias("doc")
        .join(part.alias("group"), condition)
        .select(
            *[F.col(f"doc.{quoted(c)}") for c in docs.columns],
            F.col("group.first.id").alias("keep_id"),
            F.col("group.group_size"),
            (F.col(f"doc.{row}") == F.col("group.first.row")).alias("kept"),
            F.col("doc.text_digest"),
        )
        for part, condition in parts
    ]
    return found[0] if len(found) == 1 else found[0].union(found[1])


def kept_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """The rows ``exact_dedup`` keeps, with their own columns only."""
    row = fresh(docs, "row_name")
    rows = identified(docs, row)
    groups = _groups(rows, row, id_col, text_col, digest, salts)
    first = groups.select(F.col("first.row").alias(row))
    return rows.join(first, row, "left_semi").drop(row)


def _groups(docs, row_col, id_col, text_col, digest, salts) -> DataFrame:
    """The stored groups; ``text`` only where other texts share the digest."""
    groups = text_groups(docs, row_col, id_col, text_col, digest, salts)
    texts = F.count("*").over(Window.partitionBy("digest"))
    return stored(
        groups.withColumn("texts", texts).select(
            "digest", "first", "group_size", F.when(F.col("texts") > 1, F.col("text")).alias("text")
        ),
        "text-groups",
    )
