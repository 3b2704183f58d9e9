"""Secrets in every version of every file, by a ledger of scanned blobs.

A version is addressed by the SHA-256 of its text, its blob. The ledger holds, for each blob, the
rules it was scanned with and what they found. A scan reads the ledger, takes one version of each
blob that some rule has not seen in its present version, and searches it with those rules alone;
then the findings are joined back to all paths and versions that hold the blob. A new version of
one rule costs one search per blob, a new commit costs its new blobs.

Only DataFrame functions are used. Matches come with the pieces between them, so a position is a
running sum of lengths in code points.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall import storage
from footfall.llm.common import fresh, quoted, stored, text_or_empty


class Rule(NamedTuple):
    """``group`` of a match must have ``least`` code points; 0 is the whole match.

    ``pattern`` is searched from left to right without overlaps, and what fails is not tried
    again. It should be linear: one that can start anywhere in a long run must be bounded.
    Whoever changes a rule gives it a new ``version``.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(words: str) -> str:
    """The pattern with every ASCII letter in both cases, in any engine and nothing else."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Runs are taken whole, so a bound in the pattern of access and hex gives what a check would.
BASE_RULES = (
    Rule(
        "assign",
        1,
        rf"({_either_case('password|passwd|secret|token|api_?key')})"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
#: Published forms of tokens and keys.
ADDED_RULES = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----"),
)
RULES = BASE_RULES + ADDED_RULES

SPAN = "struct<rule:string,start:int,end:int>"
LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"
#: Copies of a finding that a blob's versions are dealt over when it is joined back.
SALTS = 16


def blob_of(text: Column | str) -> Column:
    """The address of a text; null counts as empty."""
    return F.sha2(text_or_empty(text), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``blob rules spans``, a row per blob and scan; no rows where there is no ledger yet."""
    if not any(name.startswith("scan=") for name in storage.children(spark, ledger)):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{ledger.rstrip('/')}/scan=*")


def compact_ledger(spark: SparkSession, ledger: str) -> None:
    """One folder with a row per blob in place of a folder per scan.

    If this stops between writing and removing, some rows are there twice, which readers bear.
    No scan may run beside it.
    """
    ledger = ledger.rstrip("/")
    old = [name for name in storage.children(spark, ledger) if name.startswith("scan=")]
    merged = read_ledger(spark, ledger).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    staging = f"{ledger}/compacting"
    storage.remove(spark, staging)
    merged.write.parquet(staging)
    storage.move(spark, staging, f"{ledger}/scan={uuid.uuid4().hex}")
    for name in old:
        storage.remove(spark, f"{ledger}/{name}")


def unseen_pairs(blobs: DataFrame, known: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blobs`` (blob, ...) with ``missing``: the keys of the rules that have not seen a blob."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = known.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen")
    )
    missing = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
    return (
        blobs.join(seen, "blob", "left")
        .withColumn("missing", missing)
        .drop("seen")
        .filter(F.size("missing") > 0)
    )


def find_spans(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob spans`` for the blobs of ``texts`` (blob, missing, text) in which something is.

    A text that comes twice under one blob gives its spans once.
    """
    text = F.col("text")
    hits = [
        F.when(
            F.array_contains("missing", r.key) & text.rlike(r.pattern),
            F.struct(
                F.lit(r.key).alias("rule"),
                F.lit(r.least).alias("least"),
                F.arrays_zip(
                    F.split(text, r.pattern, -1).alias("piece"),
                    F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)).alias("match"),
                    F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)).alias("value"),
                ).alias("parts"),
            ),
        )
        for r in rules
    ]
    # The row number tells copies apart within this plan; it is never compared with another.
    rows = texts.select("blob", F.explode(F.array(*hits)).alias("hit")).filter("hit IS NOT NULL")
    parts = (
        rows.withColumn("copy", F.monotonically_increasing_id())
        .select(
            "blob", "copy", "hit.rule", "hit.least", F.posexplode("hit.parts").alias("at", "part")
        )
        .filter("part.match IS NOT NULL")
    )
    so_far = (
        Window.partitionBy("blob", "copy")
        .orderBy("at")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    length = F.char_length("part.match")
    ended = parts.withColumn("end", F.sum(F.char_length("part.piece") + length).over(so_far))
    spans = ended.filter(F.char_length("part.value") >= F.col("least")).select(
        "blob",
        F.struct(
            "rule",
            (F.col("end") - length).cast("int").alias("start"),
            F.col("end").cast("int").alias("end"),
        ).alias("span"),
    )
    return spans.groupBy("blob").agg(F.collect_set("span").alias("spans"))


def scan_secrets(
    versions: DataFrame,
    ledger: str,
    path_col: str = "path",
    version_col: str = "version",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Every row of ``versions``, its text left out, with ``blob`` and ``spans``.

    ``spans`` holds (kind, start, end) in code points, end exclusive, by start, then by the order
    of ``rules``, then by end; kinds are searched one by one, so spans of two kinds may overlap.
    ``ledger`` is a folder on shared storage; it is created, read and appended to. A row of it is
    complete in itself, so a scan that dies loses work but leaves nothing wrong, and one that
    runs again scans only what is missing.

    A null text counts as empty and has no spans. Null paths and versions, and repeated ones, are
    rows like any other. An empty table gives no rows. Own columns ``blob`` and ``spans`` are
    replaced. A text is searched whole, in one task, whatever its length; the search is linear in
    it and holds a few copies of it.
    """
    spark = versions.sparkSession
    versions = versions.drop(*[c for c in versions.columns if c.lower() in ("blob", "spans")])
    place = F.struct(
        F.col(quoted(path_col)).alias("path"), F.col(quoted(version_col)).alias("version")
    )
    blob = blob_of(quoted(text_col))
    others = [quoted(c) for c in versions.columns if c != text_col]
    at = fresh(versions, "place")
    history = stored(versions.select(*others, place.alias(at), blob.alias("blob")), "history")
    known = read_ledger(spark, ledger)
    blobs = history.groupBy("blob").agg(F.min(at).alias("at"))
    todo = stored(unseen_pairs(blobs, known, rules), "unseen-blobs")
    # A blob with very many versions is looked for at one of them, so its copies are not drawn
    # together: the join goes by blob and place.
    texts = versions.select(
        blob.alias("blob"), place.alias("at"), text_or_empty(quoted(text_col)).alias("text")
    ).join(todo, ["blob", "at"])
    found = find_spans(texts, rules)
    none = F.array().cast(f"array<{SPAN}>")
    todo.join(found, "blob", "left").select(
        "blob", F.col("missing").alias("rules"), F.coalesce("spans", none).alias("spans")
    ).write.parquet(f"{ledger.rstrip('/')}/scan={uuid.uuid4().hex}")
    return _joined_back(history, read_ledger(spark, ledger), at, rules)


def _joined_back(
    history: DataFrame, known: DataFrame, at: str, rules: Sequence[Rule]
) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.kind)])
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    salt = fresh(history, "salt")
    wanted = F.filter("spans", lambda s: s["rule"].isin(*[r.key for r in rules]))
    ordered = F.transform(
        wanted,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.element_at(rank, s["rule"]).alias("rank"),
            s["end"].alias("end"),
            F.element_at(kind, s["rule"]).alias("kind"),
        ),
    )
    hits = known.filter(F.size("spans") > 0).select("blob", ordered.alias("spans"))
    spans = F.transform(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))),
        lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end")]),
    )
    found = (
        hits.groupBy("blob")
        .agg(spans.alias("spans"))
        .withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    dealt = history.withColumn(salt, F.pmod(F.xxhash64(at), F.lit(SALTS)).cast("int"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return dealt.join(found, ["blob", salt], "left").select(
        *[quoted(c) for c in history.columns if c not in (at, "blob")],
        "blob",
        F.coalesce("spans", none).alias("spans"),
    )
