"""A training corpus from raw documents: five stages, each a table written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), with ``docs`` what its
predecessor kept, and all but the last return the columns of ``documents``. Rows of ``docs`` must
come in the same order each time they are read, which the written tables ensure. Every stage
gives an empty table for an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, exact_dedup, langid, minhash, mixing
from footfall.llm.common import fresh, importable, table
from footfall.session import work_dir

#: The pipeline trains, samples and searches; no SQL gives its rows.
ORACLE_SQL = None

#: A document stays if its language is known at least this surely.
MIN_LANGUAGE_SCORE = 0.5
#: No source is passed over more than so many times as often as another.
MAX_REPEATS = 2
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those of no language the labels teach."""
    known = docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out())
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = langid.predict(docs, langid.train(known), pred_col=pred, score_col=score)
    sure = (F.col(pred) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return found.filter(sure).drop(pred, score)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.kept_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five words, similarity 0.8."""
    return minhash.kept_rows(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats small sources up to the limit and deals all over blocks; no document is lost."""
    return mixing.mixed_rows(docs, max_repeats=MAX_REPEATS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text; ``round_trip`` tells whether decoding gives the text again."""
    own = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    return bpe.encode(own, RANKS, decoded=True).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("text").cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, "pipeline-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
