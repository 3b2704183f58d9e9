"""Mixing sources by temperature.

Source shares of tokens are raised to an exponent between 0 (all sources alike) and 1 (as they
are). The exponent is found by bisection so that the mix meets a target: no document is repeated
more than so often, or the entropy of the weights reaches so much of its maximum. The weights
become token budgets. A budget is spent on permutations of its source, one per epoch, the last
one cut where the budget ends; and the sequence of each source is dealt over blocks in equal
parts, so that every block holds the mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import (
    WORD,
    fresh,
    identified,
    quoted,
    running_total,
    stored,
    text_or_empty,
)

#: The exponent is a multiple of 2 ** -(BITS * ROUNDS).
BITS, ROUNDS = 7, 3
BLOCK_TOKENS = 1 << 18
BUCKET_ROWS = 2_000


def word_tokens(text: Column | str = "text") -> Column:
    """Words of the text, and one for its end; so every document weighs at least one."""
    return (F.regexp_count(text_or_empty(text), F.lit(WORD)) + 1).cast("long")


def mix_exponent(
    totals: DataFrame, max_repeats: float | None = None, min_entropy: float | None = None
) -> float:
    """The exponent for ``totals`` (source, tokens > 0).

    With ``max_repeats`` r: the smallest exponent with which no source is passed over more than
    r times as often as another. With ``min_entropy`` h: the largest one with which the entropy
    of the weights is at least h times the logarithm of the number of sources; 0 if none is.
    Both measures are monotone, so each round evaluates 2 ** BITS - 1 inner points in one
    aggregation, which stands for BITS steps of bisection. The driver gets one row per point.
    """
    if (max_repeats is None) == (min_entropy is None):
        raise ValueError("give one target: max_repeats or min_entropy")
    total, sources = totals.agg(F.sum("tokens"), F.count("*")).first()
    if not sources:
        return 1.0
    shares = totals.select((F.col("tokens") / F.lit(total)).alias("p"))
    low, high = 0, 1 << (BITS * ROUNDS)  # the answer lies in low..high
    unit = 1.0 / high

    def fine(row) -> bool:
        if max_repeats is not None:
            return row.most <= max_repeats * row.least
        entropy = math.log(row.z) - row.power * row.zlog / row.z
        return entropy >= min_entropy * math.log(sources) - 1e-12

    for round_ in range(ROUNDS):
        step = 1 << (BITS * (ROUNDS - 1 - round_))
        points = range(low, high + 1, step)
        raised = shares.select(
            "p", F.explode(F.array(*[F.lit(k * unit) for k in points])).alias("power")
        )
        value = F.pow("p", "power")
        rows = (
            raised.groupBy("power")
            .agg(
                F.sum(value).alias("z"),
                F.sum(value * F.log("p")).alias("zlog"),
                F.max(value / F.col("p")).alias("most"),
                F.min(value / F.col("p")).alias("least"),
            )
            .collect()
        )
        ok = {round(row.power / unit) for row in rows if fine(row)}
        if max_repeats is not None:
            high = min(ok, default=high)
            low = max(low, high - step)
        else:
            low = max(ok, default=low)
            high = min(high, low + step)
    return (high if max_repeats is not None else low) * unit


def budgets(totals: DataFrame, exponent: float, total_tokens: int | None = None) -> DataFrame:
    """``totals`` (source, tokens, docs) with ``weight budget passes rest``.

    A budget is the weight's part of ``total_tokens``; without that number, of the smallest
    total with which every document appears at least once. It is spent on ``passes`` whole
    passes over the source and ``rest`` tokens of one more.
    """
    total = totals.agg(F.sum("tokens")).first()[0]
    raised = totals.withColumn("weight", F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))
    z = raised.agg(F.sum("weight")).first()[0]
    weighted = raised.withColumn("weight", F.col("weight") / F.lit(z))
    if total_tokens is None:
        whole = weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
        budget = F.greatest("tokens", F.floor(F.col("weight") * F.lit(whole)))
    else:
        budget = F.floor(F.col("weight") * F.lit(float(total_tokens)))
    return weighted.withColumn("budget", budget).selectExpr(
        "*", "budget div tokens AS passes", "budget % tokens AS rest"
    )


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_repeats: float | None = None,
    min_entropy: float | None = None,
    total_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
    bucket_rows: int = BUCKET_ROWS,
    row_col: str | None = None,
) -> DataFrame:
    """The mix as draws ``row id source tokens epoch block slot weight budget``, one per use.

    ``row`` is the document's ``row_col``, or what ``identified`` names it. A document appears once
    per epoch at most; in which order, the MD5 of seed, epoch and id says, so rows that repeat
    an id (or have none) are neighbours, lighter ones first. ``slot`` orders a block by the same
    value. A null source is a source of its own; an empty or null text weighs one token; the
    document that crosses the end of a budget still belongs to it. An empty table gives no
    draws. ``total_tokens`` below the tokens of a source's budget leaves documents out: that is
    what a budget is for; without it every document is drawn at least once.
    """
    if row_col is None:
        row_col = fresh(docs, "row_name")
        docs = identified(docs, row_col)
    rows = stored(
        docs.select(
            F.col(row_col).alias("row"),
            F.col(quoted(id_col)).alias("id"),
            F.struct(F.col(quoted(source_col)).alias("name")).alias("source"),
            word_tokens(quoted(text_col)).alias("tokens"),
        ),
        "mix-rows",
    )
    totals = stored(
        rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")),
        "mix-totals",
    )
    if totals.isEmpty():
        plan = totals.selectExpr("*", "0D AS weight", "0L AS budget", "0L AS passes", "0L AS rest")
        blocks = 1
    else:
        plan = stored(
            budgets(totals, mix_exponent(totals, max_repeats, min_entropy), total_tokens),
            "mix-budgets",
        )
        blocks = max(1, math.ceil(plan.agg(F.sum("budget")).first()[0] / block_tokens))
    plan = plan.select(
        "source",
        F.col("tokens").alias("source_tokens"),
        F.greatest(F.lit(1), F.expr(f"docs div {bucket_rows}")).alias("buckets"),
        "weight",
        "budget",
        "passes",
        "rest",
        F.greatest(F.lit(1), F.ceil(F.col("budget") / F.lit(blocks))).alias("per_block"),
    )
    last = F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)
    draws = rows.join(plan, "source").withColumn(
        "epoch", F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)))
    )
    own_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    name = F.concat_ws(":", F.lit(str(seed)), F.col("epoch"), own_id)
    draws = draws.withColumn("key", F.md5(name))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("buckets")
    draws = draws.withColumn("bucket", F.shiftright(part, 32))
    placed = running_total(
        draws, ["source", "epoch"], ["key", "id", "tokens"], "tokens", "bucket", "start"
    )
    placed = placed.filter((F.col("epoch") < F.col("passes")) | (F.col("start") < F.col("rest")))
    at = "(epoch * source_tokens + start) div per_block"
    placed = placed.withColumn("block", F.expr(at))
    order = Window.partitionBy("block").orderBy("key", "source", "id", "tokens")
    return placed.withColumn("slot", (F.row_number().over(order) - 1).cast("long")).select(
        "row", "id", F.col("source.name").alias("source"), "tokens", "epoch", "block", "slot",
        "weight", "budget",
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mix, each as often as it is drawn."""
    row, block, slot = (fresh(docs, name) for name in ("row_name", "mix_block", "mix_slot"))
    docs = identified(docs, row)
    draws = mix(docs, row_col=row, **options).select(
        F.col("row").alias(row), F.col("block").alias(block), F.col("slot").alias(slot)
    )
    drawn = docs.join(draws, row)
    return drawn.repartitionByRange(block).sortWithinPartitions(block, slot).drop(row, block, slot)
