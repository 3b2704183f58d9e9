"""Sharding by a hierarchical weighted hash tree.

A key descends from the root through region and rack to a shard. On each level every child draws
``ln(u) / weight`` with ``u`` from a hash of key and child, and the largest draw wins, so a child
gets keys in proportion to its weight. A draw depends on that child alone: when a weight grows,
keys move only into its subtree; when it shrinks, only out of it. Weights of inner nodes are the
sums of their shards.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import fresh, quoted, running_total, stored

#: region -> rack -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

#: Rows that are numbered in one sort, on average.
BUCKET_ROWS = 2_000


def even_tree(shards: int, racks: int = 2, per_rack: int = 2) -> dict:
    """Shards of weight 1, filled rack by rack; a shard beyond full regions opens a new one.

    From n to n + 1 shards only subtrees that hold the new shard change. Where n fills its
    regions, the new region takes keys into the new shard alone; in a region that was begun
    before, keys may also land on that region's other shards.
    """
    tree: dict = {}
    for shard in range(shards):
        region = shard // (racks * per_rack)
        rack = tree.setdefault(f"region{region}", {}).setdefault(f"rack{shard // per_rack}", {})
        rack[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> dict:
    """The tree with one more shard in a region of its own, which takes keys only into itself."""
    shards = [s for racks in tree.values() for rack in racks.values() for s in rack]
    new = max(shards, default=-1) + 1
    return {**tree, f"region-of-{new}": {f"rack-of-{new}": {new: weight}}}


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
    u = (bits.cast("double") + 0.5) * F.lit(2.0**-53)
    return F.log(u) / F.lit(float(weight))


def _pick(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the largest draw; equal draws go to the later child."""
    if len(children) == 1:
        return children[0][2]
    draws = [
        F.struct(_draw(key, name, weight).alias("draw"), F.lit(i).alias("child"))
        for i, (name, weight, _) in enumerate(children)
    ]
    winner = F.greatest(*draws).getField("child")
    return reduce(
        lambda rest, i: F.when(winner == i, children[i][2]).otherwise(rest),
        range(len(children) - 1),
        children[-1][2],
    )


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key. A null key is a key like any other. Weights must be above zero."""
    regions = []
    for region, racks in tree.items():
        inner = []
        for rack, shards in racks.items():
            if any(weight <= 0 for weight in shards.values()):
                raise ValueError("weights must be above zero")
            leaves = [(f"shard{s}", w, F.lit(s)) for s, w in shards.items()]
            inner.append((rack, sum(shards.values()), _pick(key, leaves)))
        regions.append((region, sum(w for _, w, _ in inner), _pick(key, inner)))
    if not regions:
        raise ValueError("the tree has no shard")
    return _pick(key, regions)


def put_in_shards(
    docs: DataFrame,
    tree: Tree,
    next_tree: Tree | None = None,
    id_col: str = "doc_id",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Every row of ``docs`` with ``shard``, ``slot`` and, for ``next_tree``, ``grown_shard``.

    The id and the tree alone decide the shard, so rows that repeat an id (or have none) share
    one. Slots number the rows of a shard from 0 without gaps, in no order that means anything.
    A shard is numbered in many tasks, however full it is. Without rows there are no shards.
    Own columns of these three names are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "slot", "grown_shard")])
    row, one, bucket = (fresh(docs, name) for name in ("row_number", "one_row", "row_bucket"))
    key = F.col(quoted(id_col))
    later = shard_of(key, next_tree) if next_tree else F.lit(None)
    rows = stored(
        docs.select(
            "*",
            shard_of(key, tree).cast("int").alias("shard"),
            later.cast("int").alias("grown_shard"),
            F.monotonically_increasing_id().alias(row),
            F.lit(1).alias(one),
        ),
        "sharded",
    )
    buckets = max(1, rows.count() // bucket_rows)
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(row), F.lit(buckets)))
    placed = running_total(rows, ["shard"], [row], one, bucket, "slot")
    return placed.select(*[quoted(c) for c in docs.columns], "shard", "slot", "grown_shard")
