"""Near duplicates by one-permutation hashing with optimal densification.

A text is the set of its word shingles, as 64-bit fingerprints. One hash of each shingle picks a
bin and the smallest value of a bin is its sketch; an empty bin borrows from a full one, which it
finds by a hash of bin and attempt, so that sketches of alike sets agree in borrowed bins too.
Bands of bins are the buckets. In a bucket, every member is compared with one hub on the full
sets, which gives a number of pairs like the number of members; only members that the hubs leave
in different components are compared with each other, and of these only where the distances to
the hub allow a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import fresh, identified, quoted, stored
from footfall.llm.graph import components

SHINGLE_WORDS = 5
PERCENT = 80
#: A pair of similarity 0.8 shares none of its bands with probability
#: (1 - 0.8 ** ROWS) ** BANDS = 1.2e-8; one of similarity 0.3 shares one with 0.04.
BANDS, ROWS = 60, 6
#: Star rounds before what is left is settled exactly.
STAR_ROUNDS = 2
#: Nodes from which a component is compared as a whole, and shingles of a block of it.
LARGE, BLOCK_SHINGLES = 16, 1 << 18
#: Members of small components from which a bucket is compared in blocks.
CROWDED = 32
#: Bytes of text that are hashed at a time.
SLICE_BYTES = 1 << 19

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers without visible pattern (the finisher of SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(n, dtype=np.uint64) + (np.uint64(seed) << np.uint64(40)))


def shingle_sets(texts: list[bytes], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct fingerprints of each text's shingles.

    Words are runs of other bytes than white space, with A-Z in lower case. A text of fewer
    words has one shingle, the whole sequence; one without words has none. A word's hash sums
    its bytes times a random number per place, so it does not depend on where the word stands.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    blank = _BLANK[data]
    inside = np.flatnonzero(~blank)
    if not len(inside):
        return [np.empty(0, np.uint64) for _ in texts]
    first = np.empty(len(inside), dtype=bool)
    first[0] = True
    np.not_equal(np.diff(inside), 1, out=first[1:])
    starts = np.flatnonzero(first)  # in `inside`
    sizes = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, sizes)
    weights = _numbers(int(sizes.max()), 1) | np.uint64(1)
    word = mixed(
        np.add.reduceat(_LOWER[data[inside]] * weights[place], starts)
        + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    )
    # The text that a word belongs to: texts are separated by one blank each.
    bounds = np.searchsorted(inside[starts], np.cumsum(lengths + 1))
    found = []
    factors = _numbers(words, 2) | np.uint64(1)
    begin = 0
    for end in bounds:
        own = word[begin:end]
        begin = end
        if not len(own):
            found.append(np.empty(0, np.uint64))
            continue
        width = min(words, len(own))
        total = own[: len(own) - width + 1] * factors[0]
        for i in range(1, width):
            total = total + own[i : len(own) - width + 1 + i] * factors[i]
        found.append(np.unique(mixed(total + np.uint64(width))))
    return found


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values per set; sets must not be empty.

    The sets are sorted, and a value's bin is its share of the 64-bit range, so the first value
    of a bin is its smallest.
    """
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    bin_ = (((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    cell = row * bins + bin_
    first = np.append(True, cell[1:] != cell[:-1]) if len(cell) else np.empty(0, bool)
    out = np.zeros(len(sets) * bins, dtype=np.uint64)
    full = np.zeros(len(sets) * bins, dtype=bool)
    # Mixed once more, so that a borrowed value says nothing about the bin it comes from.
    out[cell[first]] = mixed(values[first])
    full[cell[first]] = True
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        at = empty % bins
        draw = mixed(at.astype(np.uint64) + np.uint64(attempt << 32))
        target = empty - at + (draw % np.uint64(bins)).astype(np.int64)
        hit = full[target]
        out[empty[hit]] = out[target[hit]]
        empty = empty[~hit]
    return out.reshape(len(sets), bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per row and band; keys of different bands differ."""
    factors = _numbers(rows, 3) | np.uint64(1)
    cells = sketch.reshape(len(sketch), bands, rows)
    return mixed((cells * factors).sum(axis=2, dtype=np.uint64) + _numbers(bands, 4))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    start, size = 0, 0
    texts: list[bytes] = []
    for i, value in enumerate(batch.column(column).cast(pa.large_binary()).to_pylist()):
        texts.append(value or b"")
        size += len(texts[-1])
        if size >= SLICE_BYTES:
            yield batch.slice(start, i + 1 - start), texts
            start, size, texts = i + 1, 0, []
    if texts:
        yield batch.slice(start), texts


def features(rows: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """``row first n set_key bands`` for ``rows`` (row, first, text)."""
    schema = T.StructType(
        [
            rows.schema["row"],
            rows.schema["first"],
            T.StructField("n", T.LongType(), False),
            T.StructField("set_key", T.BinaryType(), True),
            T.StructField("bands", T.ArrayType(T.LongType(), False), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in _slices(whole, 2):
                sets = shingle_sets(texts, words)
                some = [s for s in sets if len(s)]
                keys = band_keys(sketches(some, bands * band_rows), bands, band_rows)
                counts = np.array([bands if len(s) else 0 for s in sets])
                ends = np.append(0, np.cumsum(counts)).astype(np.int32)
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))
                        ),
                    ],
                    names=["row", "first", "n", "set_key", "bands"],
                )

    return rows.mapInArrow(run, schema)


def full_sets(rows: DataFrame, words: int) -> DataFrame:
    """``node shingles`` (sorted array of long) for ``rows`` (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in _slices(whole, 1):
                sets = shingle_sets(texts, words)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["node", "shingles"],
                )

    return rows.mapInArrow(run, "node long, shingles array<long>")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a b common all`` for ``pairs`` (a, b): sizes of intersection and union of the full sets."""
    left = pairs.join(sets.selectExpr("node AS a", "shingles AS x"), "a")
    both = left.join(sets.selectExpr("node AS b", "shingles AS y"), "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    counted = both.select(
        "a", "b", common.alias("common"), (F.size("x") + F.size("y")).cast("long").alias("sum")
    )
    return counted.selectExpr("a", "b", "common", "sum - common AS all")


def _fresh_pairs(pairs: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Distinct unordered pairs that are not among those compared before."""
    ordered = pairs.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    return ordered if seen is None else ordered.join(seen, ["a", "b"], "left_anti")


def linked_nodes(
    members: DataFrame, sets: DataFrame, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS
) -> DataFrame:
    """``node label`` of the components of all links between ``members`` (bucket, node, n).

    A link is a pair of one bucket with at least ``percent`` hundredths of its union in common.
    In each star round every bucket that still spans several components picks a hub, and the
    members outside the hub's component are compared with it. Exact steps settle what is left:
    a node that meets a large component in a bucket is compared with all of it, block by block,
    where only links leave the task; so are the members of small components in a crowded
    bucket; in other buckets they are compared pair by pair, but for pairs that cannot be
    links: those whose sizes differ too much, and those whose distances to the bucket's first
    hub differ by more than the distance of a link (the Jaccard distance obeys the triangle
    inequality). So no link of a bucket is lost, whatever the hubs.
    """
    live = members.withColumn("label", F.col("node"))
    seen = first_hubs = labels = None
    for turn in range(star_rounds):
        # The first hub is the smallest node, which most buckets of a group share.
        order = F.xxhash64(F.lit(turn), "node") if turn else F.col("node")
        hubs = live.groupBy("bucket").agg(
            F.min(F.struct(order.alias("order"), "node", "label")).alias("hub")
        )
        hubs = hubs.selectExpr("bucket", "hub.node AS hub", "hub.label AS hub_label")
        if turn == 0:
            first_hubs = stored(hubs.select("bucket", "hub"), "hubs")
        pairs = live.join(hubs, "bucket").filter("label <> hub_label")
        found = stored(
            compared(_fresh_pairs(pairs.selectExpr("node AS a", "hub AS b"), seen), sets),
            "compared",
        )
        seen = found if seen is None else seen.union(found)
        labels = components(_links(seen, percent))
        live = _live(members, labels)
        if live.isEmpty():
            return labels
    large = stored(
        labels.groupBy("label").agg(F.count("*").alias("size")).filter(f"size >= {LARGE}"), "large"
    )
    live = live.join(large, "label", "left")
    across = _across(live, labels, large, sets, percent)
    small = live.filter("size IS NULL").select("bucket", "node", "n", "label")
    counts = small.groupBy("bucket").agg(F.count("*").alias("members"))
    small = stored(small.join(counts, "bucket"), "small")
    within = _within(small.filter(f"members >= {CROWDED}"), sets, percent)
    rest = compared(_fresh_pairs(_rest(small, first_hubs, seen, percent), seen), sets)
    links = _links(seen, percent).union(_links(rest, percent)).union(across).union(within)
    return components(links)


def _links(compared_pairs: DataFrame, percent: int) -> DataFrame:
    return compared_pairs.filter(f"100 * common >= {percent} * all").select("a", "b")


def _across(
    live: DataFrame, labels: DataFrame, large: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) between large components and the nodes that meet them in a bucket.

    Of two large components the smaller one's nodes are compared with the larger one.
    """
    met = live.filter("size IS NOT NULL").selectExpr("bucket", "label AS other", "size AS weight")
    asking = (
        live.join(met.distinct(), "bucket")
        .filter("label <> other AND (size IS NULL OR (size, label) < (weight, other))")
        .selectExpr("node", "n", "other AS label")
        .distinct()
    )
    held = labels.join(large, "label").join(
        sets.select("node", F.size("shingles").alias("n")), "node"
    )
    return _block_links(held, stored(asking, "asking"), sets, percent)


def _within(crowded: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside buckets, for their members (bucket, node, n)."""
    own = crowded.selectExpr("node", "n", "bucket AS label")
    return _block_links(own, own, sets, percent).filter("a <> b")


def _block_links(
    held: DataFrame, asking: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links between the nodes of ``held`` and ``asking`` (node, n, label) of equal label.

    Both sides are dealt to blocks of about ``BLOCK_SHINGLES``, so a label of any size is many
    tasks, and only links leave them.
    """

    def blocks(frame, name):
        total = F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int")
        return frame.groupBy("label").agg(F.greatest(F.lit(1), total).alias(name))

    parts = stored(
        blocks(asking, "q_parts").join(blocks(held, "v_parts"), "label"), "component-blocks"
    )

    def dealt(frame, own, other):
        mine = F.pmod(F.xxhash64("node"), F.col(f"{own}_parts")).cast("int")
        return (
            frame.select("node", "label")
            .join(parts, "label")
            .withColumn(own, mine)
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
            .select("node", "label", own, other)
            .join(sets, "node")
            # Names of their own, as both sides may come from one frame.
            .select(
                F.col("label").alias(f"{own}_label"),
                F.col("v").alias(f"{own}_v"),
                F.col("q").alias(f"{own}_q"),
                F.col("node").alias(f"{own}_node"),
                F.col("shingles").alias(f"{own}_shingles"),
            )
            .groupBy(f"{own}_label", f"{own}_v", f"{own}_q")
        )

    def compare(members: pa.Table, queries: pa.Table) -> pa.Table:
        found = linked_pairs(
            *(
                x
                for table in (members, queries)
                for x in (table.column(3).to_numpy(), _arrays(table.column(4)))
            ),
            percent,
        )
        return pa.table([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return (
        dealt(held, "v", "q")
        .cogroup(dealt(asking, "q", "v"))
        .applyInArrow(compare, "a long, b long")
    )


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [
        part.values.to_numpy(zero_copy_only=False)
        for chunk in column.chunks
        for part in (chunk[i] for i in range(len(chunk)))
    ]


def linked_pairs(
    ids: np.ndarray,
    sets: list[np.ndarray],
    query_ids: np.ndarray,
    queries: list[np.ndarray],
    percent: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) of the links between two blocks of sets.

    The members are an inverted index from shingle to owners, so a query costs what it has in
    common with them.
    """
    none = np.empty(0, np.int64)
    if not len(ids) or not len(query_ids):
        return none, none
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner = np.repeat(np.arange(len(ids)), sizes)[order]
    keys, start = np.unique(values[order], return_index=True)
    end = np.append(start[1:], len(values))
    left, right = [none], [none]
    for query_id, query in zip(query_ids, queries, strict=True):
        at = np.minimum(np.searchsorted(keys, query), len(keys) - 1)
        at = at[keys[at] == query]
        count = end[at] - start[at]
        shift = np.repeat(start[at] - (np.cumsum(count) - count), count)
        common = np.bincount(owner[shift + np.arange(len(shift))], minlength=len(ids))
        hit = ids[100 * common >= percent * (sizes + len(query) - common)]
        left.append(np.full(len(hit), query_id))
        right.append(hit)
    return np.concatenate(left), np.concatenate(right)


def _live(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of the buckets that hold more than one component, with their labels."""
    now = members.join(labels, "node", "left").select(
        "bucket", "node", "n", F.coalesce("label", "node").alias("label")
    )
    mixed_buckets = (
        now.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    return stored(now.join(mixed_buckets, "bucket", "left_semi"), "live")


def _rest(live: DataFrame, hubs: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """The pairs across components that may still be links, by size and distance to the hub.

    A pair comes from the first bucket it shares, so it is made once; where that bucket is a
    crowded one, its members are compared in blocks instead.
    """
    known = seen.selectExpr("a AS hub", "b AS node", "common", "all").union(
        seen.selectExpr("b AS hub", "a AS node", "common", "all")
    )
    # A node is in one bucket per band at most, so its list is short.
    shared = live.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    placed = stored(
        live.filter(f"members < {CROWDED}")
        .join(hubs, "bucket")
        .join(known, ["hub", "node"], "left")
        .join(shared, "node")
        .selectExpr(
            "bucket", "node", "n", "label", "buckets",
            "CASE WHEN node = hub THEN 1D ELSE common / all END AS near",
        ),
        "placed",
    )
    # A member that was not compared with this bucket's hub has no distance; then sizes decide.
    reach = (100 - percent) / 100 + 1e-9
    return (
        placed.alias("x")
        .join(placed.alias("y"), "bucket")
        .filter("x.node < y.node AND x.label <> y.label")
        .filter(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
        .filter(f"coalesce(abs(x.near - y.near) <= {reach}, true)")
        .filter("array_min(array_intersect(x.buckets, y.buckets)) = bucket")
        .selectExpr("x.node AS a", "y.node AS b")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = ROWS,
    star_rounds: int = STAR_ROUNDS,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row id n_shingles component_id keep``.

    Texts are linked when their sets of ``words``-word shingles share ``percent`` hundredths of
    their union, as far as they meet in a bucket (see ``BANDS``). ``component_id`` is the
    smallest id that links reach; null ids count only where there is no other. ``keep`` holds
    for one row per component: the one with the smallest id, nulls last, of repeated ids the one
    with the smallest row name. A text with fewer words is one shingle; a text without words, empty
    or null, has none, is linked with nothing and is kept. Equal sets are one node, so copies cost
    one row each. ``row`` is the document's ``row_col``, or what ``identified`` names it.
    """
    if row_col is None:
        row_col = fresh(docs, "row_name")
        docs = identified(docs, row_col)
    texts = docs.select(
        F.col(row_col).alias("row"),
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(text_col)).alias("text"),
    )
    rows = texts.select(
        "row", F.struct(F.col("id").isNull().alias("missing"), "id", "row").alias("first"), "text"
    )
    known = stored(features(rows, words, bands, band_rows), "shingle-features")
    # The number of a class is read from this table alone, so it does not change.
    classes = stored(
        known.filter("n > 0")
        .groupBy("set_key")
        .agg(F.min("row").alias("row"), F.min("first").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "shingle-classes",
    )
    nodes = known.select("row", "n", "bands").join(classes.select("row", "node"), "row")
    banded = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    members = stored(
        banded.join(shared, "bucket").select("bucket", "node", "n"), "bucket-members"
    )
    wanted = classes.select("row", "node").join(
        members.select("node").distinct(), "node", "left_semi"
    )
    sets = stored(
        full_sets(texts.select("row", "text").join(wanted, "row").select("node", "text"), words),
        "shingle-sets",
    )
    labels = linked_nodes(members, sets, percent, star_rounds)
    merged = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = merged.groupBy("label").agg(F.min("first").alias("first"))
    named = merged.select("set_key", "label").join(firsts, "label").select("set_key", "first")
    found = known.select("row", "first", "n", "set_key").alias("k")
    return found.join(named.alias("c"), "set_key", "left").select(
        F.col("k.row").alias("row"),
        F.col("k.first.id").alias("id"),
        F.col("k.n").alias("n_shingles"),
        F.when(F.col("c.first").isNull(), F.col("k.first.id"))
        .otherwise(F.col("c.first.id"))
        .alias("component_id"),
        F.when(F.col("c.first").isNull(), True)
        .otherwise(F.col("c.first.row") == F.col("k.row"))
        .alias("keep"),
    )


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their own columns."""
    row = fresh(docs, "row_name")
    docs = identified(docs, row)
    kept = near_duplicates(docs, row_col=row, **options).filter("keep")
    return docs.join(kept.select(F.col("row").alias(row)), row, "left_semi").drop(row)
