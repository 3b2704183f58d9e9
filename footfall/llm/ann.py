"""Nearest neighbours by cosine: inverted lists, scanned by blocks of dimensions.

Vectors of length one are rotated at random, so that the first d of D dimensions estimate a whole
distance. Each list is scanned in column blocks; after every block a hypothesis test abandons the
candidates whose partial distance says, at a chosen confidence, that they are farther than the
neighbours known so far. What survives is ranked by the exact measure on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import quoted, stored

#: The lists are found on at most about so many vectors.
SAMPLE_ROWS = 20_000
#: At least this many sampled vectors per list.
PER_LIST = 16
KMEANS_ROUNDS = 8
#: Vectors per list, on average, where the sample allows it; never more lists than the square
#: root of the number of vectors.
LIST_ROWS = 512
#: The part of all lists that a query visits, and the smallest number of them. Vectors without
#: clusters need many: half of the lists hold 0.91 to 0.94 of the true neighbours there.
PROBED, MIN_PROBED = 0.8, 8
#: Dimensions per column block, and how surely a candidate is farther before it is abandoned.
COLUMN_BLOCK, EPSILON = 16, 2.1
#: Vectors of a list, and queries, that meet in one task.
VECTOR_BLOCK, QUERY_BLOCK = 1024, 1024
#: Pairs that are compared at a time.
PAIRS = 1 << 16


def clean_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id vector`` of the rows that take part, one per id.

    Out go null ids, null, empty or zero vectors and those with a null or non-finite component,
    then those of another dimension than most have (of two such dimensions the larger counts).
    Of rows that repeat an id, the vector that sorts first stays.
    """
    vector = F.col(quoted(vector_col)).cast("array<float>")
    # Not NaN and below infinity; a null component makes the test null, so the row goes.
    fine = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter("vec_id IS NOT NULL").filter(fine & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.filter(F.size("vector") == (most.d if most else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(dimensions: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def kmeans(x: np.ndarray, lists: int, rounds: int = KMEANS_ROUNDS, seed: int = 7) -> np.ndarray:
    """Centres of length one by spherical k-means; an empty centre restarts at a random vector."""
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.sqrt((sums * sums).sum(axis=1))
        lost = norms == 0
        sums[lost] = x[draw.choice(len(x), int(lost.sum()))]
        norms[lost] = 1.0
        centres = sums / norms[:, None]
    return centres


def scan(
    queries: np.ndarray,
    vectors: np.ndarray,
    k: int,
    block: int = COLUMN_BLOCK,
    epsilon: float = EPSILON,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that may be among the ``k`` nearest; both sides rotated.

    The first vectors are measured in full, and the k-th of them is the distance to beat. A
    partial distance over d of D dimensions, scaled by D/d, is larger than the whole one by a
    factor of (1 + epsilon / sqrt(d)) ** 2 with small probability only; so what exceeds the
    distance to beat by that factor is abandoned. Pairs kept are those within rounding of the
    k-th distance, which keeps ties.
    """
    dimensions = vectors.shape[1]
    head = min(len(vectors), max(4 * k, 32))
    first = _squares(queries, vectors[:head])
    beat = np.full(len(queries), np.inf)
    if head >= k:
        beat = np.partition(first, k - 1, axis=1)[:, k - 1]
    q = np.repeat(np.arange(len(queries)), len(vectors))
    v = np.tile(np.arange(len(vectors)), len(queries))
    at = min(block, dimensions)
    part = _squares(queries[:, :at], vectors[:, :at]).ravel()
    while True:
        slack = (1 + epsilon / math.sqrt(at)) ** 2 if at < dimensions else 1.0 + 1e-6
        keep = part * (dimensions / at) <= beat[q] * slack + 1e-9
        q, v, part = q[keep], v[keep], part[keep]
        if at == dimensions:
            break
        to = min(at + block, dimensions)
        gap = queries[q, at:to] - vectors[v, at:to]
        part = part + (gap * gap).sum(axis=1)
        at = to
    return q, v


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    return np.maximum(both - 2.0 * (a @ b.T), 0.0)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal numbers."""
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / norms


def nearest_in_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    vector_ids: np.ndarray,
    vectors: np.ndarray,
    turn: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, cosine) of each query's ``k`` nearest among ``vectors``."""
    order = np.argsort(vector_ids, kind="stable")
    vector_ids, vectors = vector_ids[order], vectors[order]
    turned_q, turned_v = unit(queries) @ turn, unit(vectors) @ turn
    step = max(1, PAIRS // len(vectors))
    found = []
    for start in range(0, len(queries), step):
        # One more than k, as a query may find itself here.
        q, v = scan(turned_q[start : start + step], turned_v, k + 1)
        q = q + start
        other = query_ids[q] != vector_ids[v]
        q, v = q[other], v[other]
        score = cosine(queries[q], vectors[v])
        best = np.lexsort((vector_ids[v], -score, q))
        q, v, score = q[best], v[best], score[best]
        begin = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - begin < k
        found.append((query_ids[q[top]], vector_ids[v[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    probed: float = PROBED,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> DataFrame:
    """``query_id rank vec_id score``: the ``k`` nearest by cosine found for each query.

    Queries are the ids for which ``is_query`` (over the column ``vec_id``) holds; candidates
    are all other ids; ``clean_vectors`` says which rows take part. The centres of the lists
    are fitted on about ``sample_rows`` vectors; every vector is put in a list. A query visits
    the lists nearest to it, ``probed`` of all and more where they hold too few vectors, so it
    always gets ``k`` neighbours if there are as many. Ranks start at 1; equal scores go by id.
    Lists and their queries are split into blocks, so one vector that a third of the rows repeat
    is shared by many tasks.
    """
    spark = rows.sparkSession
    schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("vec_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    vectors = stored(clean_vectors(rows, id_col, vector_col), "vectors")
    total = vectors.count()
    if total < 2:
        return spark.createDataFrame([], schema)
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003))
    limit = math.ceil(1_000_003 * min(1.0, sample_rows / total))
    sample = vectors.filter(part < limit).select("vector").toArrow()
    if not sample.num_rows:
        sample = vectors.select("vector").limit(1).toArrow()
    sample = unit(matrix(sample.column("vector")))
    most = min(total // LIST_ROWS, len(sample) // PER_LIST)
    count = max(1, min(round(math.sqrt(total)), most))
    centres = kmeans(sample, count, seed=seed)
    turn = rotation(centres.shape[1], seed)
    shared = spark.sparkContext.broadcast((centres, turn))  # bounded by the sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, _ = shared.value
        for batch in batches:
            if batch.num_rows:
                own = (unit(matrix(batch.column(1))) @ centres.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own.astype(np.int32))],
                    names=["vec_id", "vector", "list"],
                )

    listed = stored(
        vectors.mapInArrow(assign, "vec_id long, vector array<float>, list int"), "lists"
    )
    sizes = np.zeros(count, dtype=np.int64)
    for row in listed.groupBy("list").count().collect():  # a row per list
        sizes[row["list"]] = row["count"]
    visits = max(MIN_PROBED, math.ceil(probed * count))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, _ = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-(unit(matrix(batch.column(1))) @ centres.T), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            # Lists before which fewer than k others are known, and the nearest ones anyway.
            need = (held - sizes[order] < k + 1) | (np.arange(count) < visits)[None, :]
            lists = [order[i][need[i]].astype(np.int32) for i in range(len(order))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))],
                names=["query_id", "query", "lists"],
            )

    queries = listed.filter(is_query).select("vec_id", "vector")
    probes = stored(
        queries.mapInArrow(probe, "query_id long, query array<float>, lists array<int>"), "probes"
    ).select("query_id", "query", F.explode("lists").alias("list"))
    # Both numbers of blocks are known per list; there are `count` lists.
    asked = np.zeros(count, dtype=np.int64)
    for row in probes.groupBy("list").count().collect():
        asked[row["list"]] = row["count"]
    parts = np.maximum(1, -(-sizes // VECTOR_BLOCK))
    turns = np.maximum(1, -(-asked // QUERY_BLOCK))

    def per_list(values):
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("list") + 1)

    def spread(frame, own, own_parts, own_id, other, other_parts):
        """``own`` block by hash of the id, and a copy for each block of the other side."""
        return frame.withColumn(
            own, F.pmod(F.xxhash64(own_id), per_list(own_parts)).cast("int")
        ).withColumn(other, F.explode(F.sequence(F.lit(0), per_list(other_parts) - 1)))

    left = spread(listed, "v", parts, "vec_id", "q", turns).groupBy("list", "v", "q")
    right = spread(probes, "q", turns, "query_id", "v", parts).groupBy("list", "v", "q")

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        empty = pa.table([pa.array([], x) for x in (pa.int64(), pa.int64(), pa.float64())], names)
        if not a.num_rows or not b.num_rows:
            return empty
        _, turn = shared.value
        found = nearest_in_block(
            b.column("query_id").to_numpy(),
            matrix(b.column("query")),
            a.column("vec_id").to_numpy(),
            matrix(a.column("vector")),
            turn,
            k,
        )
        return pa.table([pa.array(x) for x in found], names)

    found = left.cogroup(right).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
