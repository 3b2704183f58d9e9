"""Rows keep their identity when files are packed into tasks in another way between two scans."""

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from footfall.llm import exact_dedup, license_scan, minhash, mixing
from footfall.llm.common import identified

NOTICE = "Licensed under the Apache License, Version 2.0 (the \"License\")"


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Documents in six files of several row groups; two of three texts come twice."""
    path = str(tmp_path_factory.mktemp("many") / "docs")
    n = F.col("id") % 400
    words = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.md5(F.concat_ws(":", n, i)))
    text = F.array_join(words, " ")
    text = F.when(n % 50 == 0, F.concat_ws("\n", text, F.lit(NOTICE))).otherwise(text)
    rows = spark.range(600).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
    )
    rows.repartition(6).write.option("parquet.block.size", 4096).parquet(path)
    return spark.read.parquet(path)


@contextmanager
def packed(spark, cores, cost="1"):
    """Files packed into tasks as on a cluster with so many cores."""
    wanted = {
        "spark.sql.leafNodeDefaultParallelism": str(cores),
        "spark.sql.files.openCostInBytes": cost,
        "spark.sql.files.minPartitionNum": str(cores),
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def again(frame):
    """The same rows from a plan that is made anew."""
    return frame.filter("true")


SIZES = [(1, 16), (16, 1)]


def test_packing_differs(spark, many):
    """Otherwise the tests below say nothing."""
    found = []
    for cores in (1, 16):
        with packed(spark, cores):
            rows = many.select("doc_id", F.monotonically_increasing_id().alias("row"))
            found.append(Counter(map(tuple, rows.collect())))
    assert found[0] != found[1]


def test_names_stay(spark, many):
    found = []
    for frame in (many, many.filter("doc_id >= 0").select("doc_id")):
        for cores in (1, 16):
            with packed(spark, cores):
                named = identified(frame, "name").select("doc_id", "name")
                found.append({r.doc_id: tuple(r.name) for r in named.collect()})
    assert all(x == found[0] for x in found) and len(set(found[0].values())) == 600
    # What is no scan is stored and then keeps its names too.
    made = identified(many.groupBy("text").agg(F.min("doc_id").alias("doc_id")), "name")
    names = []
    for cores in (1, 16):
        with packed(spark, cores):
            names.append({r.doc_id: tuple(r.name) for r in made.collect()})
    assert names[0] == names[1] and len(set(names[0].values())) == len(names[0]) == 400


@pytest.mark.parametrize("first,then", SIZES)
def test_exact_dedup(spark, many, first, then):
    with packed(spark, first):
        found, kept = exact_dedup.exact_dedup(many), exact_dedup.kept_rows(many)
    with packed(spark, then):
        rows = again(found).collect()
        assert len(rows) == 600 and sum(r.kept for r in rows) == 400
        assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
        texts = [r.text for r in again(kept).collect()]
        assert len(texts) == len(set(texts)) == 400


@pytest.mark.parametrize("first,then", SIZES)
def test_near_duplicates(spark, many, first, then):
    with packed(spark, first):
        found = minhash.near_duplicates(many)
    with packed(spark, then):
        rows = again(found).collect()
        assert len(rows) == 600 and sum(r.keep for r in rows) == 400
        assert all(r.component_id == r.id % 400 for r in rows)


@pytest.mark.parametrize("first,then", SIZES)
def test_mixed_rows(spark, many, first, then):
    with packed(spark, first):
        found = mixing.mixed_rows(many, max_repeats=1)
    with packed(spark, then):
        assert sorted(r.doc_id for r in again(found).collect()) == list(range(600))


def test_licenses(spark, many):
    files = many.withColumn("path", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    with packed(spark, 1):
        found = license_scan.scan_licenses(files.select("doc_id", "path", "text"))
    with packed(spark, 16):
        rows = again(found).collect()
        hits = {r.doc_id for r in rows if r.origin == "header"}
        assert len(rows) == 600 and hits == {i for i in range(600) if i % 400 % 50 == 0}
