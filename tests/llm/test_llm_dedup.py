import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.llm_brute import near_brute
from pyspark.sql import functions as F

from footfall.llm import exact_dedup, minhash
from footfall.llm.graph import components


def weak(text):
    return F.concat(F.lit("d"), F.length(text) % 3)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_groups(docs, digest):
    rows = exact_dedup.exact_dedup(docs, digest=digest).collect()
    assert len(rows) == docs.count()
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r)
    for members in groups.values():
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert {r.keep_id for r in members} == {min(ids, default=None)}
        assert {r.group_size for r in members} == {len(members)}
        assert [r.doc_id for r in members if r.kept] == [min(ids, default=None)]


def test_exact_kept_rows_have_the_columns_of_the_table(docs):
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()).most_common(1)[0][1] == 1


def test_exact_hot_text(saved):
    rows = [(i, "copy" if i % 3 else f"text {i}", "en", "s") for i in range(600)]
    found = exact_dedup.exact_dedup(saved(rows, files=20)).filter("text = 'copy'")
    assert found.select("keep_id", "group_size").distinct().collect() == [(1, 400)]
    assert found.filter("kept").count() == 1


def test_near_edge_rows(docs):
    rows = minhash.near_duplicates(docs, words=2).collect()
    assert len(rows) == docs.count()
    by_id = {r.id: r for r in rows if r.id not in (None, 8, 9)}
    assert [by_id[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert [by_id[i].n_shingles for i in (4, 5, 6)] == [0, 0, 0]
    assert all(by_id[i].keep and by_id[i].component_id == i for i in (4, 5, 6, 7))
    assert by_id[10].n_shingles == 1
    assert [r.keep for r in rows if r.id == 8].count(True) == 1
    assert sum(r.keep for r in rows if r.id is None and r.n_shingles) == 1
    assert minhash.kept_rows(docs, words=2).columns == docs.columns


def corpus(seed, families=12, copies=25):
    draw = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{draw.randrange(300)}" for _ in range(draw.choice([1, 2, 5, 20, 60]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(6)):
                own[draw.randrange(len(own))] = f"v{draw.randrange(300)}"
            rows.append((len(rows), " ".join(own), "en", "s"))
    return rows


@pytest.mark.parametrize("large, crowded", [(4, 32), (10**6, 10**6), (10**6, 2), (10**6, 5)])
def test_near_finds_every_link(saved, monkeypatch, large, crowded):
    # Each way of settling what the stars leave: components, crowded buckets, single pairs.
    monkeypatch.setattr(minhash, "LARGE", large)
    monkeypatch.setattr(minhash, "CROWDED", crowded)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 200)
    rows = corpus(5)
    found = minhash.near_duplicates(saved(rows), words=2, star_rounds=1).collect()
    wanted = near_brute(rows, 2, 80)
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_shingles_do_not_depend_on_their_place():
    texts = [b"a b c", b"", b"  A  b\x0bc ", b"one", b"x a b c", b"a b c" * 3]
    sets = minhash.shingle_sets(texts, 2)
    assert [len(s) for s in sets] == [2, 0, 2, 1, 3, 4]
    assert (sets[0] == sets[2]).all() and set(sets[0]) < set(sets[4])
    alone = [minhash.shingle_sets([t], 2)[0] for t in texts]
    assert all((a == b).all() for a, b in zip(sets, alone, strict=True))


def test_sketches_agree_like_the_sets():
    draw = np.random.default_rng(1)
    for size in (10, 100, 2000):
        shared = draw.integers(0, 2**63, size * 8 // 10, dtype=np.uint64)
        rest = draw.integers(0, 2**63, (2, size // 10), dtype=np.uint64)
        pair = [np.unique(minhash.mixed(np.concatenate([shared, r]))) for r in rest]
        sketch = minhash.sketches(pair, 3600)
        assert abs((sketch[0] == sketch[1]).mean() - 0.8) < 0.12


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (205, 200), (200, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert (found[101], found[300], found[205]) == (100, 200, 200)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.kept_rows(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.kept_rows(empty).columns == empty.columns
