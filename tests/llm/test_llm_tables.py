import math
import random
import re
import struct
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from footfall.llm import ann, license_scan, mixing, sharding
from footfall.llm.common import running_total


def test_running_total(saved):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), draw.randrange(4), i, draw.randrange(9)) for i in range(300)]
    frame = saved(rows, "k string, bucket int, i int, n int")
    found = running_total(frame, ["k"], ["i"], "n", "bucket", "before").collect()
    assert len(found) == 300
    for r in found:
        wanted = sum(n for k, b, i, n in rows if k == r.k and (b, i) < (r.bucket, r.i))
        assert r.before == wanted


def totals(spark, tokens):
    rows = [((str(i),), n, 1) for i, n in enumerate(tokens)]
    return spark.createDataFrame(rows, "source struct<name: string>, tokens long, docs long")


def test_exponent_meets_its_target(spark):
    tokens = [1000, 100, 10]
    frame = totals(spark, tokens)
    power = mixing.mix_exponent(frame, max_repeats=4)
    # 100 times as many tokens: repeats differ by 100 ** (1 - power)
    assert abs(power - (1 - math.log(4) / math.log(100))) < 1e-6
    power = mixing.mix_exponent(frame, min_entropy=0.9)
    weights = np.array(tokens) ** power / (np.array(tokens) ** power).sum()
    entropy = -(weights * np.log(weights)).sum() / math.log(3)
    assert 0.9 <= entropy < 0.90001
    assert mixing.mix_exponent(totals(spark, [5]), max_repeats=2) == 0.0
    assert mixing.mix_exponent(totals(spark, []), max_repeats=2) == 1.0
    with pytest.raises(ValueError):
        mixing.mix_exponent(frame)


def test_mix_deals_weights_over_blocks(saved):
    draw = random.Random(2)
    rows = []
    for source, n in (("hot", 900), ("warm", 200), ("cold", 100)):
        rows += [(len(rows) + i, "w " * draw.randrange(1, 9), "en", source) for i in range(n)]
    draws = mixing.mix(
        saved(rows, files=4), max_repeats=2, block_tokens=800, bucket_rows=50
    ).collect()
    uses = Counter(r.id for r in draws)
    assert set(uses) == set(range(1200)) and max(uses.values()) <= 2
    share = defaultdict(Counter)
    for r in draws:
        share[r.block][r.source] += r.tokens
    budgets = {r.source: r.budget for r in draws}
    assert len(share) == math.ceil(sum(budgets.values()) / 800)
    for block in list(share)[:-1]:
        for source, budget in budgets.items():
            assert abs(share[block][source] - budget / len(share)) <= 12
    for block in share:
        slots = sorted(r.slot for r in draws if r.block == block)
        assert slots == list(range(len(slots)))
    # each epoch is another permutation
    first = [[r.id for r in sorted(draws, key=lambda r: (r.block, r.slot)) if r.source == "cold" and r.epoch == e] for e in (0, 1)]
    assert first[0] != first[1]


def test_mix_edges(docs, empty):
    draws = mixing.mix(docs, max_repeats=3).collect()
    assert len({r.row for r in draws}) == docs.count()
    assert None in {r.source for r in draws}
    mixed = mixing.mixed_rows(docs, max_repeats=1)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()
    assert mixing.mix(docs, max_repeats=1, total_tokens=10).count() < docs.count()
    assert mixing.mix(empty, max_repeats=2).count() == 0
    assert mixing.mixed_rows(empty, min_entropy=0.5).columns == empty.columns


def plain_shard(key, tree):
    def draw(name, weight):
        seed = xxhash.xxh64(name.encode(), 42).intdigest()
        bits = (seed if key is None else xxhash.xxh64(struct.pack("<q", key), seed).intdigest()) >> 11
        return math.log((bits + 0.5) * 2.0**-53) / weight

    total = lambda x: sum(map(total, x.values())) if isinstance(x, dict) else x
    region = max(tree, key=lambda n: draw(n, total(tree[n])))
    rack = max(tree[region], key=lambda n: draw(n, total(tree[region][n])))
    shards = tree[region][rack]
    return max(shards, key=lambda s: draw(f"shard{s}", shards[s]))


def test_shards_are_weighted_and_move_only_into_what_grows(spark):
    tree = {"r0": {"a": {0: 1.0, 1: 2.0}, "b": {2: 1.0}}, "r1": {"c": {3: 4.0}}}
    heavier = {"r0": {"a": {0: 1.0, 1: 2.0}, "b": {2: 3.0}}, "r1": {"c": {3: 4.0}}}
    grown = sharding.grown(tree)
    frame = spark.range(20_000).select(
        "id",
        *[
            sharding.shard_of(F.col("id"), t).alias(n)
            for n, t in (("now", tree), ("heavy", heavier), ("grown", grown))
        ],
    )
    rows = frame.collect()
    counts = Counter(r.now for r in rows)
    assert all(abs(counts[s] / 2500 - w) < 0.15 * w for s, w in ((0, 1), (1, 2), (2, 1), (3, 4)))
    assert {r.grown for r in rows if r.grown != r.now} == {4}
    # more weight in r0/b: out of r1 into r0, inside r0 only into b
    moved = {(r.now, r.heavy) for r in rows if r.now != r.heavy}
    assert all(a == 3 or b == 2 for a, b in moved) and not any(b == 3 for _, b in moved)
    for r in rows[:300]:
        assert r.now == plain_shard(r.id, tree)


def test_slots(docs, empty):
    tree = sharding.even_tree(3)
    rows = sharding.put_in_shards(docs, tree, sharding.grown(tree), bucket_rows=2).collect()
    assert len(rows) == docs.count()
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    for i in (None, 8, 9):
        assert len({r.shard for r in rows if r.doc_id == i}) == 1
    assert sharding.put_in_shards(empty, tree).count() == 0


def plain_nearest(rows, is_query, k):
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    found = {}
    for q in filter(is_query, vectors):
        scored = sorted(
            (-round(float(v @ vectors[q] / np.sqrt((v @ v) * (vectors[q] @ vectors[q]))), 9), i)
            for i, v in vectors.items()
            if i != q
        )
        found[q] = [i for _, i in scored[:k]]
    return found


def test_nearest_of_few(saved):
    bad = [(None, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]),
           (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0])]
    good = [(10, [1.0, 0.0]), (20, [1.0, 1.0]), (30, [2.0, 2.0]), (40, [0.0, 1.0])]
    schema = "vec_id long, embedding array<float>"
    rows = saved(bad + good + good[:1] + [(20, [5.0, 0.0])], schema)
    found = ann.nearest(rows, F.col("vec_id") % 20 == 0).collect()
    assert {(r.query_id, r.rank): r.vec_id for r in found} == {
        (20, 1): 30, (20, 2): 10, (20, 3): 40,  # equal scores go by id
        (40, 1): 20, (40, 2): 30, (40, 3): 10,
    }
    assert ann.nearest(saved(bad, schema), F.lit(True)).count() == 0
    assert ann.nearest(saved([], schema), F.lit(True)).count() == 0


def test_nearest_recall_and_ties(saved):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.standard_normal(64)]) for i in range(3000)]
    rows += [(3000 + i, rows[7][1]) for i in range(1500)]  # one vector holds a third of the rows
    frame = saved(rows, "vec_id long, embedding array<float>", files=5)
    found = ann.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    wanted = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r.query_id].append(r.vec_id)
    hits = sum(len(set(got[q]) & set(w)) for q, w in wanted.items())
    assert set(got) == set(wanted) and hits >= 0.95 * 5 * len(wanted)
    assert got[3050] == [7, 3000, 3001, 3002, 3003]


def test_scan_keeps_the_near_and_drops_most():
    draw = np.random.default_rng(6)
    vectors, queries = (ann.unit(draw.standard_normal((n, 64))) for n in (2000, 20))
    turn = ann.rotation(64)
    q, v = ann.scan(queries @ turn, vectors @ turn, 5)
    exact = np.argsort(-(queries @ vectors.T), axis=1)[:, :5]
    kept = set(zip(q.tolist(), v.tolist(), strict=True))
    assert sum((i, j) in kept for i in range(20) for j in exact[i].tolist()) >= 97
    assert len(kept) < 0.15 * 20 * 2000


FILES = [
    ("src/a.c", "/* Licensed under the Apache License, Version 2.0. */\nint x;"),
    ("src/b.c", "int y;"),
    ("src/LICENSE", "Released under the MIT License."),
    ("src/deep/er/c.c", None),
    ("src/deep/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    ("srcs/d.c", "the license of the version"),
    ("e.c", ""),
    (None, "Released under the MIT License."),
    (None, "nothing"),
    ("src/b.c", "int y;"),
]


def test_licenses(saved):
    rows = license_scan.scan_licenses(saved(FILES, "path string, text string")).collect()
    found = Counter((r.path, r.license, r.origin, r.line) for r in rows)
    assert found == Counter(
        [
            ("src/a.c", "Apache-2.0", "header", 0),
            ("src/b.c", "MIT", "directory", None),
            ("src/b.c", "MIT", "directory", None),
            ("src/LICENSE", "MIT", "file", None),
            ("src/deep/er/c.c", "GPL-3.0", "directory", None),
            ("src/deep/COPYING", "GPL-3.0", "file", None),
            ("srcs/d.c", None, None, None),
            ("e.c", None, None, None),
            (None, "MIT", "file", None),
            (None, None, None, None),
        ]
    )


def plain_cosine(passage, notice, texts):
    """TF-IDF over all terms of all texts."""
    words = lambda text: [t for t in re.split("[^a-z0-9]+", text.lower()) if t]
    found = Counter(t for text in texts for t in set(words(text)))

    def vector(text):
        return {t: n * (math.log((1 + len(texts)) / (1 + found[t])) + 1) for t, n in Counter(words(text)).items()}

    a, b = vector(passage), vector(notice)
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    return sum(x * b.get(t, 0.0) for t, x in a.items()) / (size(a) * size(b))


def test_license_lines_with_common_words(saved):
    lines = (
        "Released under the MIT License. en",
        "en on Licensed under the Apache License, Version 2.0.",
        "en on da This work is licensed under the GNU General Public License, version 3.",
        "Released rarely under the MIT License.",
    )
    filler = [f"int x{i};\nen on da" for i in range(3000)]
    texts = [*(f"{line}\nint y{i};" for i, line in enumerate(lines)), *filler]
    rows = license_scan.scan_licenses(
        saved([(f"{i}/x", t) for i, t in enumerate(texts)], "path string, text string")
    ).filter("license IS NOT NULL").collect()
    found = {int(r.path[:-2]): (r.license, r.similarity) for r in rows}
    assert {i: v[0] for i, v in found.items() if i < 3} == {0: "MIT", 1: "Apache-2.0", 2: "GPL-3.0"}
    for i, line in enumerate(lines):
        wanted = max(plain_cosine(line, notice, texts) for _, notice in license_scan.TEMPLATES)
        assert (wanted >= 0.75) == (i in found)
        assert i not in found or abs(found[i][1] - wanted) < 2e-6
    assert set(found) <= set(range(4))


def test_license_wrapped_headers_and_texts(saved):
    notices, texts = dict(license_scan.TEMPLATES + license_scan.NOTICES), dict(license_scan.TEXTS)
    code = "".join(f"\nint value{i} = call{i}(argument{i});" for i in range(60))
    rows = [("mit/LICENSE", texts["MIT"].replace("(c)", "(c) 2020 Jane Doe")), ("mit/a.c", "int a;")]
    rows += [("gpl/COPYING", texts["GPL-3.0"]), ("gpl/a.c", "int b;")]
    for name in ("Apache-2.0", "MIT", "BSD-3-Clause", "GPL-3.0", "GPL-2.0"):
        for mark, width in ((" * ", 60), ("# ", 40)):
            wrapped = "\n".join(mark + x for x in textwrap.wrap(" ".join(notices[name].split()), width))
            rows.append((f"{name}/{width}/head", f"{wrapped}\n{code}"))
            rows.append((f"{name}/{width}/deep", f"{code}\n{wrapped}\n{code}"))
    for name in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC"):
        rows.append((f"{name}/0/text", f"/*\n{texts[name]}*/{code}"))
    rows.append(("none/0/x", "the license of this software and the version of the program" + code))
    found = license_scan.scan_licenses(saved(rows, "path string, text string")).collect()
    for r in found:
        first, *rest = r.path.split("/")
        if first in ("mit", "gpl"):
            wanted = {"mit": "MIT", "gpl": "GPL-3.0"}[first], "directory" if rest == ["a.c"] else "file"
        else:
            wanted = (None, None) if first == "none" else (first, "header")
        assert (r.license, r.origin) == wanted, r
        if rest[-1] == "deep":
            assert r.line == 61, r


def test_license_edges(docs, empty):
    files = docs.withColumn("path", F.concat_ws("/", "source", "doc_id"))
    rows = license_scan.scan_licenses(files).collect()
    assert len(rows) == docs.count()
    assert {r.license for r in rows if r.doc_id == 8} == {"Apache-2.0"}
    assert license_scan.scan_licenses(empty.withColumn("path", F.lit("x"))).count() == 0


def test_terms_left_out_cannot_reach_the_threshold():
    vectors = {0: {"a": 3.0, "b": 1.0, "c": 1.0}, 1: {"b": 1.0, "c": 2.0}}
    needed = license_scan.distinctive(vectors, 0.75)
    for vector in vectors.values():
        out = math.sqrt(sum(v * v for t, v in vector.items() if t not in needed))
        assert out < 0.75 * math.sqrt(sum(v * v for v in vector.values()))
    assert "a" in needed
