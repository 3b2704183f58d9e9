import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from footfall.operators.geo import BadRules, check_rules, ip_region_join
from footfall.operators.sweep import find_cuts, sweep_join, with_part
from footfall.schemas import IP_RULES


def _rules(spark, *spans):
    rows = [(a, b, f"c{a}", f"p{a}", f"t{a}") for a, b in spans]
    return spark.createDataFrame(rows, IP_RULES)


def _dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def _spans(seed):
    """Random spans of all widths that do not overlap, with gaps."""
    pick, out, at = random.Random(seed), [], 0
    while at < 2**32 and len(out) < 400:
        width = 2 ** pick.choice([0, 0, 3, 8, 9, 14, 16, 17, 20, 24, 27]) + pick.randint(0, 2)
        if at + width > 2**32:
            break
        out.append((at, at + width - 1))
        at += width + pick.choice([0, 0, 1, 300, 70000])
    return out


@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
def test_matches_brute_force(spark, broadcast_bytes):
    spans = _spans(1)
    pick = random.Random(2)
    numbers = [n for a, b in spans for n in (a - 1, a, b, b + 1) if 0 <= n < 2**32]
    numbers += [pick.randrange(2**32) for _ in range(200)]
    addresses = [(_dotted(n), str(i)) for i, n in enumerate(numbers)]
    logs = spark.createDataFrame(addresses, "ip string, i string")
    out = ip_region_join(logs, _rules(spark, *spans), broadcast_bytes=broadcast_bytes)
    found = {r.i: r.country for r in out.collect()}
    assert len(found) == len(numbers)
    for i, n in enumerate(numbers):
        hit = [a for a, b in spans if a <= n <= b]
        assert found[str(i)] == (f"c{hit[0]}" if hit else "unknown")


def test_counts_bucket_rows(spark):
    rules = _rules(spark, (0, 255), (256, 65791), (65792, 2**24 + 65792))
    sizes = check_rules(rules)
    assert {b: s.rows for b, s in sizes.items()} == {8: 1, 16: 2, 24: 2}
    assert all(72 * s.rows < s.bytes < 100 * s.rows for s in sizes.values())


@pytest.mark.parametrize(
    "spans",
    [[(0, 10), (10, 20)], [(0, 2**20), (500, 600)], [(5, 5), (5, 5)], [(0, 2**32)], [(-1, 5)], [(5, 4), (7, 8)], [(None, 4)]],
)
def test_bad_rules(spark, spans):
    with pytest.raises(BadRules):
        check_rules(_rules(spark, *spans))


def test_no_rules(spark):
    logs = spark.createDataFrame([("1.2.3.4",)], "ip string")
    row = ip_region_join(logs, _rules(spark)).first()
    assert tuple(row) == ("1.2.3.4", "unknown", "unknown", "unknown")


def test_plan_hashes(spark):
    logs = spark.createDataFrame([("1.2.3.4",)], "ip string")
    plan = plan_of(ip_region_join(logs, _rules(spark, (0, 10), (1000, 60000), (2**25, 2**27))))
    assert plan.count("BroadcastHashJoin") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_budget_for_all_classes(spark):
    logs = spark.createDataFrame([("1.2.3.4",)], "ip string")
    rules = _rules(spark, (0, 10), (1000, 60000), (2**25, 2**27))
    sizes = check_rules(rules)
    two = sum(sorted(s.bytes for s in sizes.values())[:2])
    plan = plan_of(ip_region_join(logs, rules, broadcast_bytes=two, sizes=sizes))
    assert plan.count("BroadcastHashJoin") == 2 and "_swept" in plan


def test_sweep_shuffles_the_log_once(spark, folder):
    logs = spark.range(100).selectExpr("concat('1.2.3.', id) AS ip", "map('a', id) AS params")
    logs.write.parquet(folder("logs"))
    logs = spark.read.parquet(folder("logs"))
    out = ip_region_join(logs, _rules(spark, (0, 10), (1000, 2**25), (2**26, 2**27)), broadcast_bytes=0)
    plan = plan_of(out)
    assert "_salt" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # Everything above the scan of the log, down from the result: one exchange.
    log = next(i for i, x in enumerate(plan.split("\n")) if "ReadSchema: struct<ip:string" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    above, least = [], 10**6
    for line in reversed(plan.split("\n")[: log + 1]):
        if depth(line) < least:
            least = depth(line)
            above.append(line)
    assert sum("Exchange" in line for line in above) == 1
    assert out.count() == 100 and set(out.columns) == {"ip", "params", "country", "province", "city"}


@pytest.mark.parametrize("cuts", [[], [5 << 16], None, list(range(0, 1 << 20, 1 << 12))])
def test_sweep_with_any_cuts(spark, cuts):
    """Results do not depend on where the order is cut, nor on null and repeated addresses."""
    spans = [(0, 3), (4, 4), (6, 9), (14, 14)]
    rows = [(n, i) for n in [*range(16), 6, 6, 6, None, None] for i in range(3)]
    logs = spark.createDataFrame(rows, "n bigint, i int").repartition(3)
    ranges = spark.createDataFrame(spans, "start bigint, stop bigint")
    found = sweep_join(logs, "n", ranges, "start", F.col("stop"), "stop", parts=4, cuts=cuts)
    assert found.count() == len(rows)
    for r in found.collect():
        starts = [s for s in spans if r.n is not None and s[0] <= r.n]
        assert r.stop == (starts[-1][1] if starts else None)


def test_cuts_split_a_hot_address(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, id, 7) AS n", "id")
    placed = rows.withColumn("_place", F.expr("shiftleft(n, 16) + pmod(xxhash64(n, id), 65536)"))
    cuts = find_cuts(placed, "_place", 8)
    sizes = with_part(placed, "_place", cuts, "part").groupBy("part").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 600
