"""Reports against brute force over small events with every kind of gap."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from footfall.operators import products, reports
from footfall.operators.visits import visit_grain
from footfall.schemas import STEP_BUCKETS, TIME_BUCKETS

SCHEMA = (
    "uid string, sid string, en string, country string, province string, city string, "
    "pl string, pid string, access_time_ms bigint, dt date"
)
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


@pytest.fixture(scope="module")
def events():
    pick = random.Random(5)
    out = []
    for _ in range(700):
        day = pick.choice(DAYS)
        country = pick.choice(["A", "A", "B", "unknown"])
        out.append(
            (
                pick.choice(["u1", "u1", "u1", "u2", "u3", "u4"]),
                pick.choice([None, *[f"s{i}" for i in range(120)]]),
                pick.choice(["e_l", "e_pv", "e_pv", "e_bp", "e_ba", "e_s"]),
                country,
                country + pick.choice("xy"),
                pick.choice(["c1", "c2", ""]),
                pick.choice(["pc", "ios", None]),
                pick.choice(["1", "2", "10", " ", None, "3"]),
                pick.choice([0, 3999, 4000, 5000, 31000, 61000, 1801000]) + pick.randint(0, 1),
                day,
            )
        )
    return out


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def _levels(event):
    """Platform choices of an event: its own, and all of them."""
    return [("own", event[6]), ("all", "all")]


def _group(events, keys):
    groups = defaultdict(list)
    for e in events:
        for key in keys(e):
            groups[key].append(e)
    return groups


def test_user_stats(frame, events):
    groups = _group(events, lambda e: [(e[9], *p) for p in _levels(e)])
    wanted = Counter()
    for (day, _, platform), members in groups.items():
        sids = {e[1] for e in members}
        views = sum(e[2] in ("e_pv", "e_bp") for e in members)
        launches = sum(e[2] == "e_l" for e in members)
        wanted[
            (day, platform, len({e[0] for e in members}), launches, len(sids), views // len(sids))
        ] += 1
    found = Counter(tuple(r) for r in reports.user_stats(visit_grain(frame, ("pl",))).collect())
    assert found == wanted
    assert any(platform is None for _, platform, *_ in found)
    assert found == Counter(tuple(r) for r in reports.user_stats(visit_grain(frame)).collect())


def test_sessions(frame, events):
    groups = _group(events, lambda e: [(e[9], *p, e[1]) for p in _levels(e)])
    metrics = {}
    for key, members in groups.items():
        times = [e[8] for e in members]
        steps = sum(e[2] in ("e_pv", "e_bp") for e in members)
        metrics[key] = ((max(times) - min(times)) // 1000, steps)
    visits = visit_grain(frame)
    found = Counter(tuple(r) for r in reports.session_metrics(visits).collect())
    assert found == Counter((d, p, s, *m) for (d, _, p, s), m in metrics.items())

    shares = defaultdict(Counter)
    for (day, kind, platform, _), (length, steps) in metrics.items():
        count = shares[(day, kind, platform)]
        count["session_count"] += 1
        for name, low, high in TIME_BUCKETS:
            count["time_" + name] += low <= length and (high is None or length <= high)
        for name, low, high in STEP_BUCKETS:
            count["step_" + name] += low <= steps and (high is None or steps <= high)
    rows = reports.session_aggr_stat(visits).collect()
    assert len(rows) == len(shares)
    for (day, _, platform), count in shares.items():
        row = next(r for r in rows if (r.dt, r.platform) == (day, platform))
        for name in row.asDict():
            if name.startswith(("time_", "step_")):
                exact = Decimal(count[name] / count["session_count"])
                assert row[name] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    lengths = [length for length, _ in metrics.values()]
    assert 4 in lengths, "the hole between the first two buckets must be tried"


def test_locations(frame, events):
    def keys(e, platforms):
        places = [(e[3], "all", "all"), (e[3], e[4], "all"), (e[3], e[4], e[5])]
        return [(e[9], *p, i, *place) for p in platforms for i, place in enumerate(places)]

    def numbers(members):
        sids = Counter(e[1] for e in members)
        return len({e[0] for e in members}), len(sids), sum(n == 1 for n in sids.values())

    groups = _group(events, lambda e: keys(e, _levels(e)))
    wanted = Counter((d, p, *place, *numbers(m)) for (d, _, p, _, *place), m in groups.items())
    visits = visit_grain(frame)
    found = Counter(tuple(r) for r in reports.device_location_stats(visits).collect())
    assert found == wanted

    groups = _group(events, lambda e: keys(e, [()]))
    wanted = Counter()
    for (day, _, *place), m in groups.items():
        users, sessions, single = numbers(m)
        launches = sum(e[2] == "e_l" for e in m)
        views = sum(e[2] in ("e_pv", "e_bp") for e in m)
        wanted[(day, *place, launches, users, views, sessions, single)] += 1
    assert Counter(tuple(r) for r in reports.location_flow(visits).collect()) == wanted


def test_event_stats(frame, events):
    groups = _group(
        events,
        lambda e: [(e[9], *p, *n) for p in _levels(e) for n in (("own", e[2]), ("all", "all"))],
    )
    wanted = Counter((d, p, n, len(m)) for (d, _, p, _, n), m in groups.items())
    assert Counter(tuple(r) for r in reports.event_stats(frame).collect()) == wanted


def test_products(frame, events):
    counts = Counter()
    cities = defaultdict(set)
    for e in events:
        if e[2] == "e_bp" and e[7] and e[7].strip():
            counts[(e[9], e[3], e[4], e[7])] += 1
            cities[(e[9], e[3], e[4], e[7])].add(e[5])
    rollup = products.area_product_rollup(
        products.area_product_counts(products.product_views(frame))
    )
    found = {tuple(r)[:4]: tuple(r)[4:] for r in rollup.collect()}
    assert found == {k: (n, ",".join(sorted(cities[k]))) for k, n in counts.items()}

    areas = defaultdict(list)
    for (day, country, province, product), n in counts.items():
        areas[(day, country, province)].append((-n, int(product)))
    wanted = {
        (*area, product, -n, rank)
        for area, items in areas.items()
        for rank, (n, product) in enumerate(sorted(items)[:3], 1)
    }
    top = products.area_top_products(rollup).drop("city_infos").collect()
    assert {tuple(r) for r in top} == wanted


def test_sql_surface(spark, frame):
    products.register_views(spark, frame)
    by_sql = Counter(tuple(r) for r in spark.sql(products.ROLLUP_SQL).collect())
    counts = products.area_product_counts(products.product_views(frame))
    assert by_sql == Counter(tuple(r) for r in products.area_product_rollup(counts).collect())


def test_a_dimension_value_named_all_stays_apart(spark):
    rows = [("u", "s", "e_l", "A", "A", "c", "all", None, 0, DAYS[0])]
    stats = reports.event_stats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.platform, r.event_name, r.times) for r in stats) == [
        ("all", "all", 1),
        ("all", "all", 1),
        ("all", "e_l", 1),
        ("all", "e_l", 1),
    ]
