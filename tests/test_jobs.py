import datetime as dt

import pytest

from footfall import storage
from footfall.plans.daily import load_dims, run_daily
from footfall.plans.days import parse_day
from footfall.plans.etl import run_etl
from footfall.sources import MissingLogs, read_event_log

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
MS = 1704067200000
RULE = "1.0.1.0|1.0.3.255|16777472|16778239|AS|CN|FJ|FZ||x|0|China|CN|0|0"


def _write(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)


def test_load_and_report(spark, folder):
    logs, rules, table, out = folder("logs"), folder("rules"), folder("event_log"), folder("out")
    _write(spark, rules, RULE)
    request = "/log.gif?en={}&uid={}&sid={}&pl={}"
    _write(
        spark,
        f"{logs}/2024/01/01",
        f"1.0.1.1|{MS}|h|" + request.format("e_l", "u", "s", "pc"),
        f"1.0.1.1|{MS + 5000}|h|" + request.format("e_bp", "u", "s", "pc") + "&pid=9",
        f"1.0.1.1|{MS + 6000}|h|" + request.format("e_pv", "v", "t", "ios"),
        "junk",
    )
    # The next day's files bring a late line of the first day.
    _write(
        spark,
        f"{logs}/2024/01/02",
        f"9.9.9.9|{MS + 7000}|h|" + request.format("e_pv", "v", "t", "ios"),
        f"9.9.9.9|{MS + 86400000}|h|" + request.format("e_pv", "v", "t2", "ios"),
    )
    with pytest.raises(MissingLogs):
        run_etl(spark, logs, rules, table, dt.date(2024, 1, 3))
    for _ in range(2):
        counts = run_etl(spark, logs, rules, table, D1)
        assert counts == {"n_input": 4, "n_filtered": 1, "n_incomplete": 0}
    left_out = spark.read.parquet(f"{table}__rejected").select("value", "reason").collect()
    assert [tuple(r) for r in left_out] == [("junk", "no four fields")]
    run_etl(spark, logs, rules, table, D2)
    assert read_event_log(spark, table, D1).count() == 4
    assert read_event_log(spark, table, D2).count() == 1

    for day in (D1, D2, D1):
        run_daily(spark, table, out, day)

    def rows(name):
        return spark.read.parquet(f"{out}/{name}")

    dims = load_dims(spark, f"{out}/dims")
    # A new version comes with new keys only; the third run brought none.
    assert storage.children(spark, f"{out}/dims/date") == ["version=0", "version=1"]
    assert {r.calendar: r.id for r in dims["date"].collect()} == {"2024-01-01": 1, "2024-01-02": 2}
    assert {r.platform_name for r in dims["platform"].collect()} == {"all", "ios", "pc"}
    names = {r.id: r.platform_name for r in dims["platform"].collect()}
    measures = ("active_users", "new_install_users", "session_count", "session_length")
    found = {
        (r.created, names[r.platform_dimension_id]): tuple(r[m] for m in measures)
        for r in rows("stats_user").collect()
    }
    assert found == {
        ("2024-01-01", "all"): (2, 1, 2, 1),
        ("2024-01-01", "pc"): (1, 1, 1, 1),
        ("2024-01-01", "ios"): (1, 0, 1, 2),
        ("2024-01-02", "all"): (1, 0, 1, 1),
        ("2024-01-02", "ios"): (1, 0, 1, 1),
    }
    top = rows("area_top3_product").collect()
    assert [(r.product_id, r.browser_product_count, r.city_infos) for r in top] == [(9, 1, "FZ")]
    assert rows("session_aggr_stat").count() == 5
    assert rows("stats_device_location").where("created = '2024-01-02'").count() == 6
    assert rows("stats_event").where("created = '2024-01-02'").count() == 4


def test_parse_day():
    assert parse_day("2024-02-29") == dt.date(2024, 2, 29)
    for text in ("2024-2-29", "2023-02-29", "0000-01-01", "2024/01/01", "", "20240101"):
        with pytest.raises(ValueError):
            parse_day(text)


def test_the_load_reads_and_judges_lines_once(spark, folder, monkeypatch):
    from footfall.plans import etl

    logs, rules, table = folder("logs"), folder("rules"), folder("event_log")
    _write(spark, rules, RULE)
    good = f"1.0.1.1|{MS}|h|/log.gif?en=e_l&uid=u"
    bad = [f"1.0.1.1|{'9' * 17}|h|/log.gif?en=e_l&uid=u", "junk", f"1.0.1.1|{MS}|h|/log.gif?uid=u"]
    _write(spark, f"{logs}/2024/01/01", good, *bad, "junk")
    reads, real = [], etl.read_logs
    monkeypatch.setattr(etl, "read_logs", lambda *args: reads.append(args) or real(*args))
    counts = etl.run_etl(spark, logs, rules, table, D1)
    assert len(reads) == 1
    assert counts == {"n_input": 5, "n_filtered": 2, "n_incomplete": 2}
    left_out = spark.read.parquet(f"{table}__rejected").select("value", "reason").collect()
    reasons = ["bad time", "no four fields", "no event"]
    assert sorted(map(tuple, left_out)) == sorted([*zip(bad, reasons), ("junk", "no four fields")])
    (row,) = read_event_log(spark, table, D1).collect()
    assert (row.uid, row.en, row.country) == ("u", "e_l", "CN")
    assert storage.children(spark, f"{table}__staging") == []
