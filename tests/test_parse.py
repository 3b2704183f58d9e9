import datetime as dt

from pyspark.sql import Observation

from footfall.operators import parse
from footfall.operators.parse import enrich
from footfall.schemas import IP_RULES

RULES = [(16777472, 16778239, "中国", "福建", ""), (16778240, 16779263, "中国", "福建", "厦门")]
DAY = 1556150400000


def _lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def _rules(spark):
    return spark.createDataFrame(RULES, IP_RULES)


def test_lines_need_four_fields(spark):
    dropped = ("", "   ", "a|b|c|", "a|b|c", "a|b|c|d|e")
    lines = _lines(spark, *dropped, "1.0.1.1|5|x|/l?a=1", "1.0.1.1|5||/l|", "|||x")
    rows = parse.parse_log(lines).select("ip", "access_time", "request", "params").collect()
    assert sorted(tuple(r)[:3] for r in rows) == [
        ("", "", "x"),
        ("1.0.1.1", "5", "/l"),
        ("1.0.1.1", "5", "/l?a=1"),
    ]
    assert {r.request: r.params for r in rows}["/l?a=1"] == {"a": "1"}


def test_enrich(spark):
    lines = _lines(
        spark,
        f"1.0.1.0|{DAY}|h|/l?uid=u&en=e_l",
        f"1.0.3.255|{DAY}|h|/l?uid=u&en=e_pv&sid=s&pl=pc&x=1",
        f"1.0.4.0|{DAY}|h|/l?uid=u&en=e_bp&pid=7&country=Own&ip=Mine",
        f"1.0.0.255|{DAY}|h|/l?uid=u&en=e_s&city=There",
        f"broken|{DAY}|h|/l?uid=u&en=e_x&access_time={DAY + 1}",
    )
    rows = {r.en: r for r in enrich(lines, _rules(spark)).collect()}
    assert (rows["e_l"].country, rows["e_l"].province, rows["e_l"].city) == ("中国", "福建", "")
    assert (rows["e_pv"].city, rows["e_pv"].sid, rows["e_pv"].params) == ("", "s", {"x": "1"})
    assert (rows["e_bp"].country, rows["e_bp"].city, rows["e_bp"].ip) == ("Own", "厦门", "Mine")
    assert rows["e_bp"].pid == "7" and rows["e_bp"].params == {}
    assert (rows["e_s"].country, rows["e_s"].city) == ("unknown", "There")
    assert rows["e_x"].country == "unknown" and rows["e_x"].access_time_ms == DAY + 1
    assert rows["e_l"].dt == dt.date(2019, 4, 25) and rows["e_l"].sid is None


def test_counts(spark):
    lines = _lines(
        spark,
        "junk",
        "",
        f"1.0.1.0|{DAY}|h|/l?uid=u&en=e_l",
        f"1.0.1.0|{DAY}|h|/l?uid=u",
        f"1.0.1.0|{DAY}|h|/l?en=e_l",
        "1.0.1.0|yesterday|h|/l?uid=u&en=e_l",
        "1.0.1.0|9223372036854775807|h|/l?uid=u&en=e_l",
        f"1.0.1.0|later|h|/l?uid=u&en=e_l&access_time={DAY}",
    )
    counts = Observation("counts")
    kept = enrich(lines, _rules(spark), counts)
    assert kept.count() == 2
    assert counts.get == {"n_input": 8, "n_filtered": 2, "n_incomplete": 4}
    assert enrich(lines, _rules(spark)).count() == 2
    reasons = sorted(r.reason for r in parse.rejected(lines).collect())
    assert reasons == ["bad time"] * 2 + ["no event", "no four fields", "no four fields", "no uid"]
    assert {r.value for r in parse.rejected(lines).collect()} >= {"junk", ""}


def test_product_views(spark):
    df = spark.createDataFrame(
        [("e_bp", "1"), ("e_bp", " "), ("e_bp", None), ("e_pv", "1")], "en string, pid string"
    )
    assert [tuple(r) for r in parse.filter_product_views(df).collect()] == [("e_bp", "1")]


def test_union_keeps_duplicates(spark):
    a, b = _lines(spark, "x", "y"), _lines(spark, "x")
    assert sorted(r.value for r in parse.union_streams(a, b, b).collect()) == ["x", "x", "x", "y"]
