import datetime as dt
import time
from decimal import ROUND_HALF_UP, Decimal
from urllib.parse import quote, unquote_plus

import pytest
from pyspark.sql import functions as F

from footfall import functions as fn
from footfall.functions.measures import TIES_BELOW

SUMMARY = (
    "session_count=1025|1s_3s=577|4s_6s=1|7s_9s=3|10s_30s=7|30s_60s=23|1m_3m=83|3m_10m=331"
    "|10m_30m=0|30m=0|1_3=890|4_6=72|7_9=29|10_30=33|30_60=1|60=0"
)


def test_ip_to_long(evaluate):
    cases = {
        "1.0.1.0": 16777472,
        "255.255.255.255": 4294967295,
        "0.0.0.1": 1,
        "1.2": 258,
        "1.2.3.4.": 16909060,
        "1.2.3.4.5": (16909060 << 8) | 5,
        "300.0.0.1": (300 << 24) | 1,
        "1.2.x.4": None,
        "1..3.4": None,
        "": None,
        "fe80::1": None,
        "x.1.2.3.4.5.6.7.8.9": None,
        None: None,
    }
    assert evaluate(fn.ip_to_long("x"), cases) == list(cases.values())


def test_is_not_blank(evaluate):
    values = ["a", " a ", "", " \t", "　", None]
    assert evaluate(fn.is_not_blank("x"), values) == [True, True, False, False, False, False]


@pytest.mark.parametrize(
    "request_text, wanted",
    [
        ("/log.gif?a=1&b=2", {"a": "1", "b": "2"}),
        ("/log.gif?k=&a=1", {"a": "1"}),
        ("/log.gif?k=a=b&a=1", {"a": "1"}),
        ("/log.gif?k=a=&a=1", {"k": "a", "a": "1"}),
        ("/log.gif?k==a&a=1", {"a": "1"}),
        ("/log.gif?=v&a=1&&", {"a": "1"}),
        ("/log.gif?a=1&a=2", {"a": "2"}),
        ("/log.gif?a= &b=%20", {"b": " "}),
        ("/log.gif?a=1?b=2", {}),
        ("/log.gif?a=1??", {"a": "1"}),
        ("/log.gif?", {}),
        ("/log.gif", {}),
        ("?a=1", {"a": "1"}),
        ("/x?n%61me=a+b%26c", {"name": "a b&c"}),
        ("/x?a=%zz&b=1", {"b": "1"}),
        ("/x?a=%E4%B8%AD", {"a": "中"}),
        (None, {}),
    ],
)
def test_parse_query_string(evaluate, request_text, wanted):
    assert evaluate(fn.parse_query_string("x"), [request_text]) == [wanted]


def test_long_parameters_take_no_time(evaluate):
    request = "/l?" + "k" * 1000 + "=" + "v" * 6000 + "=" + "w" * 6000 + "&a=1"
    evaluate(fn.parse_query_string("x"), ["/l?a=1"])
    start = time.perf_counter()
    assert evaluate(fn.parse_query_string("x"), [request]) == [{"a": "1"}]
    assert time.perf_counter() - start < 5


def test_build_query_string(spark):
    pairs = {"a": "x y", "b": "", "c": "it's (1)~*!", "": "v", "d": "中&="}
    row = spark.createDataFrame([(pairs,)], "m map<string,string>").select(
        fn.build_query_string("m")
    )
    wanted = "&".join(
        f"{quote(k, safe='')}={quote(v, safe=chr(39) + '()*!~')}"
        for k, v in pairs.items()
        if k and v
    )
    assert row.first()[0] == wanted


def test_url_coding(evaluate):
    texts = ["a b", "+", "100%", "中文", "a'b(c)~!*", ""]
    coded = evaluate(fn.url_encode("x"), texts)
    assert coded == [quote(t, safe="'()~!*") for t in texts]
    assert evaluate(fn.url_decode("x"), coded) == texts
    assert evaluate(fn.url_decode("x"), ["a+b", "%zz", None]) == [unquote_plus("a+b"), None, None]


def test_summary_fields(evaluate):
    assert evaluate(fn.get_field("x", "session_count"), [SUMMARY, "", None]) == ["1025", None, None]
    assert evaluate(fn.get_field("x", "60"), [SUMMARY]) == ["0"]
    assert evaluate(fn.get_field("x", "3m"), [SUMMARY]) == [None]
    assert evaluate(fn.get_field("x", "a"), ["a=1|a=2", "b=1|a=", "a=1=2"]) == ["1", None, "1"]
    changed = evaluate(fn.set_field("x", "session_count", 190), [SUMMARY])[0]
    assert changed == SUMMARY.replace("1025", "190")
    assert evaluate(fn.set_field("x", "none", 1), [SUMMARY]) == [SUMMARY]
    assert evaluate(fn.set_field("x", "a", F.lit(5)), ["a=1|b=2|a=3|"]) == ["a=5|b=2|a=3"]


def test_platform(evaluate):
    agents = ["Mozilla (Android 9)", "Mozilla (iPhone)", "x iPhone Android", "android", "xxandroid"]
    wanted = ["android", "ios", "android", "pc", "android"]
    assert evaluate(fn.platform_from_user_agent("x"), agents) == wanted


def test_valid_date(evaluate):
    cases = {
        "2024-02-29": True,
        "2023-02-29": False,
        "2000-02-29": True,
        "1900-02-29": False,
        "0000-01-01": False,
        "0001-01-01": True,
        "2024-13-01": False,
        "2024-04-31": False,
        "2024-1-01": False,
        " 2024-01-01": False,
        "2024-01-01\n": False,
        "2024/01/01": False,
        None: False,
    }
    assert evaluate(fn.valid_date("x"), cases) == list(cases.values())


def test_dates(spark, evaluate):
    day_ms = 1556064000000
    assert evaluate(fn.parse_date_ms("x"), ["2019-04-24", "x"]) == [day_ms, None]
    assert evaluate(fn.format_ms("x", "yyyy/MM/dd"), [day_ms], "bigint") == ["2019/04/24"]
    assert evaluate(fn.next_day_ms("x"), [day_ms], "bigint") == [day_ms + 86400000]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        before = int(dt.datetime(2024, 3, 9, 17, tzinfo=dt.timezone.utc).timestamp() * 1000)
        # The clock goes forward that night: the next day at noon is 23 hours away.
        assert evaluate(fn.next_day_ms("x"), [before], "bigint") == [before + 23 * 3600000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _week(day: dt.date) -> int:
    """Sunday-first week number; the week with 1 January is week 1."""
    sunday = day - dt.timedelta(days=(day.weekday() + 1) % 7)
    if (sunday + dt.timedelta(days=6)).year > day.year:
        return 1
    first = dt.date(day.year, 1, 1)
    start = first - dt.timedelta(days=(first.weekday() + 1) % 7)
    return (sunday - start).days // 7 + 1


def test_date_parts(spark):
    first = dt.date(1999, 1, 1)
    days = [first + dt.timedelta(days=i) for i in range(0, 11500)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    parts = [v.alias(k) for k, v in fn.date_parts("d").items()]
    for row in df.select("d", *parts).collect():
        d = row.d
        wanted = (d.year, (d.month + 2) // 3, d.month, _week(d), d.day)
        assert (row.year, row.season, row.month, row.week, row.day) == wanted


def test_round_share_is_exact(spark):
    pairs = [(c, n) for n in range(1, 260) for c in range(n + 1)]
    pairs += [(29, 200), (2**40 + 1, 2**41), (0, 5)]
    df = spark.createDataFrame(pairs, "c bigint, n bigint")
    for c, n, share in df.select("c", "n", fn.round_share("c", "n")).collect():
        wanted = Decimal(c / n).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert share == float(wanted), (c, n)
    assert len(TIES_BELOW) == 48
    assert spark.range(1).select(fn.round_share(F.lit(0), F.lit(0))).first()[0] is None


def _java_hash(text: str) -> int:
    code = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        code = (code * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return code - 2**32 if code >= 2**31 else code


def test_row_key(evaluate):
    # The second text is known to hash to the smallest integer.
    texts = ["u1", "polygenelubricants", "", "中文😀"]
    assert evaluate(fn.java_string_hash("x"), texts) == [_java_hash(t) for t in texts]
    assert _java_hash("polygenelubricants") == -(2**31)
    keys = evaluate(fn.row_key(F.lit("7"), F.col("x"), F.lit("")), texts[:2])
    assert keys == [f"7_{abs(_java_hash('u1'))}", "7_-2147483648"]


def test_event_texts(evaluate):
    events = ["e_l", "e_pv", "e_bp", "e_ba", "all", "e_s", None]
    described = evaluate(fn.event_description("x"), events)
    assert described[4] == "所有事件" and described[5:] == [None, None]
    assert len(set(described[:5])) == 5
    groups = evaluate(fn.event_category("x"), events)
    assert groups[0] == groups[1] != groups[2] == groups[3] and groups[5:] == [None, None]


def test_city_concat(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "city string")
    assert df.select(fn.city_concat("city")).first()[0] == "a,b,null"


def test_parameters_are_taken_without_a_loop_over_parts(evaluate):
    blank = chr(0x3000)
    requests = {
        "/l?=a=1&b=2=&c==3&d=4==&=&&e= &f= 5&g=6": {"b": "2", "d": "4", "f": " 5", "g": "6"},
        f"/l?{blank}=1&a={blank}&b={chr(0xA0)}&c=\t=&d=1": {"b": chr(0xA0), "d": "1"},
        "/l?a=1&b=%zz&a=+2&c=%3D&%41=1": {"a": " 2", "c": "=", "A": "1"},
        "/l?a=1&b=2&a=3": {"a": "3", "b": "2"},
        "/l?" + "&".join(f"k{i}={i}" for i in range(20000)): {f"k{i}": str(i) for i in range(20000)},
        "/l?a=" + "b" * 200000: {"a": "b" * 200000},
        "/l?a=" + " " * 200000 + "&b=1": {"b": "1"},
    }
    parsed = fn.parse_query_string("x")
    assert evaluate(parsed, list(requests)) == list(requests.values())
    # A query without escapes is looked up by two patterns and not decoded.
    assert "regexp_extract_all" in str(parsed)


def test_address_from_its_parts(spark):
    addresses = ["1.2.3.4", "1.2.3.4.", "1.2", "1.2.3.4.5", "a.2.3.4", "256.0.0.1", "", None, "1..3.4"]
    df = spark.createDataFrame([(a,) for a in addresses], "ip string")
    parts = df.withColumn("parts", fn.ip_parts("ip"))
    for row in parts.select("ip", fn.ip_to_long("ip"), fn.parts_to_long("parts")).collect():
        assert row[1] == row[2], row.ip


def test_lines_of_events_with_written_parameters(spark):
    from footfall.catalog import inputs

    rows = [(1, "1.1.1.1", 5, "e_l", "u 1", None, "pc", "7"), (97, "1.1.1.1", 6, None, None, None, None, "")]
    names = "event_id bigint, ip string, access_time_ms bigint, en string, uid string, sid string"
    events = spark.createDataFrame(rows, f"{names}, pl string, pid string")
    written = inputs.with_query(events).select("event_id", "ip", "access_time_ms", "query")
    wanted = [
        "1.1.1.1|5|www.example.com|/log.gif?en=e_l&uid=u%201&pl=pc&pid=7&b_n=a%26",
        "1.1.1.1|6|/log.gif?b_n=a%26",
    ]
    for source in (events, written):
        lines = inputs.log_lines(source, b_n=F.lit("a&"), os_n=F.lit(None).cast("string"))
        assert [r.value for r in lines.orderBy("event_id").collect()] == wanted
