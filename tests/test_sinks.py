import datetime as dt

import pytest

from footfall import storage
from footfall.operators.geo import BadRules, check_rules
from footfall.schemas import EVENT_LOG, KNOWN_CELLS
from footfall.sinks import (
    console,
    jdbc_write_options,
    merge_cells,
    merge_partitions,
    merge_repeats,
    replace_day,
    upsert,
    write_event_log,
)
from footfall.sinks.tables import in_read_order
from footfall.sources import (
    MissingLogs,
    jdbc_options,
    kafka_options,
    read_event_log,
    read_ip_rules,
    read_logs,
)
from conftest import plan_of

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
MS = 1704067200000


def _records(spark, *rows):
    """Records given as (key, order, cells)."""
    from pyspark.sql import functions as F

    schema = "row_key string, seq bigint, cells map<string,string>"
    df = spark.createDataFrame(rows, schema)
    known = [F.col("cells")[c].alias(c) for c in KNOWN_CELLS]
    return df.select(
        "row_key",
        "seq",
        *known,
        F.map_filter("cells", lambda k, _: ~k.isin(*KNOWN_CELLS)).alias("params"),
        F.col("cells")["access_time"].cast("bigint").alias("access_time_ms"),
        F.to_date(F.timestamp_millis(F.col("cells")["access_time"].cast("bigint"))).alias("dt"),
    )


def _cells(row):
    out = {c: row[c] for c in KNOWN_CELLS if row[c] is not None}
    return out | row.params


def test_merge_cells(spark):
    t = {"access_time": str(MS)}
    rows = [
        ("a", 1, {**t, "pid": "1", "x": "1"}),
        ("a", 2, {**t, "b_n": "chrome", "x": "2"}),
        ("a", 3, {**t, "pid": "3", "x": "3"}),
        ("a", 0, {**t, "pid": "0", "y": "0"}),
        ("b", 9, {**t, "uid": ""}),
    ]
    out = {r.row_key: _cells(r) for r in merge_cells(_records(spark, *rows)).collect()}
    assert out["a"] == {**t, "pid": "3", "x": "3", "b_n": "chrome", "y": "0"}
    assert out["b"] == {**t, "uid": ""}


@pytest.mark.parametrize("broadcast_bytes", [10**6, 16])
def test_merge_repeats(spark, broadcast_bytes):
    rows = [
        (f"k{i % 40}", i, {"access_time": str(MS), f"p{i % 7}": str(i), "uid": str(i)})
        for i in range(60)
    ]
    records = _records(spark, *rows)
    wanted = {r.row_key: _cells(r) for r in merge_cells(records).collect()}
    out = merge_repeats(records, broadcast_bytes=broadcast_bytes).collect()
    assert len(out) == 40 and {r.row_key: _cells(r) for r in out} == wanted
    assert wanted["k3"] == {"access_time": str(MS), "p3": "3", "p1": "43", "uid": "43"}


def test_merge_cells_with_one_hot_key(spark):
    rows = [("hot", i, {"access_time": str(MS), f"p{i % 3}": str(i)}) for i in range(3000)]
    out = merge_cells(_records(spark, *rows)).collect()
    assert len(out) == 1
    assert out[0].params == {"p0": "2997", "p1": "2998", "p2": "2999"}


def test_event_log_upsert_keeps_other_rows(spark, folder):
    path, staging = folder("log"), folder("staging")
    day1, day2 = {"access_time": str(MS)}, {"access_time": str(MS + 86400000)}
    first = [("a", 5, {**day1, "uid": "u", "x": "1"}), ("b", 6, {**day1, "uid": "v"})]
    write_event_log(_records(spark, *first, ("c", 7, day2)), path, staging)
    # A later load with a smaller order still wins over what is stored.
    write_event_log(_records(spark, ("a", 0, {**day1, "uid": "w"})), path, staging)
    rows = spark.read.schema(EVENT_LOG).parquet(path).collect()
    assert {r.row_key: _cells(r) for r in rows} == {
        "a": {**day1, "uid": "w", "x": "1"},
        "b": {**day1, "uid": "v"},
        "c": day2,
    }
    assert {r.row_key: r.dt for r in rows} == {"a": D1, "b": D1, "c": D2}
    assert not storage.exists(spark, staging)
    one = read_event_log(spark, path, D1)
    assert one.count() == 2 and one.columns[0] == "uid"
    assert "PartitionFilters: [isnotnull(dt" in plan_of(one)
    assert "params" not in plan_of(one)


def _stats(spark, *rows):
    return spark.createDataFrame(list(rows), "dt date, k string, n bigint")


def _read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("dt", "k", "n").collect())


def test_replace_day(spark, folder):
    path = folder("t")
    _stats(spark, (D1, "a", 1), (D2, "a", 2)).write.partitionBy("dt").parquet(path)
    replace_day(_stats(spark, (D1, "b", 3)), path, D1)
    assert _read(spark, path) == [(D1, "b", 3), (D2, "a", 2)]
    replace_day(_stats(spark), path, D1)
    assert _read(spark, path) == [(D2, "a", 2)]


def test_replace_day_by_itself_and_after_a_failure(spark, folder):
    path = folder("t")
    _stats(spark, (D1, "a", 1), (D2, "a", 2)).write.partitionBy("dt").parquet(path)

    def own():
        table = spark.read.schema("k string, n bigint, dt date").parquet(path)
        return table.where("dt = '2024-01-01'")

    replace_day(own().selectExpr("k", "n + 10 AS n"), path, D1)
    assert _read(spark, path) == [(D1, "a", 11), (D2, "a", 2)]
    with pytest.raises(Exception, match="no such day"):
        replace_day(own().selectExpr("k", "raise_error('no such day') AS n"), path, D1)
    assert _read(spark, path) == [(D1, "a", 11), (D2, "a", 2)]
    assert storage.children(spark, f"{path}__staging") == []


def test_many_cell_names_for_one_key(spark):
    rows = [("hot", i, {"access_time": str(MS), f"p{i}": "x", "uid": str(i)}) for i in range(2000)]
    (out,) = merge_cells(_records(spark, *rows)).collect()
    assert len(out.params) == 2000 and out.uid == "1999"


def test_upsert(spark, folder):
    path = folder("t")
    upsert(_stats(spark, (D1, "a", 1), (D1, None, 2), (D2, "a", 3)), path, ["k"], folder("s0"))
    upsert(_stats(spark, (D1, None, 5), (D1, "b", 6)), path, ["k"], folder("s1"))
    assert set(map(tuple, spark.read.parquet(path).select("dt", "k", "n").collect())) == {
        (D1, "a", 1),
        (D1, None, 5),
        (D1, "b", 6),
        (D2, "a", 3),
    }


def test_an_interrupted_upsert_is_finished_and_not_repeated(spark, folder, monkeypatch):
    path, staging = folder("t"), folder("s")
    upsert(_stats(spark, (D1, "a", 1), (D2, "a", 1)), path, ["k"], folder("s0"))

    def add(old, new):
        both = old.unionByName(new) if old is not None else new
        return both.groupBy("dt", "k").sum("n").withColumnRenamed("sum(n)", "n")

    new = _stats(spark, (D1, "a", 10), (D2, "a", 10))
    real, calls = storage.move, []

    def fail_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(storage, "move", fail_second)
    with pytest.raises(OSError):
        merge_partitions(new, path, add, staging, once=True)
    assert sorted(n for *_, n in _read(spark, path)) == [1, 11]
    monkeypatch.setattr(storage, "move", real)
    for _ in range(2):
        merge_partitions(new, path, add, staging, once=True)
        assert _read(spark, path) == [(D1, "a", 11), (D2, "a", 11)]


def test_read_logs(spark, folder):
    root = folder("logs")
    with pytest.raises(MissingLogs):
        read_logs(spark, root, D1)
    spark.createDataFrame([("x",)], "value string").write.text(f"{root}/2024/01/01")
    assert [r.value for r in in_read_order(read_logs(spark, root, D1)).collect()] == ["x"]


def test_read_ip_rules(spark, folder):
    # Fixed value: a line as the rule file has them.
    line = (
        "1.0.1.0|1.0.3.255|16777472|16778239|亚洲|中国|福建|福州||电信|350100|China|CN|119.3|26.0"
    )
    lines = [line, line.replace("福州", ""), "short|line"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder("rules"))
    rules = read_ip_rules(spark, folder("rules"))
    with pytest.raises(BadRules, match="1 lines"):
        check_rules(rules)
    rows = sorted(tuple(r) for r in rules.where("start_num is not null").collect())
    assert rows == [
        (16777472, 16778239, "中国", "福建", ""),
        (16777472, 16778239, "中国", "福建", "福州"),
    ]


def test_jdbc_options():
    text = "select * from t where a = ? and b = '?' and c = ?"
    options = jdbc_options("jdbc:x", text, ["o'b", 3])
    assert options["query"] == "select * from t where a = 'o''b' and b = '?' and c = 3"
    split = jdbc_options(
        "jdbc:x", "select 1", partition_column="id", lower=0, upper=9, partitions=3
    )
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "3"
    marks = "select '?' -- ?\n, `?`, \"?\" /* ? */ where a = ?"
    assert jdbc_options("jdbc:x", marks, [None])["query"] == marks[:-1] + "NULL"
    for bad in ("x\\' or 1=1 -- ", "a\nb", float("nan"), float("inf")):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", "select ?", [bad])
    for params in ([], [1, 2]):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", "select ?", params)
    assert jdbc_write_options("jdbc:x", "t", 50, user="u") == {
        "url": "jdbc:x",
        "dbtable": "t",
        "batchsize": "50",
        "isolationLevel": "READ_COMMITTED",
        "user": "u",
    }


def test_kafka_options():
    options = kafka_options("a:1", ["t", "u"], reset="smallest", max_offsets_per_trigger=10)
    assert options == {
        "kafka.bootstrap.servers": "a:1",
        "subscribe": "t,u",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka_options("a:1", "t")["startingOffsets"] == "latest"


def test_console(spark, capfd):
    console(_stats(spark, (D1, "shown", 1)))
    assert "shown" in capfd.readouterr().out


def test_records_with_the_same_cells_are_combined_before_the_shuffle(spark):
    from footfall.schemas import EVENT_LOG
    from footfall.sinks.tables import merge_cells

    cells = {name: None for name in EVENT_LOG.names}

    def record(seq, params, **known):
        return {**cells, "row_key": "k", "access_time": "1704067200000", "params": params, **known, "seq": seq}

    rows = [
        record(5, {"a": "5"}, uid="late"),
        record(1, {"a": "1", "b": "1"}, uid="early", pid="p1"),
        record(2, {"a": "2", "b": None}, uid="second", pid="p2"),
        record(3, {"a": "3"}, uid="third"),
        record(4, None, sid="s4"),
    ]
    frame = spark.createDataFrame(rows, f"{EVENT_LOG.simpleString()[7:-1]},seq:bigint")
    merged = merge_cells(frame)
    row = merged.collect()[0]
    assert (row.uid, row.pid, row.sid, row.params) == ("late", "p2", "s4", {"a": "5", "b": None})
    assert merged.count() == 1
    before_shuffle = merged._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "Generate" not in before_shuffle


def test_records_with_the_same_cells_are_merged_whole(spark):
    t = {"access_time": str(MS)}
    same = [(f"k{i % 40}", i, {**t, "x": str(i), "uid": str(i)}) for i in range(120)]
    mixed = [("m", 1, {**t, "pid": "1", "x": "1"}), ("m", 2, {**t, "b_n": "b", "x": "2"})]
    for rows in (same, same + mixed):
        records = _records(spark, *rows)
        wanted = {r.row_key: _cells(r) for r in merge_cells(records).collect()}
        for broadcast_bytes in (10**6, 100):
            out = merge_repeats(records, broadcast_bytes=broadcast_bytes)
            assert {r.row_key: _cells(r) for r in out.collect()} == wanted
            assert out.count() == len(wanted)
            # Only keys with several sets of cells are merged cell by cell.
            assert ("collect_list" in plan_of(out)) == (rows != same)
    assert wanted["m"] == {**t, "pid": "1", "b_n": "b", "x": "2"}
    assert wanted["k3"] == {**t, "uid": "83", "x": "83"}


def test_whole_merge_shuffles_once(spark):
    rows = [(f"k{i % 40}", i, {"access_time": str(MS), "uid": str(i)}) for i in range(120)]
    out = merge_repeats(_records(spark, *rows), broadcast_bytes=100)
    assert plan_of(out).count("Exchange hashpartitioning") == 1
    assert {r.row_key: r.uid for r in out.collect()} == {f"k{i}": str(80 + i) for i in range(40)}
