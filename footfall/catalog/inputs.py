"""Log lines, IP rules and other inputs derived from the given tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import storage
from footfall.functions import build_query_string
from footfall.operators.geo import ip_region_join
from footfall.operators.parse import enrich
from footfall.session import importable, work_dir
from footfall.sources.growing import Place

BATCHES = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dotted(number: str) -> Column:
    parts = [F.shiftright(number, shift).bitwiseAND(F.lit(255)) for shift in (24, 16, 8, 0)]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def tracked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events as a tracker would report them."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    day_ms = F.unix_millis(F.col("dt").cast("timestamp"))
    address = (
        F.lit(16777216).cast("bigint")
        + F.col("c_nationkey") * 65536
        + (F.col("user_id") % 4) * 16384
        + F.col("event_id") % 16384
    )
    return (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .withColumn("dt", F.to_date("ts"))
        .select(
            "event_id",
            "user_id",
            F.col("user_id").cast("string").alias("uid"),
            "dt",
            F.concat_ws("-", "user_id", F.date_format("dt", "yyyy-MM-dd")).alias("sid"),
            (day_ms + F.call_function("div", ms - day_ms, F.lit(25))).alias("access_time_ms"),
            F.when(F.col("event_type") == "signup", "e_l")
            .when(F.col("event_type") == "view", "e_pv")
            .when(F.col("event_type") == "click", "e_bp")
            .when(F.col("event_type") == "purchase", "e_ba")
            .otherwise("e_s")
            .alias("en"),
            F.when(F.col("user_id") % 3 == 0, "pc")
            .when(F.col("user_id") % 3 == 1, "ios")
            .otherwise("android")
            .alias("pl"),
            F.when(
                F.col("event_type") == "click", F.get_json_object("props", "$.k")
            ).alias("pid"),
            F.when(
                F.col("event_id") % 50 == 0, F.lit(3232235520) + F.col("event_id") % 256
            )
            .otherwise(address)
            .alias("ip_num"),
        )
        .withColumn("ip", _dotted("ip_num"))
    )


# The parameters in the order the tracker sends them.
PARAMS = ("en", "uid", "sid", "pl", "pid")


def _as_map(pairs: list[tuple[str, Column]]) -> Column:
    entries = [F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in pairs]
    return F.map_from_entries(F.array(*entries))


def params_of(events: DataFrame, **extra: Column) -> Column:
    """Parameters in the order the tracker sends them; those without a value are left out."""
    return _as_map([*[(n, F.col(n)) for n in PARAMS], *extra.items()])


def with_query(events: DataFrame) -> DataFrame:
    """Events with their parameters written out, for :func:`log_lines`."""
    return events.withColumn("query", build_query_string(params_of(events)))


def log_lines(events: DataFrame, **extra: Column) -> DataFrame:
    """One raw line per event; some lack a field and are no record.

    ``extra`` are more parameters behind the usual ones, with names of their own. Events may come
    from :func:`with_query`, so that lines that differ in them are not written out from the start.
    """
    host = F.when(F.col("event_id") % 97 != 0, "www.example.com")
    written = events if "query" in events.columns else with_query(events)
    queries = [F.col("query")]
    if extra:
        queries.append(build_query_string(_as_map(list(extra.items()))))
    query = F.concat_ws("&", *[F.nullif(q, F.lit("")) for q in queries])
    request = F.concat(F.lit("/log.gif?"), query)
    line = F.concat_ws("|", "ip", F.col("access_time_ms").cast("string"), host, request)
    return written.select("event_id", line.alias("value"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(tracked_events(spark, sf_dir)).select("value")


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines, where some events also lack their user, their type or a proper time."""
    events = tracked_events(spark, sf_dir)
    number = F.col("event_id")
    broken = F.when(number % 89 == 0, "9" * 17).when(number % 83 == 0, "soon")
    faulty = events.select(
        *[c for c in events.columns if c not in ("uid", "en", "access_time_ms")],
        F.when(number % 101 != 0, F.col("uid")).alias("uid"),
        F.when(number % 103 != 0, F.col("en")).alias("en"),
        F.coalesce(broken, F.col("access_time_ms").cast("string")).alias("access_time_ms"),
    )
    return log_lines(faulty).select("value")


def ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four ranges per nation; the last one is missing."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    start = (
        F.lit(16777216).cast("bigint") + F.col("n_nationkey") * 65536 + F.col("part") * 16384
    )
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .where(~((F.col("n_nationkey") == 24) & (F.col("part") == 3)))
        .select(
            start.alias("start_num"),
            (start + 16383).alias("end_num"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("province"),
            F.concat_ws("_", F.lit("CITY"), "n_nationkey", "part").alias("city"),
        )
    )


def rule_lines(rules: DataFrame) -> DataFrame:
    """Rules in the text form of the rule file: 15 fields."""
    blank = F.lit("")
    return rules.select(
        F.concat_ws(
            "|",
            _dotted("start_num"),
            _dotted("end_num"),
            F.col("start_num").cast("string"),
            F.col("end_num").cast("string"),
            F.lit("continent"),
            "country",
            "province",
            "city",
            blank,
            F.lit("isp"),
            F.lit("0"),
            "country",
            F.lit("XX"),
            F.lit("0.0"),
            F.lit("0.0"),
        ).alias("value")
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records parsed from the raw lines, with their regions."""
    return enrich(lines(spark, sf_dir), ip_rules(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records without the way over text: what the reports find in the event table.

    Events whose line lacks a field never get there.
    """
    events = tracked_events(spark, sf_dir).where(F.col("event_id") % 97 != 0)
    named = events.select(
        "ip",
        F.col("access_time_ms").cast("string").alias("access_time"),
        "uid",
        "sid",
        "en",
        "pl",
        "pid",
        F.lit(None).cast("string").alias("b_n"),
        F.lit(None).cast("string").alias("os_n"),
        "access_time_ms",
        "dt",
    )
    return ip_region_join(named, ip_rules(spark, sf_dir))


def saved(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut.

    With ``rows`` no file has more, so that the files can be dealt out evenly."""
    path = work_dir(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_stream_files(df: DataFrame, path: str) -> int:
    """Write lines as text files and give the number of files to read at a time."""
    spark = df.sparkSession
    df.repartition(max(BATCHES, spark.sparkContext.defaultParallelism)).write.mode("append").text(
        path
    )
    files = [n for n in storage.children(spark, path) if n.startswith("part-")]
    return max(1, -(-len(files) // BATCHES))


def in_slices(df: DataFrame, number: Column, name: str) -> str:
    """Rows stored by slice ``number``, so that each slice is read without the others."""
    path = work_dir(df.sparkSession, name)
    df.withColumn("slice", number.cast("int")).write.partitionBy("slice").parquet(path)
    return path


def add_slice(spark: SparkSession, slices: str, number: int, target: str) -> None:
    """Append the ``value`` of one slice to a folder of text files, by several tasks."""
    rows = spark.read.parquet(slices).where(F.col("slice") == number)
    rows.select("value").write.mode("append").text(target)


def visits_in_slices(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Lines ``uid|event|time`` in slices of sixteen days, cut at 0:29, when there are visits.

    Half of the events of the last ten minutes of a slice come with the next one. The last slice
    is one event of nobody, long after all others. Gives the path and the number of slices.
    """
    events = tracked_events(spark, sf_dir)
    since = F.col("access_time_ms") - F.lit(1704067200000 + 29 * 60_000)
    length = F.lit(16 * 86_400_000)
    late = (F.pmod(since, length) >= length - 600_000) & (F.col("event_id") % 2 == 1)
    number = F.greatest(F.lit(0), F.floor(since / length) + late.cast("int")) + 0
    fields = ["uid", F.col("event_id").cast("string"), F.col("access_time_ms").cast("string")]
    lines = events.select(F.concat_ws("|", *fields).alias("value"), number.alias("at"))
    end = spark.range(1).select(F.lit("nobody|-1|4102444800000").alias("value"), F.lit(3).alias("at"))
    return in_slices(lines.union(end), F.col("at"), "visits"), 4


def grow_files(df: DataFrame, path: str, step: int) -> None:
    """Bring the files ``<file>.log`` of a folder to what they hold after ``step``.

    ``df`` has (value, file, step, event_id). Each file is one task's: it writes the lines up to
    this step beside it, which begin with those that are there, and puts them in its place. So a
    task that runs again does no harm.
    """

    def write(rows) -> None:
        place, out, name = Place.of(path), None, None
        for row in rows:
            if row.file != name:
                if out:
                    out.close()
                    place.system.move(f"{place.folder}/_{name}", f"{place.folder}/{name}.log")
                name = row.file
                out = place.system.open_output_stream(f"{place.folder}/_{name}")
            out.write(row.value.encode() + b"\n")
        if out:
            out.close()
            place.system.move(f"{place.folder}/_{name}", f"{place.folder}/{name}.log")

    importable(df.sparkSession)
    place = Place.of(path)
    place.system.create_dir(place.folder)
    now = df.where(F.col("step") <= step).repartition("file")
    now.sortWithinPartitions("file", "step", "event_id").foreachPartition(write)


def move_files(spark: SparkSession, folder: str, prefix: str) -> None:
    """Move the data files of a folder to ``<prefix>-<number>.log``, and remove the folder.

    Compressed files keep the ending by which they are read."""
    names = [n for n in storage.children(spark, folder) if n.startswith("part-")]
    for i, name in enumerate(sorted(names)):
        packed = ".gz" if name.endswith(".gz") else ""
        storage.move(spark, f"{folder}/{name}", f"{prefix}-{i:05d}.log{packed}")
    storage.remove(spark, folder)
