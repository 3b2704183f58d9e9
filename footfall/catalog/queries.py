"""One query per operator. Each takes (spark, folder of the tables) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import functions as fn
from footfall import storage
from footfall.catalog import inputs
from footfall.operators import dims, parse, periods, products, reports, sessions, words
from footfall.operators.geo import ip_region_join
from footfall.operators.visits import visit_grain
from footfall.plans.daily import daily_reports, empty_dims, extend_dims, load_dims
from footfall.plans.etl import run_etl
from footfall.plans.flow import keep_rejected, run_flow
from footfall.schemas import LOG_COLUMNS, REGION_COLUMNS
from footfall.session import configure, work_dir
from footfall.sinks import land_stream, replace_day, upsert, write_event_log
from footfall.sources import (
    read_event_log,
    read_ip_rules,
    read_landed,
    read_logs,
    stream_growing_files,
    stream_text_dir,
)
from footfall.streaming.control import state_settings
from footfall.streaming.flow import read_flow, restate_flow, stream_location_flow
from footfall.streaming.visits import stream_first_visits as first_visits_of_stream
from footfall.streaming.visits import stream_sessionize
from footfall.streaming.words import (
    read_batch_counts,
    read_running_counts,
    start_batch_word_count,
    start_running_word_count,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCHES = inputs.BATCHES
# Rows of a file that cannot be cut, so that tasks get about the same.
FILE_ROWS = 250_000
# The days the given events fall in.
FIRST_DAY, LAST_DAY = date(2024, 1, 1), date(2024, 2, 1)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    run.__name__ = f.__name__
    run.__doc__ = f.__doc__
    QUERIES[f.__name__] = run
    return run


# Sources


@query
def ip_rules(spark, sf_dir):
    path = work_dir(spark, "rules")
    inputs.rule_lines(inputs.ip_rules(spark, sf_dir)).write.text(path)
    return read_ip_rules(spark, path)


@query
def raw_log_day(spark, sf_dir):
    """The lines of one folder, counted per field count."""
    root, day = work_dir(spark, "logs"), date(2024, 1, 31)
    inputs.lines(spark, sf_dir).write.text(f"{root}/{day:%Y/%m/%d}")
    fields = F.size(F.split("value", "[|]"))
    return (
        read_logs(spark, root, day)
        .groupBy(fields.alias("n_fields"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("n_chars"))
    )


@query
def event_log_scan(spark, sf_dir):
    path = work_dir(spark, "event_log")
    records = parse.with_row_key(inputs.event_log(spark, sf_dir))
    records.write.partitionBy("dt").parquet(path)
    return read_event_log(spark, path, FIRST_DAY, LAST_DAY)


# Parsing


@query
def parsed_lines(spark, sf_dir):
    return parse.parse_log(inputs.lines(spark, sf_dir)).select("ip", "access_time", "request")


@query
def log_params(spark, sf_dir):
    parsed = parse.parse_log(inputs.lines(spark, sf_dir))
    return parsed.select("access_time", F.explode("params").alias("name", "value"))


@query
def page_url_params(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", F.explode(fn.parse_query_string("url")).alias("name", "value")
    )


@query
def param_overrides(spark, sf_dir):
    """Lines of some events also send a city and an address of their own."""
    search = F.col("en") == "e_s"
    events = inputs.tracked_events(spark, sf_dir)
    lines = inputs.log_lines(
        events,
        city=F.when(search, F.concat(F.lit("Town & "), F.col("pl"))),
        ip=F.when(search & (F.col("pl") == "ios"), F.lit("own")),
    )
    records = parse.enrich(lines.select("value"), inputs.ip_rules(spark, sf_dir))
    return records.groupBy("en", "pl", *REGION_COLUMNS, (F.col("ip") == "own").alias("own")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def parse_counts(spark, sf_dir):
    """Lines read, lines that are no record, and records that cannot be stored."""
    return parse.judge_lines(inputs.faulty_lines(spark, sf_dir)).agg(*parse.line_counts())


@query
def rejected_lines(spark, sf_dir):
    """What is not stored, by reason."""
    rejected = parse.rejected(inputs.faulty_lines(spark, sf_dir))
    return rejected.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def event_log_projection(spark, sf_dir):
    return parse.project_event_log(inputs.event_log(spark, sf_dir))


@query
def product_views(spark, sf_dir):
    return parse.filter_product_views(inputs.event_log(spark, sf_dir)).select(
        "uid", "sid", "access_time", "pid", *REGION_COLUMNS
    )


@query
def valid_dates(spark, sf_dir):
    """Texts of which only some are dates, made of the order numbers."""
    orders = inputs.table(spark, sf_dir, "orders")
    text = F.concat_ws(
        "-",
        F.lpad((F.col("o_orderkey") % 2100).cast("string"), 4, "0"),
        F.lpad((F.col("o_custkey") % 14).cast("string"), 2, "0"),
        F.lpad((F.col("o_orderkey") % 33).cast("string"), 2, "0"),
    )
    return orders.select("o_orderkey", text.alias("text"), fn.valid_date(text).alias("valid"))


@query
def location_level_counts(spark, sf_dir):
    out = reports.explode_levels(inputs.records(spark, sf_dir))
    return out.withColumnRenamed("pl", "platform")


# Joins and dimensions


@query
def ip_regions(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir).select("event_id", "ip")
    return ip_region_join(events, inputs.ip_rules(spark, sf_dir))


@query
def ip_regions_sweep(spark, sf_dir):
    """The same with nothing broadcast, and a third of the lines from one address."""
    events = inputs.tracked_events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 3 == 0, "1.4.0.9").otherwise(F.col("ip")).alias("ip")
    )
    return ip_region_join(events, inputs.ip_rules(spark, sf_dir), broadcast_bytes=0)


def _location_facts(spark, sf_dir):
    return reports.location_flow(visit_grain(inputs.records(spark, sf_dir), REGION_COLUMNS))


@query
def location_dimension(spark, sf_dir):
    """Locations of the reports added to a dimension that already holds the provinces."""
    nation = inputs.table(spark, sf_dir, "nation")
    region = inputs.table(spark, sf_dir, "region")
    known = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("country"),
        F.col("n_name").alias("province"),
        F.lit("all").alias("city"),
    )
    empty = empty_dims(spark)["location"]
    held = dims.get_or_create_dim(known, empty, dims.LOCATION_KEYS)
    facts = inputs.saved(_location_facts(spark, sf_dir), "location_flow")
    return dims.get_or_create_dim(facts, held, dims.LOCATION_KEYS)


@query
def date_dimension(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    rows = dims.date_rows(orders.select(F.to_date("o_orderdate").alias("dt")))
    return dims.get_or_create_dim(rows, empty_dims(spark)["date"], dims.DATE_KEYS)


@query
def platform_dimension(spark, sf_dir):
    stats = reports.event_stats(inputs.records(spark, sf_dir))
    rows = dims.platform_rows(stats)
    return dims.get_or_create_dim(rows, empty_dims(spark)["platform"], dims.PLATFORM_KEYS)


@query
def event_dimension(spark, sf_dir):
    stats = reports.event_stats(inputs.records(spark, sf_dir))
    rows = dims.event_rows(stats)
    return dims.get_or_create_dim(rows, empty_dims(spark)["event"], dims.EVENT_KEYS)


# Reports on natural keys


@query
def session_metrics(spark, sf_dir):
    events = inputs.records(spark, sf_dir)
    return reports.session_metrics(visit_grain(events, ("pl",), ("sid",)))


@query
def session_shares(spark, sf_dir):
    events = inputs.records(spark, sf_dir)
    return reports.session_aggr_stat(visit_grain(events, ("pl",), ("sid",)))


@query
def session_summaries(spark, sf_dir):
    events = inputs.records(spark, sf_dir)
    return reports.session_summary(visit_grain(events, ("pl",), ("sid",)))


@query
def user_stats(spark, sf_dir):
    return reports.user_stats(visit_grain(inputs.event_log(spark, sf_dir), ("pl",)))


def _stored_days(spark, sf_dir, dims_, levels):
    """Bitmaps of days, stored in two loads: the second one meets known and new ids."""
    path, numbers = work_dir(spark, "days"), {"uid": None, "sid": None}
    visits = inputs.saved(visit_grain(inputs.records(spark, sf_dir), dims_), "visits")
    for early in (True, False):
        part = visits.where((F.col("dt") < "2024-01-16") == early)
        for name in numbers:
            grown = periods.number_ids(part, numbers[name], name)
            numbers[name] = inputs.saved(grown, f"numbers-{name}")
        days = periods.daily_bitmaps(part, numbers["uid"], numbers["sid"], dims_, levels)
        days.write.mode("append").partitionBy("dt").parquet(path)
    return spark.read.parquet(path)


@query
def user_stats_by_month(spark, sf_dir):
    days = _stored_days(spark, sf_dir, ("pl",), reports.PLATFORM_LEVELS)
    return periods.user_stats_of(days, "month")


@query
def location_flow_by_week(spark, sf_dir):
    days = _stored_days(spark, sf_dir, REGION_COLUMNS, reports.LOCATION_LEVELS)
    return periods.location_flow_of(days, "week", REGION_COLUMNS)


@query
def device_location_stats(spark, sf_dir):
    return reports.device_location_stats(visit_grain(inputs.records(spark, sf_dir)))


@query
def event_stats(spark, sf_dir):
    return reports.event_stats(inputs.records(spark, sf_dir))


@query
def location_flow(spark, sf_dir):
    return _location_facts(spark, sf_dir)


@query
def area_product_counts(spark, sf_dir):
    views = products.product_views(inputs.records(spark, sf_dir))
    return products.area_product_counts(views)


@query
def area_product_rollup(spark, sf_dir):
    views = products.product_views(inputs.records(spark, sf_dir))
    return products.area_product_rollup(products.area_product_counts(views))


@query
def area_top_products(spark, sf_dir):
    views = products.product_views(inputs.records(spark, sf_dir))
    counts = products.area_product_counts(views)
    return products.area_top_products(products.area_product_rollup(counts))


@query
def product_views_by_sql(spark, sf_dir):
    products.register_views(spark, inputs.records(spark, sf_dir))
    return spark.sql(products.ROLLUP_SQL)


@query
def word_count(spark, sf_dir):
    return words.word_count(inputs.table(spark, sf_dir, "documents"), "text")


@query
def union_word_count(spark, sf_dir):
    texts = [
        inputs.table(spark, sf_dir, name).select(F.col("text").alias("value"))
        for name in ("documents", "conversations", "benchmark")
    ]
    return words.word_count(parse.union_streams(*texts))


# Report tables with dimension ids


def _report(name: str):
    def run(spark, sf_dir):
        """The ids come from dimensions filled by this report alone."""
        events = inputs.records(spark, sf_dir)
        report = inputs.saved(daily_reports(events, visit_grain(events))[name], name)
        found = extend_dims(empty_dims(spark), [report])
        return dims.resolve_report_ids(report, found)

    run.__name__ = name
    query(run)


for _name in (
    "session_aggr_stat",
    "stats_user",
    "stats_device_location",
    "stats_event",
    "area_top3_product",
):
    _report(_name)


@query
def stats_location_flow(spark, sf_dir):
    report = inputs.saved(_location_facts(spark, sf_dir), "location_flow")
    return dims.resolve_report_ids(report, extend_dims(empty_dims(spark), [report]))


# Functions


@query
def ip_numbers(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir)
    return events.select("event_id", fn.ip_to_long("ip").alias("number"))


@query
def date_functions(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text")
    )
    ms = fn.parse_date_ms("text", "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        ms.alias("ms"),
        fn.format_ms(ms, "yyyy/MM/dd").alias("path"),
        fn.next_day_ms(ms).alias("next_ms"),
    )


@query
def date_units(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    units = [v.alias(k) for k, v in fn.date_parts("o_orderdate").items()]
    return orders.select("o_orderkey", *units)


@query
def summary_fields(spark, sf_dir):
    events = inputs.records(spark, sf_dir)
    texts = reports.session_summary(visit_grain(events, ("pl",), ("sid",)))
    return texts.select(
        "dt",
        "platform",
        fn.get_field("summary", "session_count").alias("session_count"),
        fn.get_field("summary", "30m").alias("over_30m"),
        fn.get_field("summary", "none").alias("none"),
        fn.set_field("summary", "1s_3s", "x").alias("edited"),
        fn.set_field("summary", "none", "x").alias("unchanged"),
    )


@query
def share_rounding(spark, sf_dir):
    """Share of returned items per part and order day, and shares that are ties."""
    items = inputs.table(spark, sf_dir, "lineitem")
    counts = items.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("part"), F.count(F.lit(1)).alias("whole")
    )
    ties = items.groupBy((F.col("l_partkey") % 201).alias("part")).agg(
        F.max(F.lit(200)).cast("bigint").alias("whole"), F.min("l_suppkey").alias("l_suppkey")
    )
    return counts.unionByName(ties).select(
        "l_suppkey", "part", "whole", fn.round_share("part", "whole").alias("share")
    )


@query
def row_keys(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir)
    return events.select("event_id", fn.row_key("access_time_ms", "uid", "en").alias("row_key"))


@query
def text_hashes(spark, sf_dir):
    conversations = inputs.table(spark, sf_dir, "conversations")
    return conversations.select("conv_id", "turn", fn.java_string_hash("text").alias("code"))


@query
def url_codec(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents")
    code = fn.url_encode("text")
    return documents.select(
        "doc_id", F.md5(code).alias("encoded"), (fn.url_decode(code) == F.col("text")).alias("same")
    )


@query
def blank_parts(spark, sf_dir):
    """Parts of the documents between single spaces, blank and not."""
    parts = inputs.table(spark, sf_dir, "documents").select(
        F.col("lang"), F.explode(F.split("text", " ")).alias("part")
    )
    return parts.groupBy("lang", fn.is_not_blank("part").alias("not_blank")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def user_agent_platforms(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 5
    agent = (
        F.when(kind == 0, F.concat(F.lit("Mozilla/5.0 (Linux; ANDROID 9) "), "event_type"))
        .when(kind == 1, F.concat(F.lit("Mozilla/5.0 (iPhone; OS 12) "), "event_type"))
        .when(kind == 2, F.concat(F.lit("android "), "event_type"))
        .when(kind == 3, F.concat(F.lit("Mozilla/5.0 (iPhone) Android "), "event_type"))
        .otherwise(F.concat(F.lit("Mozilla/5.0 (Windows NT) "), "event_type"))
    )
    return events.select("event_id", fn.platform_from_user_agent(agent).alias("platform"))


@query
def query_strings(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir)
    title = F.concat(F.lit("it's (a) day~ "), F.col("dt").cast("string"))
    sent = inputs.params_of(events, tt=title)
    return events.select("event_id", fn.build_query_string(sent).alias("text"))


# Sessions


@query
def sessionized_events(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir).select("event_id", "uid", "access_time_ms")
    return sessions.sessionize(events)


@query
def sessionized_visitors(spark, sf_dir):
    """The same where a third of the events name no user: those are in no session."""
    events = inputs.tracked_events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("uid")).alias("uid"),
        "access_time_ms",
    )
    return sessions.sessionize(events)


@query
def session_spans(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir).select("uid", "access_time_ms")
    return sessions.session_spans(events)


def _in_slices(spark, sf_dir, make):
    """What a stream made of visits has written when it was started once per slice of time."""
    source, table, checkpoint = (work_dir(spark, n) for n in ("visits", "visited", "checkpoint"))
    slices, number = inputs.visits_in_slices(spark, sf_dir)
    parts = F.split("value", "[|]")
    ms = parts[2].cast("bigint")
    for i in range(number):
        inputs.add_slice(spark, slices, i, source)
        visits = stream_text_dir(spark, source).select(
            parts[0].alias("uid"),
            parts[1].cast("bigint").alias("event_id"),
            ms.alias("access_time_ms"),
            F.timestamp_millis(ms).alias("event_ts"),
        )
        # Events come ten minutes late at the most.
        found = make(visits.withWatermark("event_ts", "11 minutes"))
        with state_settings(spark, spark.sparkContext.defaultParallelism):
            writer = found.writeStream.format("parquet").option("path", table)
            writer.option("checkpointLocation", checkpoint).trigger(
                availableNow=True
            ).start().awaitTermination()
    return spark.read.parquet(table).where("uid <> 'nobody'")


@query
def stream_session_spans(spark, sf_dir):
    """Sessions a stream has closed: a last event far ahead closes all of them."""
    return _in_slices(spark, sf_dir, sessions.stream_session_spans).select(
        "uid",
        F.unix_millis("session_start").alias("start_ms"),
        F.unix_millis("session_end").alias("end_ms"),
        "n_events",
    )


@query
def stream_sessionized_events(spark, sf_dir):
    """Each event with its session number, handed on as the watermark passes it."""
    found = _in_slices(spark, sf_dir, stream_sessionize).where("event_id IS NOT NULL")
    return found.select("event_id", "uid", "access_time_ms", "session_no")


@query
def stream_ended_sessions(spark, sf_dir):
    """The sessions the same stream hands on by timers as they end."""
    found = _in_slices(spark, sf_dir, stream_sessionize).where("event_id IS NULL")
    return found.select("uid", "session_no", "start_ms", "end_ms", "n_events")


@query
def stream_first_visits(spark, sf_dir):
    return _in_slices(spark, sf_dir, first_visits_of_stream)


@query
def first_visits(spark, sf_dir):
    events = inputs.tracked_events(spark, sf_dir).select("event_id", "uid", "access_time_ms")
    return sessions.first_visit_flag(events)


# Sinks


@query
def event_log_upsert(spark, sf_dir):
    """Some events are sent again: without their product, with a browser name."""
    rules = inputs.ip_rules(spark, sf_dir)
    path = work_dir(spark, "event_log")
    events = inputs.tracked_events(spark, sf_dir)
    first = inputs.log_lines(events).select("value", F.col("event_id").alias("seq"))
    again = inputs.log_lines(
        events.where(F.col("event_id") % 100 == 1).withColumn("pid", F.lit(None).cast("string")),
        b_n=F.lit("chrome"),
    ).select("value", F.col("event_id").alias("seq"))
    for lines in (first, again):
        records = parse.with_row_key(parse.enrich(lines, rules))
        write_event_log(records, path, f"{path}__staging/load")
    table = spark.read.parquet(path)
    return table.select("row_key", *LOG_COLUMNS, "dt")


@query
def replaced_day(spark, sf_dir):
    """A day's partition is replaced by rows read from that very day."""
    path = work_dir(spark, "event_stats")
    stats = reports.event_stats(inputs.records(spark, sf_dir))
    stats.write.partitionBy("dt").parquet(path)
    day = date(2024, 1, 15)
    table = spark.read.schema(stats.schema).parquet(path).select(*stats.columns)
    of_day = table.where(F.col("dt") == F.lit(day))
    replace_day(of_day.withColumn("times", -F.col("times")), path, day)
    return spark.read.schema(stats.schema).parquet(path).select(*stats.columns)


@query
def loaded_files(spark, sf_dir):
    """Early and late files say different things of the same events; the later ones hold, whatever
    the sizes: the early ones repeat their lines for odd days, the late ones for even days."""
    root, path = work_dir(spark, "logs"), work_dir(spark, "event_log")
    rules = work_dir(spark, "rules")
    # The join is made and the usual parameters are written out once, not for each folder of logs.
    events = inputs.with_query(inputs.tracked_events(spark, sf_dir))
    events = events.select("event_id", "ip", "access_time_ms", "query")
    events = inputs.saved(events, "tracked", FILE_ROWS)
    inputs.rule_lines(inputs.ip_rules(spark, sf_dir)).write.text(rules)
    for day in (date(2024, 2, 1), date(2024, 2, 2)):
        for name, copies in (("early", 1 + 3 * (day.day % 2)), ("late", 4 - 3 * (day.day % 2))):
            lines = inputs.log_lines(events, b_n=F.lit(f"{name}-{day.day}"))
            lines = lines.select(F.explode(F.array_repeat("value", copies)).alias("value"))
            at = f"{root}/{day:%Y/%m/%d}/{('1000', '1100')[name == 'late']}"
            # Packed as logs are kept, in files small enough to be read by many tasks.
            writer = lines.write.option("maxRecordsPerFile", FILE_ROWS)
            writer.option("zlib.compress.level", "BEST_SPEED").text(at, compression="gzip")
            inputs.move_files(spark, at, at)
        run_etl(spark, root, rules, f"{path}/{day.day}", day)
    found = [
        spark.read.parquet(f"{path}/{n}").select(
            F.lit(n).alias("load"), "uid", "access_time", "en", "b_n"
        )
        for n in (1, 2)
    ]
    return found[0].union(found[1])


@query
def upserted_flow(spark, sf_dir):
    """The flow of the first events, then brought up to date by that of all events."""
    path = work_dir(spark, "flow")
    events = inputs.records(spark, sf_dir)
    early = events.where(F.col("en") == "e_l")
    for step, part in enumerate((early, events)):
        flow = reports.location_flow(visit_grain(part, REGION_COLUMNS))
        upsert(flow, path, REGION_COLUMNS, f"{path}__staging/{step}")
    table = spark.read.parquet(path)
    return table.select("dt", *REGION_COLUMNS, "nu", "uv", "pv", "sn", "on")


@query
def landed_lines(spark, sf_dir):
    source, path, checkpoint = (work_dir(spark, n) for n in ("lines", "landed", "checkpoint"))
    at_once = inputs.write_stream_files(inputs.lines(spark, sf_dir), source)
    stream = stream_text_dir(spark, source, at_once)
    land_stream(stream, path, checkpoint, every=None).awaitTermination()
    return read_landed(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_growing_lines(spark, sf_dir):
    """Lines of four files that are appended to while the query stands still."""
    source, table, checkpoint = (work_dir(spark, n) for n in ("growing", "lines", "checkpoint"))
    number = F.col("event_id")
    lines = inputs.log_lines(inputs.tracked_events(spark, sf_dir)).select(
        "event_id", "value", (number % 4).cast("string").alias("file"), (number % 3).alias("step")
    )
    lines = inputs.saved(lines, "growing-lines")
    for step in range(3):
        inputs.grow_files(lines, source, step)
        stream = stream_growing_files(spark, source, suffix=".log", split_bytes=1 << 20)
        writer = stream.writeStream.format("parquet").option("path", table)
        writer.option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.read.parquet(table).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# Streams


@query
def stream_rejected_lines(spark, sf_dir):
    """What a stream of lines leaves out, by reason."""
    source, table, checkpoint = (work_dir(spark, n) for n in ("lines", "rejected", "checkpoint"))
    at_once = inputs.write_stream_files(inputs.faulty_lines(spark, sf_dir), source)
    keep_rejected(stream_text_dir(spark, source, at_once), table, checkpoint).awaitTermination()
    return spark.read.parquet(table).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("n_chars")
    )


def _run_flow(spark, sf_dir, parts, start=stream_location_flow, between=None, **settings):
    source, table, checkpoint = (work_dir(spark, n) for n in ("lines", "flow", "checkpoint"))
    for i, part in enumerate(parts):
        if i and between:
            between(checkpoint, table)
        at_once = inputs.write_stream_files(part, source)
        stream = stream_text_dir(spark, source, at_once)
        start(
            stream,
            inputs.ip_rules(spark, sf_dir),
            table,
            checkpoint,
            state_partitions=spark.sparkContext.defaultParallelism,
            **settings,
        ).awaitTermination()
    return read_flow(spark, table)


@query
def stream_flow_report(spark, sf_dir):
    """What the flow job publishes: ids of dimensions that grow with the batches."""
    out = work_dir(spark, "reports")
    _run_flow(spark, sf_dir, [inputs.lines(spark, sf_dir)], run_flow, out=out)
    found = load_dims(spark, f"{out}/dims")
    days = found["date"].select(F.col("id").alias("date_dimension_id"), "calendar", "type")
    places = found["location"].withColumnRenamed("id", "location_dimension_id")
    report = spark.read.parquet(f"{out}/stats_location_flow")
    return (
        report.join(days, "date_dimension_id")
        .join(places, "location_dimension_id")
        .select("calendar", "type", *REGION_COLUMNS, "nu", "uv", "pv", "sn", "on", "created", "dt")
    )


@query
def stream_flow(spark, sf_dir):
    return _run_flow(spark, sf_dir, [inputs.lines(spark, sf_dir)])


@query
def stream_flow_restarted(spark, sf_dir):
    """The same report when the query stops in between and goes on from its checkpoint."""
    lines = inputs.log_lines(inputs.tracked_events(spark, sf_dir))
    late = F.col("event_id") % 3 == 0
    return _run_flow(
        spark, sf_dir, [lines.where(~late).select("value"), lines.where(late).select("value")]
    )


@query
def stream_flow_restated(spark, sf_dir):
    """The report is lost between two runs and made again from the state of the stream."""
    lines = inputs.log_lines(inputs.tracked_events(spark, sf_dir))
    late = F.col("event_id") % 3 == 0

    def lose(checkpoint, table):
        storage.remove(spark, table)
        restate_flow(spark, checkpoint, table)

    parts = [lines.where(~late).select("value"), lines.where(late).select("value")]
    return _run_flow(spark, sf_dir, parts, between=lose)


@query
def stream_enriched(spark, sf_dir):
    source, table, checkpoint = (work_dir(spark, n) for n in ("lines", "events", "checkpoint"))
    at_once = inputs.write_stream_files(inputs.lines(spark, sf_dir), source)
    records = parse.enrich(
        stream_text_dir(spark, source, at_once), inputs.ip_rules(spark, sf_dir)
    )
    writer = records.select(*LOG_COLUMNS).writeStream.format("parquet")
    writer.option("path", table).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(table)


def _document_stream(spark, sf_dir):
    source = work_dir(spark, "documents")
    text = F.regexp_replace("text", r"[\r\n]+", " ")
    documents = inputs.table(spark, sf_dir, "documents").select(text.alias("value"))
    return stream_text_dir(spark, source, inputs.write_stream_files(documents, source))


@query
def stream_batch_words(spark, sf_dir):
    table, checkpoint = (work_dir(spark, n) for n in ("words", "checkpoint"))
    stream = _document_stream(spark, sf_dir)
    start_batch_word_count(stream, table, checkpoint).awaitTermination()
    return read_batch_counts(spark, table).groupBy("word").agg(F.sum("n").alias("n"))


@query
def stream_running_words(spark, sf_dir):
    table, checkpoint = (work_dir(spark, n) for n in ("words", "checkpoint"))
    stream = _document_stream(spark, sf_dir)
    start_running_word_count(
        stream, table, checkpoint, state_partitions=spark.sparkContext.defaultParallelism
    ).awaitTermination()
    return read_running_counts(spark, table)
