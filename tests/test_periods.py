"""Periods from bitmaps of days, with ids over several buckets and numbering in steps."""

from datetime import date

from pyspark.sql import functions as F

from footfall.operators import periods, reports
from footfall.operators.visits import visit_grain


def test_periods_of_days(spark):
    start = F.lit(date(2023, 12, 28))
    events = spark.range(4000).select(
        F.date_add(start, (F.col("id") % 70).cast("int")).alias("dt"),
        F.when(F.col("id") % 41 != 0, F.concat(F.lit("u"), F.col("id") % 173)).alias("uid"),
        F.concat(F.lit("s"), F.col("id") % 977).alias("sid"),
        F.when(F.col("id") % 3 == 0, "pc").otherwise("ios").alias("pl"),
        F.when(F.col("id") % 5 == 0, "e_l").otherwise("e_pv").alias("en"),
        F.col("id").alias("access_time_ms"),
    ).persist()
    visits = visit_grain(events, ("pl",))
    # Numbers far apart put the ids in several bitmaps.
    users = periods.number_ids(visits.where("dt < '2024-01-10'"), None, "uid")
    users = periods.number_ids(visits, users, "uid").withColumn("id", F.col("id") * 5000)
    sessions = periods.number_ids(visits, None, "sid")
    days = periods.daily_bitmaps(visits, users, sessions, ("pl",), reports.PLATFORM_LEVELS)
    assert days.select("bucket").distinct().count() > 5
    for unit in ("week", "month", "season", "year"):
        found = periods.user_stats_of(days, unit).collect()
        each = F.explode(F.array("pl", F.lit("all"))).alias("platform")
        wanted = (
            events.select("*", each)
            .groupBy(periods.period_of("dt", unit).alias("first_day"), "platform")
            .agg(
                F.size(F.collect_set(F.coalesce("uid", F.lit("?")))).alias("active_users"),
                F.count_if(F.col("en") == "e_l").alias("new_install_users"),
                F.countDistinct("sid").alias("session_count"),
                F.expr("count_if(en = 'e_pv') DIV count(DISTINCT sid)").alias("session_length"),
            )
            .collect()
        )
        assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)), unit
    assert {r[0].isoweekday() for r in periods.period_stats(days, "week", ("pl",)).collect()} == {7}
