"""Wall time of the headline operators over stored inputs; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of threads. Each
operator runs once to warm up and then ``BENCH_RUNS`` times (default 3); its number is the
median. The result is computed in full and discarded, so writing does not count.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from footfall import build_session  # noqa: E402
from footfall.catalog import inputs  # noqa: E402
from footfall.catalog.inputs import saved  # noqa: E402
from footfall.functions import row_key  # noqa: E402
from footfall.operators import parse, products, reports, sessions, words  # noqa: E402
from footfall.operators.geo import check_rules, ip_region_join  # noqa: E402
from footfall.operators.visits import visit_grain  # noqa: E402
from footfall.schemas import REGION_COLUMNS  # noqa: E402
from footfall.session import remove_work_dirs  # noqa: E402

def operators(spark, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The headline operators over stored inputs.

    Log lines, events and records are written before anything is timed, and the IP rules are
    checked once, so a time is that of the operator and not of the making of its input.
    """
    rules = saved(inputs.ip_rules(spark, sf_dir), "bench-rules")
    sizes = check_rules(rules)
    lines = saved(inputs.lines(spark, sf_dir), "bench-lines")
    tracked = saved(inputs.tracked_events(spark, sf_dir), "bench-events")
    records = saved(inputs.records(spark, sf_dir), "bench-records")
    documents = inputs.table(spark, sf_dir, "documents")
    visits = tracked.select("event_id", "uid", "access_time_ms")

    def event_log():
        parsed = parse.complete_records(parse.parse_log(lines))
        return parse.merge_params(ip_region_join(parsed, rules, sizes=sizes))

    def top_products():
        counts = products.area_product_counts(products.product_views(records))
        return products.area_top_products(products.area_product_rollup(counts))

    def log_params():
        params = F.explode("params").alias("name", "value")
        return parse.parse_log(lines).select("access_time", params)

    return {
        "user_stats": lambda: reports.user_stats(visit_grain(event_log(), ("pl",))),
        "log_params": log_params,
        "ip_regions": lambda: ip_region_join(tracked.select("event_id", "ip"), rules, sizes=sizes),
        "session_shares": lambda: reports.session_aggr_stat(
            visit_grain(records, ("pl",), ("sid",))
        ),
        "device_location_stats": lambda: reports.device_location_stats(visit_grain(records)),
        "event_stats": lambda: reports.event_stats(records),
        "location_flow": lambda: reports.location_flow(visit_grain(records, REGION_COLUMNS)),
        "area_top_products": top_products,
        "row_keys": lambda: tracked.select("event_id", row_key("access_time_ms", "uid", "en")),
        "sessionized_events": lambda: sessions.sessionize(visits),
        "first_visits": lambda: sessions.first_visit_flag(visits),
        "word_count": lambda: words.word_count(documents, "text"),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "footfall-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, build in operators(spark, sf_dir).items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    remove_work_dirs(spark)
    spark.stop()


if __name__ == "__main__":
    main()
