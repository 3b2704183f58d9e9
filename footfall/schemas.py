"""Column names, vocabularies and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The vocabulary of the log format and of the reports.
EVENT_LAUNCH = "e_l"
EVENT_PAGE_VIEW = "e_pv"
EVENT_BROWSE_PRODUCT = "e_bp"
EVENT_ADD_TO_CART = "e_ba"
ALL = "all"
UNKNOWN = "unknown"
DATE_TYPE_DAY = "day"

VIEW_EVENTS = (EVENT_PAGE_VIEW, EVENT_BROWSE_PRODUCT)

REGION_COLUMNS = ("country", "province", "city")

# The named cells of a log record, in the order the reports read them.
LOG_COLUMNS = (
    "uid",
    "sid",
    "access_time",
    "en",
    "country",
    "province",
    "city",
    "pl",
    "b_n",
    "pid",
    "os_n",
)
KNOWN_CELLS = ("ip", *LOG_COLUMNS)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


EVENT_LOG = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        *_strings(*KNOWN_CELLS),
        T.StructField("access_time_ms", T.LongType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("dt", T.DateType()),
    ]
)

IP_RULES = T.StructType(
    [
        T.StructField("start_num", T.LongType()),
        T.StructField("end_num", T.LongType()),
        *_strings(*REGION_COLUMNS),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *[T.StructField(n, T.IntegerType()) for n in ("year", "season", "month", "week", "day")],
        *_strings("calendar", "type"),
    ]
)
DIM_PLATFORM = T.StructType([T.StructField("id", T.LongType()), *_strings("platform_name")])
DIM_LOCATION = T.StructType([T.StructField("id", T.LongType()), *_strings(*REGION_COLUMNS)])
DIM_EVENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *_strings("event_name", "event_description", "category"),
    ]
)

DATE_KEYS = ("year", "season", "month", "week", "day", "calendar", "type")
PLATFORM_KEYS = ("platform_name",)
LOCATION_KEYS = REGION_COLUMNS
EVENT_KEYS = ("event_name", "event_description", "category")

# Bucket names of the session report, as they appear in the summary text.
# A length of exactly 4 seconds and a depth of 0 belong to no bucket.
TIME_BUCKETS = (
    ("1s_3s", 0, 3),
    ("4s_6s", 5, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)
