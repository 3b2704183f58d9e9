"""Column functions. Every one maps columns to a column and stays inside the JVM."""

from footfall.functions.dates import (
    date_parts,
    day_of,
    format_ms,
    next_day_ms,
    parse_date_ms,
    valid_date,
)
from footfall.functions.events import event_category, event_description, is_launch, is_view
from footfall.functions.keys import java_string_hash, row_key
from footfall.functions.net import ip_parts, ip_to_long, parts_to_long
from footfall.functions.measures import bucket_summary, city_concat, mask_all, round_share
from footfall.functions.text import (
    build_query_string,
    get_field,
    is_not_blank,
    java_split,
    parse_query_string,
    platform_from_user_agent,
    set_field,
    url_decode,
    url_encode,
)

__all__ = [
    "bucket_summary",
    "build_query_string",
    "city_concat",
    "date_parts",
    "day_of",
    "event_category",
    "event_description",
    "format_ms",
    "get_field",
    "ip_parts",
    "ip_to_long",
    "is_launch",
    "is_not_blank",
    "is_view",
    "java_split",
    "java_string_hash",
    "mask_all",
    "next_day_ms",
    "parse_date_ms",
    "parse_query_string",
    "parts_to_long",
    "platform_from_user_agent",
    "round_share",
    "row_key",
    "set_field",
    "url_decode",
    "url_encode",
    "valid_date",
]
