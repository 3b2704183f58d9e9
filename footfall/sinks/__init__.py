"""Writers: the event table, report tables, JDBC and streams."""

from footfall.sinks.jdbc import jdbc_write_options, write_jdbc
from footfall.sinks.streams import console, land_stream
from footfall.sinks.tables import (
    merge_cells,
    merge_partitions,
    merge_repeats,
    replace_day,
    upsert,
    write_event_log,
)

__all__ = [
    "console",
    "jdbc_write_options",
    "land_stream",
    "merge_cells",
    "merge_partitions",
    "merge_repeats",
    "replace_day",
    "upsert",
    "write_event_log",
    "write_jdbc",
]
