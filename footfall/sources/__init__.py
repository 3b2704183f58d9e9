"""Readers: log files, IP rules, the event table, JDBC and streams."""

from footfall.sources.files import (
    MissingLogs,
    log_exists,
    log_path,
    read_event_log,
    read_ip_rules,
    read_landed,
    read_logs,
)
from footfall.sources.growing import stream_growing_files
from footfall.sources.jdbc import jdbc_options, read_jdbc
from footfall.sources.streams import kafka_options, read_kafka, stream_socket, stream_text_dir

__all__ = [
    "MissingLogs",
    "jdbc_options",
    "kafka_options",
    "log_exists",
    "log_path",
    "read_event_log",
    "read_ip_rules",
    "read_jdbc",
    "read_kafka",
    "read_landed",
    "read_logs",
    "stream_growing_files",
    "stream_socket",
    "stream_text_dir",
]
