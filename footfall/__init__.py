"""Web-log and visitor-behaviour analytics as Spark DataFrame, SQL and streaming jobs."""

from footfall.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
