"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from footfall import storage

# The results depend on the first two: days are cut in this zone, and a parameter that
# is repeated in a request keeps its last value. The others keep shuffles in shape.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


# The folders given out so far.
_work_dirs: list[str] = []


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Set the runtime options above on an existing session."""
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": time_zone}.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "footfall",
    master: str | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate(), time_zone)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but on the same path."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.gettempdir() + "/footfall"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _work_dirs.append(path)
    return path


def remove_work_dirs(spark: SparkSession) -> None:
    """Remove the folders :func:`work_dir` gave out, when no frame reads them any more."""
    while _work_dirs:
        storage.remove(spark, _work_dirs.pop())
