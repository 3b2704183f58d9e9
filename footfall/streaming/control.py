"""How a streaming query is started: state store, state partitions, trigger, checkpoint."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from footfall.session import ROCKSDB_PROVIDER

STATE_KEY = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"
# Counting the rows of the state would look up each row once more when it is written.
COUNT_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start a query inside this block to keep its state in RocksDB, off the JVM heap.

    ``partitions`` fixes the number of state partitions, which a checkpoint keeps for good;
    by default the session's shuffle partitions. A query takes its own copy of the settings
    when it starts.
    """
    wanted = {STATE_KEY: ROCKSDB_PROVIDER, COUNT_KEY: "false"}
    if partitions:
        wanted[PARTITIONS_KEY] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
