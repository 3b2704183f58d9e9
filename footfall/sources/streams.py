"""Streams of lines, all with the one column ``value``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the reset policy in older consumers, and what Spark calls them.
RESET_POLICIES = {
    "smallest": "earliest",
    "largest": "latest",
    "earliest": "earliest",
    "latest": "latest",
}


def kafka_options(
    servers: str,
    topics: str | Iterable[str],
    reset: str = "latest",
    group_prefix: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka stream.

    ``reset`` only counts for a query without a checkpoint; afterwards the checkpoint holds
    the offsets. Offsets the broker has already deleted are skipped to the earliest ones.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": RESET_POLICIES[reset],
        "failOnDataLoss": "false",
    }
    optional = {
        "groupIdPrefix": group_prefix,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    return options | {k: str(v) for k, v in optional.items() if v is not None}


def read_kafka(spark: SparkSession, servers: str, topics: str | Iterable[str], **settings):
    """Message values as lines. Needs Spark's Kafka package on the class path."""
    options = kafka_options(servers, topics, **settings)
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def stream_text_dir(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files that appear in a folder; the checkpoint remembers which were read."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. It cannot replay, so it is for trying things out only."""
    return spark.readStream.format("socket").options(host=host, port=port).load()
