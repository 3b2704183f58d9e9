"""Word counts over a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import storage
from footfall.operators.words import word_count
from footfall.sinks.streams import trigger
from footfall.streaming.control import state_settings

# Both jobs write one folder per batch. A batch that is run again overwrites its own.
COUNTS = "word STRING, n BIGINT, batch_id BIGINT"
COMPACT_EVERY = 16


def _write_batch(table: str):
    def write(counts: DataFrame, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch_id={batch_id}")

    return write


def start_batch_word_count(
    lines: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Counts of each micro-batch on its own; no state is kept."""
    write = _write_batch(table)
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write(word_count(batch), batch_id)
    )
    return trigger(writer, every).start()


def read_batch_counts(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(COUNTS).parquet(table)


def _compact(spark: SparkSession, table: str, batch_id: int) -> None:
    """Put the totals of all batches so far in one folder, named by a negative number.

    Totals only grow, so reading a total twice does no harm; nothing is removed before the
    folder is complete, and a folder that is there is not made again.
    """
    target = f"batch_id={-batch_id - 1}"
    done = [n for n in storage.children(spark, table) if n.startswith("batch_id=")]
    if target not in done:
        staging = f"{table}__compacting"
        storage.remove(spark, staging)
        totals = read_running_counts(spark, table)
        totals.repartition("word").write.parquet(staging)
        storage.move(spark, staging, f"{table}/{target}")
    for name in done:
        number = int(name.split("=", 1)[1])
        if name != target and number < batch_id:
            storage.remove(spark, f"{table}/{name}")


def start_running_word_count(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Counts since the start. Each batch writes the new totals of the words it met.

    Every ``compact_every`` batches the folders become one, so their number stays bounded
    and a reader sees each word a bounded number of times.
    """
    table, write = table.rstrip("/"), _write_batch(table)

    def apply(counts: DataFrame, batch_id: int) -> None:
        write(counts, batch_id)
        if (batch_id + 1) % compact_every == 0:
            _compact(counts.sparkSession, table, batch_id)

    with state_settings(lines.sparkSession, state_partitions):
        writer = (
            word_count(lines)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(apply)
        )
        return trigger(writer, every).start()


def read_running_counts(spark: SparkSession, table: str) -> DataFrame:
    """The current total of each word: a total only grows, so it is the largest written."""
    written = spark.read.schema(COUNTS).parquet(table)
    return written.groupBy("word").agg(F.max("n").alias("n"))
