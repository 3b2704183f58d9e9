from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def trigger(writer, every: str | None):
    """A processing-time trigger, or all that is there now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def land_stream(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Write the lines of a stream as text files, in a folder per day of arrival.

    The day is that of the batch's own start time, which a replay repeats.
    """
    writer = (
        lines.select("value", F.to_date(F.current_timestamp()).alias("dt"))
        .writeStream.format("text")
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return trigger(writer, every).start()


def console(df: DataFrame, rows: int = 20, every: str | None = None, mode: str = "append"):
    """Print the schema and then rows: of a batch at once, of a stream batch by batch."""
    df.printSchema()
    if not df.isStreaming:
        df.show(rows, truncate=False)
        return None
    writer = df.writeStream.format("console").outputMode(mode).option("numRows", rows)
    return trigger(writer, every).start()
