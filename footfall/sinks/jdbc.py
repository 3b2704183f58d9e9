from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str,
    table: str,
    batch_size: int = 1000,
    connections: int | None = None,
    isolation: str = "READ_COMMITTED",
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": isolation,
    }
    optional = {
        "numPartitions": None if connections is None else str(connections),
        "user": user,
        "password": password,
        "driver": driver,
    }
    return options | {k: v for k, v in optional.items() if v is not None}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **settings) -> None:
    """Insert in batches of prepared statements; each partition is one transaction.

    A failed partition rolls back and is retried alone. Where the whole load must appear at
    once, write to a staging table and swap it in the database.
    """
    writer = df.write.format("jdbc").options(**jdbc_write_options(url, table, **settings))
    writer.mode(mode).save()
