"""Write frames to JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 32,
          batch_size: int = 10_000, **properties: str) -> None:
    """Append to a table. ``connections`` bounds how many tasks write at the same time.

    The rows are dealt out to that many tasks before, so that the work above keeps all of its own.
    """
    (df.repartition(connections).write.format("jdbc").mode(mode)
       .options(url=url, dbtable=table, numPartitions=connections, batchsize=batch_size, **properties).save())


def write_tables(tables: dict[str, DataFrame], url: str, **settings) -> None:
    """One target table per frame."""
    for name, df in tables.items():
        write(df, url, name, **settings)
