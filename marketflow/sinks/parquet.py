"""Parquet writes: whole-table overwrite and the year/month lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.schemas import LAKE_PARTITION_COLUMNS
from marketflow.session import path_exists
from marketflow.sinks.landed import LandedLog


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_lake_partitions(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    return (df.withColumn("year", F.year(date_col))
              .withColumn("month", F.month(date_col)))


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes the lake at ``path``: a file sink's log or a record of landed batches lies there."""
    root = path.rstrip("/")
    return path_exists(spark, f"{root}/_spark_metadata") or LandedLog(spark, root).exists()


def append_lake(df: DataFrame, path: str, date_col: str = "transaction_date",
                mode: str = "append") -> None:
    """Append rows to the ``year=/month=`` lake.

    ``rebalance`` on the partition columns gathers each month's rows into few
    tasks (few files per directory) while AQE splits a month that is too big
    for one task, so a hot month does not become a single straggler.

    A lake that a stream writes is refused: its readers and loads follow the
    stream's record and would not see these rows. Send them through the stream
    (``jobs.backfill_streamed_lake``).
    """
    if is_streamed(df.sparkSession, path):
        raise ValueError(f"{path} is written by a stream; a batch append would stay invisible to its readers")
    if "year" not in df.columns or "month" not in df.columns:
        df = with_lake_partitions(df, date_col)
    (df.hint("rebalance", *LAKE_PARTITION_COLUMNS)
       .write.mode(mode).partitionBy(*LAKE_PARTITION_COLUMNS).parquet(path))
