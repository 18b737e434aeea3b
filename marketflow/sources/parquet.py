"""Parquet reads: plain tables and the year/month partitioned lake.

The lake is always read at its root so that (a) Spark prunes partitions from a
filter on ``year``/``month`` instead of the caller building directory names,
(b) an absent month is simply no rows, and (c) a streaming sink's commit log is
honoured (a leaf read would see files of failed micro-batches).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.dates import as_date_value
from marketflow.schemas import RECORDED_LAKE
from marketflow.session import list_names
from marketflow.sinks.landed import LandedLog


# Error conditions of a read whose folder does not exist (or holds no files).
MISSING_PATH_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def is_missing_path(exc: Exception) -> bool:
    condition = None
    for getter in ("getCondition", "getErrorClass"):
        if hasattr(exc, getter):
            condition = getattr(exc, getter)()
            break
    return condition in MISSING_PATH_CONDITIONS or any(c in str(exc) for c in MISSING_PATH_CONDITIONS)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def month_index(year: str | Column = "year", month: str | Column = "month") -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return y * 12 + (m - 1)


def _month_index_of(date) -> Column:
    d = as_date_value(date)
    return F.year(d) * 12 + (F.month(d) - 1)


def scan_month_range(lake: DataFrame, start, end) -> DataFrame:
    """Rows of every month from ``start``'s month to ``end``'s month inclusive.

    The filter touches only partition columns and literals, so it lands in
    ``PartitionFilters`` and only the range's files are read. (The root is still
    listed as a whole, as for any partitioned read by path.)
    """
    idx = month_index()
    return lake.where((idx >= _month_index_of(start)) & (idx <= _month_index_of(end)))


def read_lake(spark: SparkSession, path: str, keep_batch: bool = False) -> DataFrame:
    """A lake of either kind: plain ``year=/month=``, or with a record of its batches.

    Of the latter, batches that are still being written (or whose writer was
    lost) are left out, and so is the ``batch`` column unless asked for; its columns
    are known, so no file is opened to learn them.
    """
    log = LandedLog(spark, path)
    if not log.exists():
        return spark.read.parquet(path)
    lake = spark.read.schema(RECORDED_LAKE).parquet(path)
    open_ = sorted(log.unfinished())
    if open_:  # at most one per writer
        lake = lake.where(~F.col("batch").isin(open_))
    return lake if keep_batch else lake.drop("batch")


def newest_month(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """``(year, month)`` of the newest partition, from names alone: no data file is opened.

    A recorded lake tells it from its record, any other from its folders' names
    (the newest year's folder is listed, and one before it only if that is empty).
    None for a lake without months.
    """
    log = LandedLog(spark, path)
    if log.exists():
        row = log.read().where("route = 'lake' and n_rows > 0").agg(F.max(F.struct("year", "month")).alias("m")).first()
        return None if row["m"] is None else (row["m"]["year"], row["m"]["month"])
    root = path.rstrip("/")
    for year in _numbered(spark, root, "year"):
        for month in _numbered(spark, f"{root}/{year}", "month"):
            if any(not n.startswith(("_", ".")) for n in list_names(spark, f"{root}/{year}/{month}")):
                return int(year.partition("=")[2]), int(month.partition("=")[2])
    return None


def _numbered(spark: SparkSession, path: str, key: str) -> list[str]:
    """The folders ``key=NUMBER``, the highest number first."""
    names = [n for n in list_names(spark, path) if n.startswith(key + "=") and n.partition("=")[2].isdigit()]
    return sorted(names, key=lambda n: int(n.partition("=")[2]), reverse=True)


def latest_partition(lake: DataFrame, since=None) -> DataFrame:
    """One row ``(year, month)``: the newest partition of the lake.

    Reads only partition values (``ReadSchema: struct<>``), never data columns;
    the files are still opened for their row counts, so ``since`` (a date)
    prunes months before it when the caller knows the lake is recent.
    """
    if since is not None:
        lake = lake.where(month_index() >= _month_index_of(since))
    latest = lake.select("year", "month").distinct().agg(
        F.max(F.struct("year", "month")).alias("p"))
    return latest.select(F.col("p.year").alias("year"), F.col("p.month").alias("month"))


def partition_values_from_path(df: DataFrame, names=("year", "month")) -> DataFrame:
    """Recover ``name=value`` directory values from each row's file path.

    Needed for leaf-directory reads, which carry no partition columns.
    """
    path = F.col("_metadata.file_path")
    for name in names:
        df = df.withColumn(
            name, F.regexp_extract(path, rf"(?:^|/){name}=(\d+)(?:/|$)", 1).try_cast("int"))
    return df
