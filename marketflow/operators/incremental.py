"""High-water-mark loads from the lake into the warehouse.

The cut is one scalar read once per run (never once per month). New rows are
found with one root scan: partition pruning by month plus a strict date filter.
A row is loaded if no equal row (all columns, nulls equal) is in the target yet:
one aggregate over the batch and the target's same window both removes
duplicates and leaves out what is there, so reruns add nothing and the result
does not depend on how rows are split into batches; a correction is a row of its
own. The batch is staged as Parquet in the shared folder before it is written,
so the data write and the new cut see the same rows even when executors are
lost and work is recomputed.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions.dates import as_date_value
from marketflow.operators.contracts import with_violations
from marketflow.schemas import BATCH_TABLE, CUT_TABLE
from marketflow.session import delete_path, path_exists, rename_path, scratch_path
from marketflow.sinks.jdbc import append_jdbc, create_from, create_like, move_rows, overwrite_jdbc, run_transaction
from marketflow.sinks.landed import LandedLog
from marketflow.sources.jdbc import read_jdbc_table, read_max_cut, table_exists
from marketflow.sources.parquet import is_missing_path, latest_partition, month_index, read_lake

log = logging.getLogger(__name__)


def _month_index(value: _dt.date) -> int:
    return value.year * 12 + value.month - 1


def _to_date(value) -> _dt.date | None:
    if value is None or isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.datetime):
        return value.date()
    return _dt.date.fromisoformat(str(value).strip())


def lake_cut(lake: DataFrame, default=None, date_col: str = "transaction_date",
             since=None, newest: tuple[int, int] | None = None) -> DataFrame:
    """One row ``cut_date``: the newest date of the lake's newest month.

    Step 1 finds that month, unless ``newest`` names it (``sources.newest_month``
    tells it without opening a file): it reads only partition values, of the
    months from ``since`` on (the last known cut: without it the files of every
    month are opened once). Step 2 reads the date column of that single month (a
    literal partition filter, so the scan is pruned). Any year counts, so early
    January falls back to December, not to a fixed date.
    """
    latest = dict(zip(("year", "month"), newest)) if newest else latest_partition(lake, since).first()
    spark = lake.sparkSession
    if latest is None or latest["year"] is None:
        return spark.range(1).select(as_date_value(default).cast("date").alias("cut_date")) \
            if default is not None else spark.createDataFrame([], "cut_date date")
    month = lake.where((F.col("year") == latest["year"]) & (F.col("month") == latest["month"]))
    cut = F.max(date_col)
    if default is not None:
        cut = F.coalesce(cut, as_date_value(default))
    return month.agg(cut.cast("date").alias("cut_date"))


def new_rows(lake: DataFrame, cut, seen: list[DataFrame] | None = None,
             date_col: str = "transaction_date", lookback_days: int = 0, floor=None) -> DataFrame:
    """Distinct lake rows strictly after ``cut - lookback_days`` that no frame of
    ``seen`` holds; rows are compared on all of the lake's columns, nulls equal.

    ``lookback_days`` re-reads late rows for days already loaded. The window
    never reaches below ``floor`` (the first cut of the warehouse), and only
    seen rows in the same window are read. One shuffle serves both the
    de-duplication and the comparison; copies are merged before it.
    """
    start = _to_date(cut) - _dt.timedelta(days=lookback_days)
    if floor is not None:
        start = max(start, _to_date(floor))
    return unseen(_after_start(lake, date_col, start), [_after_start(f, date_col, start) for f in seen or []])


def unseen(rows: DataFrame, seen: list[DataFrame]) -> DataFrame:
    """Distinct rows that no frame of ``seen`` holds, compared on all columns of ``rows``, nulls equal."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    tagged = rows.withColumn("_seen", F.lit(0))
    for frame in seen:
        tagged = tagged.unionByName(frame.select(*columns).withColumn("_seen", F.lit(1)))
    return tagged.groupBy(*columns).agg(F.max("_seen").alias("_seen")).where("_seen = 0").drop("_seen")


def _after_start(df: DataFrame, date_col: str, start: _dt.date) -> DataFrame:
    """``date > start``, plus the equivalent month filter on partitioned
    tables, so files of whole months before the start are not read."""
    if "year" in df.columns and "month" in df.columns:
        df = df.where(month_index() >= F.lit(_month_index(start)))
    return df.where(F.col(date_col) > F.lit(start))


class Warehouse(Protocol):
    """What the loader needs from a warehouse: read a table (None when it
    does not exist), append and overwrite rows, and the cut table's max."""

    def read(self, table: str, schema=None) -> DataFrame | None: ...

    def append(self, table: str, df: DataFrame) -> None: ...

    def append_all(self, frames: list[tuple[str, DataFrame]]) -> None: ...

    def overwrite(self, table: str, df: DataFrame) -> None: ...

    def max_cut(self, table: str = "cutting_dates") -> DataFrame | None: ...


_BEFORE = ".before"  # ending of a table's folder while it is exchanged


class ParquetWarehouse:
    """Warehouse tables kept as Parquet folders under one root (shared storage)."""

    def __init__(self, spark: SparkSession, root: str, partition_by: dict | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_by = partition_by or {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema=None) -> DataFrame | None:
        """The table, or None when its folder does not exist yet. A known
        ``schema`` skips schema inference (footer reads)."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        path = self.path(table)
        if not path_exists(self.spark, path) and path_exists(self.spark, path + _BEFORE):
            path += _BEFORE  # an overwrite was cut off between its two renames
        try:
            return reader.parquet(path)
        except AnalysisException as exc:
            if is_missing_path(exc):
                return None
            raise

    def append(self, table: str, df: DataFrame) -> None:
        parts = self.partition_by.get(table)
        if parts:
            # few files per partition directory; AQE splits a hot one
            df = df.hint("rebalance", *parts)
        writer = df.write.mode("append")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(self.path(table))

    def append_all(self, frames: list[tuple[str, DataFrame]]) -> None:
        """Appends in the order given (files know no transaction over tables)."""
        for table, df in frames:
            self.append(table, df)

    def overwrite(self, table: str, df: DataFrame) -> None:
        """Written beside the table, which is then exchanged: a crash leaves the old rows or the new ones."""
        path, fresh = self.path(table), f"{self.root}/.{table}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(fresh)
        if path_exists(self.spark, path):
            delete_path(self.spark, path + _BEFORE)
            rename_path(self.spark, path, path + _BEFORE)
        rename_path(self.spark, fresh, path)
        delete_path(self.spark, path + _BEFORE)

    def max_cut(self, table: str = "cutting_dates") -> DataFrame | None:
        cuts = self.read(table, schema=CUT_TABLE)
        return None if cuts is None else cuts.agg(F.max("cut_date").alias("cut_date"))


class JdbcWarehouse:
    """Warehouse tables in a database reached over JDBC.

    ``truncate`` makes overwrites keep the table definitions (rows must then
    match them). ``splits`` gives per table the arguments of a read in parallel
    (``partition_column``, ``lower_bound``, ``upper_bound``, ``num_partitions``),
    and ``connections`` how many connections a write may use.
    """

    def __init__(self, spark: SparkSession, url: str, properties: dict, truncate: bool = False,
                 splits: dict[str, dict] | None = None, connections: int | None = None):
        self.spark, self.url, self.properties = spark, url, properties
        self.truncate, self.splits, self.connections = truncate, splits or {}, connections

    def read(self, table: str, schema=None) -> DataFrame | None:
        """The table, or None when the database does not list it."""
        if not table_exists(self.spark, self.url, self.properties, table):
            return None
        return read_jdbc_table(self.spark, self.url, table, self.properties, **self.splits.get(table, {}))

    def append(self, table: str, df: DataFrame) -> None:
        append_jdbc(df, self.url, table, self.properties, self.connections)

    def append_all(self, frames: list[tuple[str, DataFrame]]) -> None:
        """All appends or none: the rows go to staging tables of this load, from which one transaction moves them."""
        load = uuid.uuid4().hex[:12]
        stages = [(table, f"{table}__load_{load}", df, table_exists(self.spark, self.url, self.properties, table)) for table, df in frames]
        try:
            for table, stage, df, there in stages:
                if there:  # the target's own types
                    run_transaction(self.spark, self.url, self.properties, [create_like(stage, table, df.columns)])
                append_jdbc(df, self.url, stage, self.properties, self.connections)
            moves = [move_rows(stage, table, df.columns) if there else create_from(stage, table, df.columns)
                     for table, stage, df, there in stages]
            run_transaction(self.spark, self.url, self.properties, moves)
        finally:
            run_transaction(self.spark, self.url, self.properties, [f"DROP TABLE IF EXISTS {stage}" for _, stage, _, _ in stages])

    def overwrite(self, table: str, df: DataFrame) -> None:
        overwrite_jdbc(df, self.url, table, self.properties, truncate=self.truncate, num_partitions=self.connections)

    def max_cut(self, table: str = "cutting_dates") -> DataFrame | None:
        if not table_exists(self.spark, self.url, self.properties, table):
            return None
        return read_max_cut(self.spark, self.url, self.properties, table)


def read_cut(warehouse: Warehouse, initial_cut=None, table: str = "cutting_dates") -> _dt.date | None:
    """The warehouse high-water mark (one scalar), or ``initial_cut`` when the
    cut table is absent or empty."""
    frame = warehouse.max_cut(table)
    row = frame.first() if frame is not None else None
    value = row["cut_date"] if row is not None else None
    return _to_date(value) if value is not None else _to_date(initial_cut)


def load_increment(lake: DataFrame, warehouse: Warehouse,
                   data_table: str = "market_data", cut_table: str = "cutting_dates",
                   initial_cut=None, cut=None, date_col: str = "transaction_date",
                   lookback_days: int = 0, drop_columns: list[str] | None = None,
                   contract=None, reject_table: str | None = None) -> dict:
    """Append the lake's new rows to ``data_table`` and advance the cut.

    ``cut`` overrides the stored cut (e.g. a rerun from an older cut). The
    lookback never reaches below ``initial_cut``. With ``contract`` (a list
    of ``contracts.Rule``) only rows meeting it are appended; the others go
    to ``reject_table`` (if given) with their ``violations``, and are counted
    in the summary. Rows already in either table are left out, so a rerun,
    also one after a crash between two writes, repeats nothing. The new cut is
    written last and only if it is above the stored one; returns a summary.
    """
    spark = lake.sparkSession
    stored = read_cut(warehouse, None, cut_table)
    start = _to_date(cut) if cut is not None else stored or _to_date(initial_cut)
    if start is None:
        return {"cut_before": None, "rows_loaded": 0, "rows_rejected": 0, "cut_after": None}
    # ``year``/``month`` prune the lake's files before they may be dropped.
    floor = None if initial_cut is None else _to_date(initial_cut)
    since = start - _dt.timedelta(days=lookback_days)
    rows = _after_start(lake, date_col, since if floor is None else max(since, floor)).drop(*(drop_columns or []))
    tables = [warehouse.read(data_table, schema=rows.schema)]
    if contract and reject_table:
        tables.append(warehouse.read(reject_table))
    batch = new_rows(rows, start, [t for t in tables if t is not None], date_col, lookback_days, floor)
    return _write_load(spark, warehouse, batch, start, stored, data_table, cut_table, date_col, contract, reject_table)


def load_landed(spark: SparkSession, lake_path: str, warehouse: Warehouse,
                data_table: str = "market_data", cut_table: str = "cutting_dates",
                batch_table: str = "loaded_batches", initial_cut=None, date_col: str = "transaction_date",
                drop_columns: list[str] | None = None, contract=None, reject_table: str | None = None) -> dict:
    """Append what the lake's record names as landed and not yet loaded, however old its dates are.

    The batches not in ``batch_table`` are read, by their names, which are
    partition values: no other file of the lake is opened, and no lookback is
    needed. Of the target only the months these batches wrote are compared, so
    rows already there (from a load that was cut off, or copies in different
    batches) are not repeated. Rows on or before ``initial_cut`` are never loaded. The
    batches are noted last: a load cut off before is done again and adds what is
    missing. Returns the summary of ``load_increment`` and the number of batches.
    """
    record = LandedLog(spark, lake_path)
    floor, stored = (None if initial_cut is None else _to_date(initial_cut)), read_cut(warehouse, None, cut_table)
    loaded = warehouse.read(batch_table, schema=BATCH_TABLE)
    # One short name per batch; of the record only the files of batches yet to be loaded are read.
    known = set() if loaded is None else {r["batch"] for r in loaded.select("batch").distinct().collect()}
    fresh = record.done() - known
    landed = record.read(fresh).where("route = 'lake' and n_rows > 0")
    if floor is not None:
        landed = landed.where(F.col("last_day") > F.lit(floor))
    # One row per batch and month that is yet to be loaded.
    pending = landed.select("batch", "year", "month").distinct().collect()
    start = stored or floor
    if not pending:
        return {"cut_before": start, "rows_loaded": 0, "rows_rejected": 0, "cut_after": start, "batches": 0}
    names, months = sorted({p["batch"] for p in pending}), sorted({(p["year"], p["month"]) for p in pending})
    rows = read_lake(spark, lake_path, keep_batch=True).where(F.col("batch").isin(names))
    rows = rows.drop("batch", *(drop_columns or []))
    if floor is not None:
        rows = rows.where(F.col(date_col) > F.lit(floor))
    tables = [warehouse.read(data_table, schema=rows.schema)]
    if contract and reject_table:
        tables.append(warehouse.read(reject_table))
    batch = unseen(rows, [_in_months(t, date_col, months) for t in tables if t is not None])
    out = _write_load(spark, warehouse, batch, start, stored, data_table, cut_table, date_col, contract, reject_table,
                      # Those that put no row into the lake too, so their records are not read again.
                      [(batch_table, spark.createDataFrame([(n,) for n in sorted(fresh)], BATCH_TABLE))])
    return {**out, "batches": len(names)}


def _in_months(df: DataFrame, date_col: str, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of the given months, by date ranges (which scans can skip by) and, where there are any, partition columns."""
    if "year" in df.columns and "month" in df.columns:
        df = df.where(month_index().isin([y * 12 + m - 1 for y, m in months]))
    spans: list[list[int]] = []
    for index in (y * 12 + m - 1 for y, m in months):  # neighbouring months make one range
        if spans and spans[-1][1] == index:
            spans[-1][1] = index + 1
        else:
            spans.append([index, index + 1])
    first = lambda i: F.lit(_dt.date(i // 12, i % 12 + 1, 1))
    day = F.col(date_col)
    return df.where(reduce(or_, ((day >= first(a)) & (day < first(b)) for a, b in spans)))


def _write_load(spark: SparkSession, warehouse: Warehouse, batch: DataFrame, start, stored, data_table: str, cut_table: str,
                date_col: str, contract, reject_table: str | None, notes: list[tuple[str, DataFrame]] | None = None) -> dict:
    """Stages the batch, then appends its bad and good rows, the new cut and any notes: in one transaction where
    the warehouse has them, else in this order."""
    staged = with_violations(batch, contract or [])
    # Cut the lineage with a staged copy in the shared folder: one job computes
    # the batch, and all writes read the same rows, even when executors are lost.
    stage = scratch_path(spark, f"stage-{data_table}")
    staged.write.parquet(stage)
    staged = spark.read.schema(staged.schema).parquet(stage)
    bad = F.size("violations") > 0
    stats = staged.agg(F.count(F.when(~bad, 1)).alias("good"), F.count(F.when(bad, 1)).alias("bad"),
                       F.max(date_col).cast("date").alias("m")).first()
    after = max((d for d in (start, stored, stats["m"]) if d is not None), default=None)
    frames = []
    if stats["bad"] and reject_table:
        frames.append((reject_table, staged.where(bad).withColumn("violations", F.array_join("violations", ","))))
    if stats["good"]:
        frames.append((data_table, staged.where(~bad).drop("violations")))
    if stats["m"] is not None and (stored is None or stats["m"] > stored):
        frames.append((cut_table, spark.createDataFrame([(stats["m"],)], CUT_TABLE)))
    frames += notes or []
    if frames:
        warehouse.append_all(frames)
    delete_path(spark, stage)
    log.info("load %s: %d rows after %s (%d rejected), cut now %s",
             data_table, stats["good"], start, stats["bad"], after)
    return {"cut_before": start, "rows_loaded": stats["good"],
            "rows_rejected": stats["bad"], "cut_after": after}
