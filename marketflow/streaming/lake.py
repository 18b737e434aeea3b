"""The lake as a stream's sink, with a record of what every micro-batch landed.

Each micro-batch is parsed and joined once. Its rows leave by one of four routes:
into the lake, to the rejected texts (``_rejects``), to the bars whose ticker the
master does not know yet (``_unmatched``), or nowhere (not after the cut); all are
counted. The counts by month decide how the lake's rows are dealt: a month of over
``rows_per_task`` rows gets as many tasks as it needs, whatever its keys look like, and
small months share a task and give one file each.

A batch is named after the stream and its number and writes only partitions of its
name, so a batch that is run again after a crash first clears what it left, and one
that was finished is not run again: every message counts once. The record
(``LandedLog``) is what loads go by: they read exactly the batches they have not
loaded, whatever days those hold.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators.enrich import TO_LAKE, TO_REJECTS, TO_UNMATCHED, route_bars, typed_bars
from marketflow.session import delete_path, list_names
from marketflow.sinks.landed import REJECTS, UNMATCHED, LandedLog

ROWS_PER_TASK = 1 << 20  # rows of a month that one task writes
_BARS = list(schemas.BAR_RENAMES.values())
_LAKE = [f.name for f in schemas.ENRICHED_BAR]


def _counted(routed: DataFrame, batch: str) -> list[dict]:
    """One line per route and month: a few dozen rows however large the batch."""
    counts = routed.groupBy("route", "reason", "year", "month").agg(
        F.count("*").alias("n_rows"), F.min("transaction_date").cast("string").alias("first_day"),
        F.max("transaction_date").cast("string").alias("last_day"))
    return [{"batch": batch, **row.asDict()} for row in counts.collect()]


def deal_months(counts: dict[tuple[int, int], int], rows_per_task: int) -> tuple[dict[tuple[int, int], tuple[int, int]], int]:
    """``month -> (first task, number of tasks)`` and the number of tasks in all, from row counts by month."""
    dealt, task, room = {}, -1, 0
    for month, n in sorted(counts.items()):
        if n > rows_per_task:
            tasks = -(-n // rows_per_task)
            dealt[month], task, room = (task + 1, tasks), task + tasks, 0
        else:
            if n > room:
                task, room = task + 1, rows_per_task
            dealt[month], room = (task, 1), room - n
    return dealt, task + 1


def _dealt(rows: DataFrame, counts: dict[tuple[int, int], int], rows_per_task: int) -> DataFrame:
    dealt, tasks = deal_months(counts, rows_per_task)
    table = F.create_map(*[F.lit(x) for (y, m), place in dealt.items() for x in (y * 12 + m, list(place))])
    place = F.element_at(table, F.col("year") * 12 + F.col("month"))
    task = F.element_at(place, 1) + F.pmod(F.xxhash64(*rows.columns), F.element_at(place, 2).cast("bigint")).cast("int")
    return rows.repartitionById(tasks, task)


def write_batch(spark: SparkSession, lake_path: str, batch: str, routed: DataFrame, notes: list[dict] | None = None,
                rows_per_task: int = ROWS_PER_TASK) -> list[dict]:
    """Writes routed rows under a batch name, at most once; returns the lines recorded (none if that was done before)."""
    log = LandedLog(spark, lake_path)
    if log.is_done(batch):
        return []
    routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lines = _counted(routed, batch)
        log.begin(batch, lines)
        routes = {line["route"] for line in lines}
        if TO_LAKE in routes:
            rows = routed.where(F.col("route") == TO_LAKE).select(*_LAKE, "year", "month")
            counts = {(line["year"], line["month"]): line["n_rows"] for line in lines if line["route"] == TO_LAKE}
            (_dealt(rows, counts, rows_per_task).withColumn("batch", F.lit(batch))
             .write.mode("append").partitionBy(*schemas.LAKE_PARTITION_COLUMNS, "batch").parquet(log.lake))
        for route, side, columns in ((TO_REJECTS, REJECTS, ["value", "reason"]), (TO_UNMATCHED, UNMATCHED, _BARS)):
            if route in routes:
                routed.where(F.col("route") == route).select(*columns).write.mode("overwrite").parquet(
                    f"{log.lake}/{side}/batch={batch}")
        lines += notes or []
        log.finish(batch, lines)
        return lines
    finally:
        routed.unpersist()


def _total(lines: list[dict], totals: dict) -> dict:
    for line in lines:
        totals[line["route"]] = totals.get(line["route"], 0) + line["n_rows"]
    return totals


def stream_to_lake(messages: DataFrame, master: DataFrame, lake_path: str, checkpoint: str, cut=None,
                   value_col: str = "value", rows_per_task: int = ROWS_PER_TASK) -> dict:
    """Processes all bar messages that have landed, then stops. Returns the rows of the run by route, exactly."""
    totals: dict = {}

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # The stream's id lies in its checkpoint: another checkpoint's batches have other names.
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        routed = route_bars(typed_bars(batch, value_col), master, cut)
        _total(write_batch(spark, lake_path, f"{stream}-{number:010d}", routed, rows_per_task=rows_per_task), totals)

    query = (messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return totals


def rejected_messages(spark: SparkSession, lake_path: str) -> DataFrame:
    """``value, reason, batch`` of all messages that could not be used."""
    return _side(spark, lake_path, REJECTS, "value string, reason string")


def unmatched_bars(spark: SparkSession, lake_path: str) -> DataFrame:
    """The bars, with their ``batch``, whose ticker the master has not known so far."""
    fields = ", ".join(f"{schemas.BAR_RENAMES[f.name]} {f.dataType.simpleString()}" for f in schemas.BAR_MESSAGE)
    return _side(spark, lake_path, UNMATCHED, fields)


def _side(spark: SparkSession, lake_path: str, side: str, columns: str) -> DataFrame:
    log = LandedLog(spark, lake_path)
    rows = spark.createDataFrame([], columns + ", batch string")
    names = list_names(spark, f"{log.lake}/{side}")
    kept = {n.removeprefix("batch=") for n in names} & log.done()
    if side == UNMATCHED:
        kept -= _replayed(log)
    if not kept:
        return rows
    found = spark.read.schema(rows.schema).option("basePath", f"{log.lake}/{side}").parquet(
        *(f"{log.lake}/{side}/batch={n}" for n in sorted(kept)))
    return found.select(*rows.columns)


def _replayed(log: LandedLog) -> set[str]:
    replays = {n for n in log.done() if n.startswith("replay-")}
    return {r["reason"] for r in log.read(replays).where("route = 'replayed'").select("reason").collect()}


def replay_unmatched(spark: SparkSession, lake_path: str, master: DataFrame) -> dict:
    """Bars whose master row has come by now -> the lake, as a batch of its own. Returns the rows by route.

    The store of unmatched bars is read against the present master; if none of
    them matches, nothing is written. Else those that still do not match are kept under
    the new batch, and the batches they came from count as replayed. A replay cut
    off by a crash is done again under the same name.
    """
    log = LandedLog(spark, lake_path)
    waiting = unmatched_bars(spark, lake_path)
    known = waiting.join(master.select(F.col("ticker").alias("m_ticker")), F.col("ticker") == F.col("m_ticker"), "left_semi")
    if known.isEmpty():
        return {}
    sources = [r["batch"] for r in waiting.select("batch").distinct().collect()]
    name = f"replay-{sum(n.startswith('replay-') for n in log.done()):010d}"
    bars = waiting.select(*_BARS, F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("reason"))
    notes = [{"batch": name, "route": "replayed", "reason": s, "n_rows": 0} for s in sources]
    lines = write_batch(spark, lake_path, name, route_bars(bars, master), notes)
    for source in sources:  # recorded as replayed, so nothing reads them any more
        delete_path(spark, f"{log.lake}/{UNMATCHED}/batch={source}")
    return _total([line for line in lines if line["route"] != "replayed"], {})
