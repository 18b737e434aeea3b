"""Stream runners: source -> the batch transforms -> Parquet file sink.

The file sink with a checkpoint gives exactly-once files: a rerun with no new
input adds nothing, and readers of the output root only see committed files.
``availableNow`` processes what has landed, in bounded micro-batches, then
stops, replacing a wall-clock stop.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketflow import schemas
from marketflow.functions.json import parse_messages
from marketflow.operators.enrich import bars_from_messages, enrich


class RunTotals(StreamingQueryListener):
    """Adds up, as they are reported, the input rows of every run's micro-batches, however many there are, their
    named observed metrics (``NAME.FIELD``) and the rows their state left out as too late (``late``)."""

    def __init__(self):
        self.sums: dict[str, dict[str, int]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        sums = self.sums.setdefault(str(progress.runId), {})
        found = {"rows": progress.numInputRows, "late": sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)}
        for name, row in progress.observedMetrics.items():
            found.update({f"{name}.{k}": v for k, v in row.asDict().items()})
        for key, value in found.items():
            sums[key] = sums.get(key, 0) + value

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, query: StreamingQuery, timeout: float = 60.0) -> dict[str, int]:
        """The sums of a query that has ended; its last report comes before that of its end."""
        run = str(query.runId)
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, timeout):
                raise RuntimeError("the end of the query was not reported")
        return {"rows": 0, "late": 0, **self.sums.get(run, {})}


def start_file_sink(df: DataFrame, path: str, checkpoint: str,
                    partition_by: list[str] | None = None, fmt: str = "parquet",
                    available_now: bool = True, processing_time: str | None = None,
                    query_name: str | None = None) -> StreamingQuery:
    """Append a stream to files with its own checkpoint folder (kept apart
    from the output folder)."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_console_sink(df: DataFrame, num_rows: int = 20) -> StreamingQuery:
    """Print each micro-batch (debugging only; rows go to the driver log)."""
    return (df.writeStream.format("console").outputMode("append")
            .option("numRows", num_rows).option("truncate", "false").start())


def run_available_now(df: DataFrame, path: str, checkpoint: str,
                      partition_by: list[str] | None = None, fmt: str = "parquet") -> int:
    """Process everything that has landed, then stop. Returns the input rows
    of the run, summed over all its micro-batches."""
    return run_totals(df, path, checkpoint, partition_by, fmt)["rows"]


def run_totals(df: DataFrame, path: str, checkpoint: str,
               partition_by: list[str] | None = None, fmt: str = "parquet") -> dict[str, int]:
    """``run_available_now`` with all the sums of ``RunTotals``."""
    totals = RunTotals()
    df.sparkSession.streams.addListener(totals)
    try:
        query = start_file_sink(df, path, checkpoint, partition_by, fmt, available_now=True)
        query.awaitTermination()
        return totals.of(query)
    finally:
        df.sparkSession.streams.removeListener(totals)


def run_for(query: StreamingQuery, seconds: float, poll_seconds: float = 10.0) -> None:
    """Stop a continuously triggered query after ``seconds`` (bounded run)."""
    deadline = time.monotonic() + seconds
    while query.isActive and time.monotonic() < deadline:
        query.awaitTermination(poll_seconds)
    if query.isActive:
        query.stop()


def enrich_stream(messages: DataFrame, master: DataFrame, cut=None,
                  value_col: str = "value") -> DataFrame:
    """Bar messages (Kafka or file stream) -> enriched, partition-ready rows.

    The master is a static frame (stream-static inner join, no state); the
    cut is fixed for the run, the checkpoint tracks progress.
    """
    bars = bars_from_messages(parse_messages(messages, schemas.BAR_MESSAGE, value_col))
    return enrich(bars, master, cut)


def master_ingest_stream(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Ticker master messages -> typed master rows (raw, with versions)."""
    return parse_messages(messages, schemas.MASTER_MESSAGE, value_col)
