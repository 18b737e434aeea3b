"""Streaming runner: file stream, availableNow, reruns, batch = stream."""

import datetime as dt
import json

from marketflow import schemas
from marketflow.operators.enrich import enrich
from marketflow.operators.master import clean_master
from marketflow.sources.messages import read_message_files
from marketflow.streaming.runner import enrich_stream, master_ingest_stream, run_available_now


def _land(spark, path, objs):
    spark.createDataFrame([(json.dumps(o),) for o in objs], "value string") \
        .coalesce(1).write.mode("append").text(path)


def _master_msgs(tickers):
    return [{"ticker": t, "name": f"n{t}", "market": "stocks", "locale": "us",
             "primary_exchange": "X", "type": "CS", "active": True, "currency_name": "usd",
             "cik": "1", "last_updated_utc": "2024-01-01T00:00:00Z"} for t in tickers]


def test_master_stream_rerun_adds_nothing_then_new_file(spark, scratch):
    landing, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    _land(spark, landing, _master_msgs(["A", "B", "C"]))
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True))
    assert run_available_now(stream, out, ckpt) == 3
    assert run_available_now(stream, out, ckpt) == 0
    assert spark.read.parquet(out).count() == 3
    _land(spark, landing, _master_msgs(["D", "E"]))
    assert run_available_now(stream, out, ckpt) == 2
    assert sorted(r.ticker for r in spark.read.parquet(out).collect()) == list("ABCDE")


def _bar_msgs(rows):
    return [{"T": t, "v": 1, "vw": 1.5, "o": 1, "c": 2, "h": 3, "l": 0.5, "n": 1, "date_time": d}
            for t, d in rows]


def test_enrich_stream_equals_batch_and_stray_file_unseen(spark, scratch):
    master = clean_master(spark.createDataFrame(
        [tuple(m.values()) for m in _master_msgs(["A", "B"])],
        schemas.MASTER_MESSAGE))
    landing, out, ckpt = scratch("bars"), scratch("lake"), scratch("ckpt")
    rows = [("A", "2024-06-02"), ("A", "2024-06-04"), ("B", "2024-07-01"), ("Z", "2024-07-02"),
            ("B", "2025-01-02")]
    _land(spark, landing, _bar_msgs(rows[:3]))
    stream = enrich_stream(read_message_files(spark, landing, streaming=True), master, "2024-06-03")
    run_available_now(stream, out, ckpt, partition_by=["year", "month"])
    _land(spark, landing, _bar_msgs(rows[3:]))
    run_available_now(stream, out, ckpt, partition_by=["year", "month"])
    got = spark.read.parquet(out)
    batch_in = spark.createDataFrame([(json.dumps(o),) for o in _bar_msgs(rows)], "value string")
    expected = enrich_stream(batch_in, master, "2024-06-03")
    cols = sorted(got.columns)
    assert sorted(got.select(cols).collect()) == sorted(expected.select(cols).collect())
    assert got.count() == 3
    # a stray file written into a partition outside the commit log: the root
    # read (which follows the sink's log) does not see it; a leaf read does
    stray = f"{out}/year=2024/month=7"
    leaf_before = spark.read.parquet(stray).count()
    spark.read.parquet(stray).write.mode("append").parquet(stray)
    assert spark.read.parquet(out).count() == 3
    assert spark.read.parquet(stray).count() == 2 * leaf_before


def test_bounded_run_stops_continuous_query(spark, scratch):
    from marketflow.streaming.runner import run_for, start_file_sink
    landing, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    _land(spark, landing, _master_msgs(["A"]))
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True))
    query = start_file_sink(stream, out, ckpt, available_now=False, processing_time="1 second")
    query.processAllAvailable()
    run_for(query, seconds=1.0, poll_seconds=0.5)
    assert not query.isActive
    assert spark.read.parquet(out).count() == 1


def test_enrich_stream_without_broadcast(spark, scratch):
    """Master above the broadcast limit: the stream-static join shuffles."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        master = clean_master(spark.createDataFrame(
            [tuple(m.values()) for m in _master_msgs(["A", "B"])], schemas.MASTER_MESSAGE))
        landing, out, ckpt = scratch("bars"), scratch("lake"), scratch("ckpt")
        _land(spark, landing, _bar_msgs([("A", "2024-06-04"), ("B", "2024-07-01"), ("Z", "2024-07-02")]))
        stream = enrich_stream(read_message_files(spark, landing, streaming=True), master, "2024-06-03")
        run_available_now(stream, out, ckpt, partition_by=["year", "month"])
        assert sorted(r.ticker for r in spark.read.parquet(out).collect()) == ["A", "B"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_available_now_in_bounded_batches(spark, scratch):
    landing, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    _land(spark, landing, _master_msgs(["A", "B"]))
    _land(spark, landing, _master_msgs(["C"]))
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True,
                                                     max_files_per_trigger=1))
    assert run_available_now(stream, out, ckpt) == 3
    assert sorted(r.ticker for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]


def test_console_sink_and_master_ingest_job(spark, scratch):
    from marketflow.plans.jobs import ingest_master
    from marketflow.streaming.runner import start_console_sink
    landing, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    _land(spark, landing, _master_msgs(["A", "B"]))
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True))
    query = start_console_sink(stream, num_rows=5)
    try:
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    messages = read_message_files(spark, landing, streaming=True)
    assert ingest_master(spark, messages, out, ckpt) == 2
    assert sorted(r.ticker for r in spark.read.parquet(out).collect()) == ["A", "B"]


def test_input_rows_of_more_than_100_batches_are_all_counted(spark, scratch):
    landing, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    spark.createDataFrame([(json.dumps(m),) for m in _master_msgs([f"T{i}" for i in range(110)])], "value string") \
        .repartition(110).write.mode("append").text(landing)
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True, max_files_per_trigger=1))
    assert run_available_now(stream, out, ckpt) == 110


def test_streamed_lake_has_few_files_and_refuses_batch_appends(spark, scratch):
    import pytest

    from marketflow.plans.jobs import backfill_streamed_lake
    from marketflow.sinks.parquet import append_lake
    landing, master, lake, ckpt = (scratch(n) for n in ("bars", "master", "lake", "ckpt"))
    clean_master(spark.createDataFrame([tuple(m.values()) for m in _master_msgs(["A", "B"])],
                                       schemas.MASTER_MESSAGE)).write.parquet(master)

    def messages(month):
        return spark.createDataFrame([(x,) for x in map(json.dumps, _bar_msgs(
            [(t, f"2024-{month:02d}-{d:02d}") for t in "AB" for d in range(1, 20)]))], "value string").repartition(8)
    assert backfill_streamed_lake(spark, messages(7), landing, master, lake, ckpt) == {"lake": 38}
    backfill_streamed_lake(spark, messages(6), landing, master, lake, ckpt)
    rows = spark.read.parquet(lake)
    assert rows.count() == 76
    assert len(rows.inputFiles()) == 2  # one a month
    with pytest.raises(ValueError, match="stream"):
        append_lake(rows, lake)
