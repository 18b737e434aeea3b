"""The streamed lake with its record: routes, crashes, replays, loads of what landed."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators.enrich import route_bars, typed_bars
from marketflow.operators.incremental import ParquetWarehouse, lake_cut, load_landed
from marketflow.operators.contracts import Rule
from marketflow.plans import catalog, jobs
from marketflow.session import list_names
from marketflow.sinks.landed import LandedLog
from marketflow.sinks.parquet import append_lake
from marketflow.sources.messages import read_message_files
from marketflow.sources.parquet import newest_month, read_lake
from marketflow.streaming import lake as L


def _bar(ticker, day, v=1.0):
    return json.dumps({"T": ticker, "v": v, "vw": 1.5, "o": 1, "c": 2, "h": 3, "l": 0.5, "n": 1, "t": 17, "date_time": day})


def _land(spark, path, lines, files=1):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.mode("append").text(path)


def _messages(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _master(spark, tickers, name="n"):
    rows = [(t, name, "stocks", "us", "X", "CS", True, "usd", "1") for t in tickers]
    return spark.createDataFrame(rows, "ticker string, name string, market string, locale string, primary_exchange string, "
                                       "type string, active boolean, currency_name string, cik string")


def _stream(spark, landing, master, lake, ckpt, cut=None, **kw):
    return L.stream_to_lake(read_message_files(spark, landing, streaming=True, **kw), master, lake, ckpt, cut)


def _days(df):
    return sorted((r.ticker, str(r.transaction_date)) for r in df.collect())


def test_every_message_takes_one_route(spark, scratch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    good = [_bar("A", "2024-06-04"), _bar("A", "2024-06-04"), _bar("B", "2024-07-01")]
    bad = ['{"T":"A","v":', "junk", "[]", json.dumps({"T": "A", "v": 1}), json.dumps({"date_time": "2024-06-04"}),
           json.dumps({"T": "A", "date_time": "4 June"})]
    half = [_bar("B", "2024-07-02", v="many")]  # one bad field beside a good key: usable, null field
    _land(spark, landing, good + bad + half + [_bar("Z", "2024-07-03"), _bar("A", "2024-01-01")])
    routes = _stream(spark, landing, _master(spark, "AB"), lake, ckpt, cut="2024-06-01")
    assert routes == {"lake": 4, "rejected": 6, "unmatched": 1, "before_cut": 1}
    rejects = sorted((r.reason, r.value) for r in L.rejected_messages(spark, lake).collect())
    assert rejects == sorted([("malformed", bad[0]), ("malformed", bad[1]), ("malformed", bad[2]), ("no_day", bad[3]),
                              ("no_ticker", bad[4]), ("malformed", bad[5])])
    assert [(r.ticker, r.volume) for r in L.unmatched_bars(spark, lake).collect()] == [("Z", 1.0)]
    rows = read_lake(spark, lake)
    assert rows.columns == [f.name for f in schemas.ENRICHED_BAR] + ["year", "month"]
    assert rows.where("volume is null").count() == 1
    lines = LandedLog(spark, lake).read()
    assert lines.agg(F.sum("n_rows")).first()[0] == 12
    june = lines.where("route = 'lake' and month = 6").first()
    assert (june.year, june.n_rows, june.first_day, june.last_day) == (2024, 2, dt.date(2024, 6, 4), dt.date(2024, 6, 4))


def test_messages_without_a_ticker_are_spread_over_the_join(spark):
    """In a shuffled join; a number for a ticker meets none of them."""
    lines = ["broken"] * 3000 + [json.dumps({"v": 1, "date_time": "2024-06-04"})] * 1000 + [_bar("7", "2024-06-04")] * 40
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        routed = route_bars(typed_bars(_messages(spark, lines).repartition(2)), _master(spark, [str(i) for i in range(3000)]))
        sizes = [r["count"] for r in routed.where("route = 'rejected'").groupBy(F.spark_partition_id()).count().collect()]
        routes = {r["route"]: (r["n"], r["named"]) for r in routed.groupBy("route").agg(
            F.count("*").alias("n"), F.count("name").alias("named")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert routes == {"rejected": (4000, 0), "lake": (40, 40)}
    assert len(sizes) == 8 and max(sizes) < 1000


def test_bars_before_the_cut_are_counted_without_their_values(spark):
    """A master with a ticker twice multiplies bars on both sides of the cut, as a join does."""
    lines = [_bar("A", "2024-06-04"), _bar("A", "2024-01-01"), _bar("B", "2024-01-01"), json.dumps({"T": "A", "date_time": "x", "v": 3.0})]
    routed = route_bars(typed_bars(_messages(spark, lines)), _master(spark, "AA"), "2024-02-01")
    rows = sorted((r.route, r.ticker, r.month, r.volume, r.close_price, r.name) for r in routed.where("route != 'rejected'").collect())
    assert rows == [("before_cut", "A", 1, None, None, "n")] * 2 + [("before_cut", "B", 1, None, None, None)] + [("lake", "A", 6, 1.0, 2.0, "n")] * 2
    assert [(r.reason, r.volume, r.value) for r in routed.where("route = 'rejected'").collect()] == [("malformed", 3.0, lines[3])] * 2


def test_packed_landing(spark, scratch, monkeypatch):
    """Fewer bytes than the texts, few texts a file, and the same texts for a reader."""
    monkeypatch.setattr(catalog, "LANDED_ROWS", 300)
    path = scratch("packed")
    lines = [_bar(str(i % 50), "2024-06-04", v=float(i)) for i in range(1000)]
    for some in (lines[:500], lines[500:]):
        catalog._land_packed(_messages(spark, some).coalesce(1), path)
    files = glob.glob(f"{path.removeprefix('file:')}/part-*")
    assert len(files) == 4 and sum(map(os.path.getsize, files)) < sum(map(len, lines)) / 2
    assert sorted(r.value for r in read_message_files(spark, path).collect()) == sorted(lines)


def test_null_and_empty_messages_are_rejected(spark):
    rows = route_bars(typed_bars(_messages(spark, [None, "", " "])), _master(spark, "A")).collect()
    assert [(r.route, r.reason) for r in rows] == [("rejected", "malformed")] * 3
    assert route_bars(typed_bars(_messages(spark, ["x"]).limit(0)), _master(spark, "A")).count() == 0


def test_many_micro_batches_are_counted_exactly(spark, scratch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    _land(spark, landing, [_bar("A", f"2024-06-{1 + i % 28:02d}") for i in range(9)] + ["x"], files=5)
    assert _stream(spark, landing, _master(spark, "A"), lake, ckpt, max_files_per_trigger=1) == {"lake": 9, "rejected": 1}
    assert len(LandedLog(spark, lake).done()) == 5
    assert _stream(spark, landing, _master(spark, "A"), lake, ckpt) == {}
    assert read_lake(spark, lake).count() == 9


def test_one_months_batch_is_written_by_several_tasks(spark, scratch):
    """All bars of a day are one month, and one ticker: the size decides, not a key."""
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    spark.range(40_000).select(F.format_string('{"T":"A","v":%d,"c":%d,"date_time":"2024-06-04"}', "id", "id").alias("value")) \
        .repartition(8).write.text(landing)
    _land(spark, landing, [_bar("A", "2024-07-04"), _bar("A", "2024-08-04")])
    stream = read_message_files(spark, landing, streaming=True)
    assert L.stream_to_lake(stream, _master(spark, "A"), lake, ckpt, rows_per_task=6000) == {"lake": 40_002}
    files = glob.glob(lake.replace("file:", "") + "/year=2024/month=6/batch=*/*.parquet")
    sizes = [spark.read.parquet(f).count() for f in files]
    assert len(files) == 7 and max(sizes) < 6600 and sum(sizes) == 40_000
    assert len(glob.glob(lake.replace("file:", "") + "/year=2024/month=[78]/batch=*/*.parquet")) == 2


def test_months_are_dealt_by_their_counts():
    months = {(2024, 1): 5, (2024, 2): 5, (2024, 3): 25, (2024, 4): 4, (2024, 5): 10, (2023, 12): 1}
    dealt, tasks = L.deal_months(months, 10)
    assert dealt == {(2023, 12): (0, 1), (2024, 1): (0, 1), (2024, 2): (1, 1), (2024, 3): (2, 3), (2024, 4): (5, 1), (2024, 5): (6, 1)}
    assert tasks == 7


def test_batch_cut_off_by_a_crash_counts_once(spark, scratch, monkeypatch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    master = _master(spark, "AB")
    _land(spark, landing, [_bar("A", "2024-06-04"), _bar("B", "2024-07-01"), _bar("Z", "2024-07-01"), "x"])
    finish = LandedLog.finish

    def crash(self, *a):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(LandedLog, "finish", crash)
    with pytest.raises(Exception, match="driver lost"):
        _stream(spark, landing, master, lake, ckpt)
    monkeypatch.setattr(LandedLog, "finish", finish)
    # Written, but not part of the lake: readers and loads leave it out.
    assert spark.read.parquet(lake).count() == 2 and read_lake(spark, lake).count() == 0
    wh = ParquetWarehouse(spark, scratch("wh"))
    assert load_landed(spark, lake, wh, initial_cut="2024-01-01")["rows_loaded"] == 0
    assert L.rejected_messages(spark, lake).count() == 0
    # The master has lost B in the meantime: what the first try wrote of it is cleared.
    assert _stream(spark, landing, _master(spark, "A"), lake, ckpt) == {"lake": 1, "unmatched": 2, "rejected": 1}
    assert _days(read_lake(spark, lake)) == [("A", "2024-06-04")] and spark.read.parquet(lake).count() == 1
    assert L.rejected_messages(spark, lake).count() == 1 and L.unmatched_bars(spark, lake).count() == 2


def test_finished_batch_is_not_run_again(spark, scratch, monkeypatch):
    """The crash falls between the record and the stream's own checkpoint."""
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    _land(spark, landing, [_bar("A", "2024-06-04")])
    write = L.write_batch

    def then_crash(*a, **k):
        write(*a, **k)
        raise RuntimeError("driver lost")
    monkeypatch.setattr(L, "write_batch", then_crash)
    with pytest.raises(Exception, match="driver lost"):
        _stream(spark, landing, _master(spark, "A"), lake, ckpt)
    monkeypatch.setattr(L, "write_batch", write)
    assert _stream(spark, landing, _master(spark, "A"), lake, ckpt) == {}
    assert read_lake(spark, lake).count() == 1
    # A stream of another checkpoint has batch numbers of its own.
    assert _stream(spark, landing, _master(spark, "A"), lake, scratch("other")) == {"lake": 1}
    assert read_lake(spark, lake).count() == 2


def test_replay_brings_waiting_bars_once(spark, scratch, monkeypatch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    _land(spark, landing, [_bar("A", "2024-06-04"), _bar("B", "2024-07-01"), _bar("C", "2024-07-01"), _bar("B", "2023-01-01")])
    assert L.replay_unmatched(spark, lake, _master(spark, "A")) == {}  # no lake yet
    _stream(spark, landing, _master(spark, "A"), lake, ckpt)
    before = LandedLog(spark, lake).done()
    assert L.replay_unmatched(spark, lake, _master(spark, "A")) == {} and LandedLog(spark, lake).done() == before
    finish = LandedLog.finish
    monkeypatch.setattr(LandedLog, "finish", lambda self, *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        L.replay_unmatched(spark, lake, _master(spark, "AB"))
    monkeypatch.setattr(LandedLog, "finish", finish)
    assert read_lake(spark, lake).count() == 1 and L.unmatched_bars(spark, lake).count() == 3
    assert L.replay_unmatched(spark, lake, _master(spark, "AB", "late")) == {"lake": 2, "unmatched": 1}
    assert _days(read_lake(spark, lake)) == [("A", "2024-06-04"), ("B", "2023-01-01"), ("B", "2024-07-01")]
    assert read_lake(spark, lake).where("name = 'late'").count() == 2
    assert [r.ticker for r in L.unmatched_bars(spark, lake).collect()] == ["C"]
    assert L.replay_unmatched(spark, lake, _master(spark, "ABC")) == {"lake": 1}
    assert L.unmatched_bars(spark, lake).count() == 0 and L.replay_unmatched(spark, lake, _master(spark, "ABC")) == {}


def test_load_takes_the_batches_that_are_new(spark, scratch):
    landing, lake, ckpt, root = scratch("in"), scratch("lake"), scratch("ckpt"), scratch("wh")
    wh = ParquetWarehouse(spark, root, partition_by={"market_data": ["year", "month"]})
    load = lambda **k: load_landed(spark, lake, wh, initial_cut="2023-01-01", **k)
    master = _master(spark, "ABC")
    _land(spark, landing, [_bar("A", "2024-06-04"), _bar("A", "2024-06-04"), _bar("B", "2022-12-31")])
    _stream(spark, landing, master, lake, ckpt)
    out = load()
    assert (out["rows_loaded"], out["batches"], out["cut_after"]) == (1, 1, dt.date(2024, 6, 4))
    assert load()["batches"] == 0
    # Two years late, and a copy of a row that is there.
    _land(spark, landing, [_bar("C", "2023-01-02"), _bar("A", "2024-06-04")])
    _stream(spark, landing, master, lake, ckpt)
    out = load()
    assert (out["rows_loaded"], out["cut_before"], out["cut_after"]) == (1, dt.date(2024, 6, 4), dt.date(2024, 6, 4))
    assert _days(wh.read("market_data")) == [("A", "2024-06-04"), ("C", "2023-01-02")]

    class Crashing(ParquetWarehouse):
        def append(self, table, df):
            if table == "loaded_batches":
                raise RuntimeError("driver lost")
            super().append(table, df)
    _land(spark, landing, [_bar("B", "2024-05-01"), _bar("B", "2024-08-01")])
    _stream(spark, landing, master, lake, ckpt)
    with pytest.raises(RuntimeError):
        load_landed(spark, lake, Crashing(spark, root, wh.partition_by), initial_cut="2023-01-01")
    out = load()
    assert (out["rows_loaded"], out["batches"], out["cut_after"]) == (0, 1, dt.date(2024, 8, 1))
    assert wh.read("market_data").count() == 4


def test_load_rejects_rows_against_the_contract_once(spark, scratch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    wh = ParquetWarehouse(spark, scratch("wh"))
    _land(spark, landing, [_bar("LONGER", "2024-06-04"), _bar("A", "2024-06-05")])
    _stream(spark, landing, _master(spark, ["LONGER", "A"]), lake, ckpt)
    kwargs = dict(initial_cut="2024-01-01", drop_columns=["year", "month"], contract=[Rule("ticker", max_length=3)], reject_table="rejects")
    out = load_landed(spark, lake, wh, **kwargs)
    assert (out["rows_loaded"], out["rows_rejected"]) == (1, 1)
    wh.overwrite("loaded_batches", spark.createDataFrame([], schemas.BATCH_TABLE))
    out = load_landed(spark, lake, wh, **kwargs)
    assert (out["rows_loaded"], out["rows_rejected"], out["batches"]) == (0, 0, 1)
    assert [r.violations for r in wh.read("rejects").collect()] == ["ticker_too_long"]


def test_load_opens_only_the_new_batches_files(spark, scratch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    wh = ParquetWarehouse(spark, scratch("wh"))
    master = _master(spark, "AB")
    _land(spark, landing, [_bar("A", "2024-06-04")])
    _stream(spark, landing, master, lake, ckpt)
    load_landed(spark, lake, wh, initial_cut="2024-01-01")
    old = glob.glob(lake.replace("file:", "") + "/year=2024/month=6/batch=*/*.parquet")
    _land(spark, landing, [_bar("B", "2024-06-05")])
    _stream(spark, landing, master, lake, ckpt)
    for file in old:
        size = os.path.getsize(file)
        with open(file, "r+b") as f:  # the footer stays: only reading its data would fail
            f.write(b"\0" * (size // 3))
    assert load_landed(spark, lake, wh, initial_cut="2024-01-01")["rows_loaded"] == 1


def test_newest_month_opens_no_data_file(spark, scratch):
    plain = scratch("plain")
    days = spark.range(40).select(F.add_months(F.lit(dt.date(2021, 10, 15)), F.col("id").cast("int")).alias("transaction_date"), "id")
    append_lake(days, plain)
    newest = newest_month(spark, plain)
    assert newest == (2025, 1)
    files = glob.glob(plain.replace("file:", "") + "/year=*/month=*/*.parquet")
    assert len(files) == 40
    for file in files:
        if "year=2025" not in file:
            open(file, "wb").close()  # opening any of these fails
    rows = spark.read.schema("transaction_date date, id long, year int, month int").parquet(plain)
    assert lake_cut(rows, newest=newest).first().cut_date == dt.date(2025, 1, 15)
    os.makedirs(f"{plain.replace('file:', '')}/year=2026/month=01")
    os.makedirs(f"{plain.replace('file:', '')}/year=__HIVE_DEFAULT_PARTITION__")
    assert newest_month(spark, plain) == (2025, 1)
    assert newest_month(spark, scratch("none")) is None


def test_cut_token_of_a_recorded_lake(spark, scratch):
    landing, lake, ckpt = scratch("in"), scratch("lake"), scratch("ckpt")
    _land(spark, landing, [_bar("A", "2024-06-04"), _bar("A", "2023-12-31"), _bar("Z", "2025-01-01")])
    _stream(spark, landing, _master(spark, "A"), lake, ckpt)
    assert newest_month(spark, lake) == (2024, 6)
    assert jobs.lake_cut_token(spark, lake, "2020-01-01").first().cut_date == dt.date(2024, 6, 4)
    with pytest.raises(ValueError, match="stream"):
        append_lake(read_lake(spark, lake), lake)
    assert list_names(spark, f"{lake}/_landed") == [f"{n}.json" for n in LandedLog(spark, lake).done()]
