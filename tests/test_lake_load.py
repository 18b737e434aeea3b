"""Lake partitions, month scans, cuts and the incremental load."""

import datetime as dt

from pyspark.sql import functions as F

from marketflow.functions.dates import decode_cut_token, encode_cut_token, parse_day
from marketflow.operators.incremental import ParquetWarehouse, lake_cut, load_increment, read_cut
from marketflow.sinks.parquet import append_lake
from marketflow.sources.parquet import latest_partition, partition_values_from_path, scan_month_range

ROWS = "k long, transaction_date date"


def _lake(spark, path, days):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], ROWS)
    append_lake(df, path)
    return spark.read.parquet(path)


def test_month_range_over_year_end_and_missing_month(spark, scratch):
    days = [dt.date(2023, 11, 5), dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    lake = _lake(spark, scratch("lake"), days)
    got = sorted(r.transaction_date for r in scan_month_range(lake, "2023-12-20", "2024-02-02").collect())
    assert got == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert scan_month_range(lake, "2025-01-01", "2025-05-01").count() == 0


def test_latest_partition_and_cut_from_december(spark, scratch):
    lake = _lake(spark, scratch("lake"), [dt.date(2023, 12, 30), dt.date(2023, 12, 31), dt.date(2023, 5, 1)])
    p = latest_partition(lake).first()
    assert (p.year, p.month) == (2023, 12)
    assert lake_cut(lake, "2024-01-01").first().cut_date == dt.date(2023, 12, 31)
    assert lake_cut(lake, "2024-01-01", since="2023-06-15").first().cut_date == dt.date(2023, 12, 31)
    assert lake_cut(lake, "2024-01-01", since="2024-01-01").first().cut_date == dt.date(2024, 1, 1)


def test_lake_cut_default_when_empty(spark, scratch):
    path = scratch("empty")
    schema = "k long, transaction_date date, year int, month int"
    spark.createDataFrame([], schema).write.partitionBy("year", "month").parquet(path)
    lake = spark.read.schema(schema).parquet(path)
    assert lake_cut(lake, "2024-01-01").first().cut_date == dt.date(2024, 1, 1)


def test_partition_values_from_leaf_path(spark, scratch):
    path = scratch("lake")
    _lake(spark, path, [dt.date(2024, 6, 3)])
    leaf = spark.read.parquet(f"{path}/year=2024/month=6")
    assert "year" not in leaf.columns
    r = partition_values_from_path(leaf).first()
    assert (r.year, r.month) == (2024, 6)


def test_cut_token_with_newline(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 3),)], "d date")
    tok = df.select(encode_cut_token("d").alias("t"))
    assert tok.select(decode_cut_token("t").alias("c")).first().c == dt.date(2024, 6, 3)
    bad = spark.createDataFrame([("!!!not base64",), ("bm90IGEgZGF0ZQ==",), (None,)], "t string")
    assert [r.c for r in bad.select(decode_cut_token("t").alias("c")).collect()] == [None, None, None]
    text = spark.createDataFrame([("  2024-06-03\n",), ("junk",)], "t string")
    assert [r.c for r in text.select(parse_day("t").alias("c")).collect()] == [dt.date(2024, 6, 3), None]


def _orders(spark, days):
    return spark.createDataFrame([(i, d) for i, d in days], ROWS)


def test_incremental_load_idempotent(spark, scratch):
    lake_path = scratch("lake")
    wh = ParquetWarehouse(spark, scratch("wh"), partition_by={"market_data": ["year", "month"]})
    first = [(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3)), (3, dt.date(2023, 12, 31))]
    append_lake(_orders(spark, first), lake_path)
    lake = spark.read.parquet(lake_path)
    # empty cut table: start from the initial cut
    assert read_cut(wh, "2024-01-01") == dt.date(2024, 1, 1)
    s1 = load_increment(lake, wh, initial_cut="2024-01-01")
    assert s1["rows_loaded"] == 2 and s1["cut_after"] == dt.date(2024, 1, 3)
    # same load again (stored cut): nothing new, no cut written
    s2 = load_increment(spark.read.parquet(lake_path), wh, initial_cut="2024-01-01")
    assert s2["rows_loaded"] == 0
    assert wh.read("cutting_dates").count() == 1
    # rerun from the old cut (crash before the cut write): anti-join adds nothing
    s3 = load_increment(spark.read.parquet(lake_path), wh, initial_cut="2024-01-01",
                        cut="2024-01-01")
    assert s3["rows_loaded"] == 0
    # a late row for a loaded day plus a new day; lookback picks up the late one once
    append_lake(_orders(spark, [(4, dt.date(2024, 1, 3)), (5, dt.date(2024, 2, 1))]), lake_path)
    s4 = load_increment(spark.read.parquet(lake_path), wh, initial_cut="2024-01-01",
                        lookback_days=2)
    assert s4["rows_loaded"] == 2
    keys = sorted(r.k for r in wh.read("market_data").collect())
    assert keys == [1, 2, 4, 5]
    assert read_cut(wh) == dt.date(2024, 2, 1)


def test_load_twice_equals_once(spark, scratch):
    """Property: loading the same lake twice equals loading it once."""
    days = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i % 40)) for i in range(200)]
    lake_path = scratch("lake")
    append_lake(_orders(spark, days), lake_path)
    results = []
    for runs in (1, 2):
        wh = ParquetWarehouse(spark, scratch("wh"))
        for _ in range(runs):
            load_increment(spark.read.parquet(lake_path), wh, initial_cut="2023-12-31")
        results.append(sorted(r.k for r in wh.read("market_data").collect()))
    assert results[0] == results[1] == list(range(200))


def test_no_cut_anywhere_loads_nothing(spark, scratch):
    lake_path = scratch("lake")
    append_lake(_orders(spark, [(1, dt.date(2024, 1, 2))]), lake_path)
    wh = ParquetWarehouse(spark, scratch("wh"))
    out = load_increment(spark.read.parquet(lake_path), wh)
    assert out["rows_loaded"] == 0 and wh.read("market_data") is None


def test_load_with_contract_sends_bad_rows_to_rejects(spark, scratch):
    from marketflow.operators.contracts import Rule
    lake_path = scratch("lake")
    rows = [(1, dt.date(2024, 1, 2), "ok"), (2, dt.date(2024, 1, 3), "x" * 20)]
    append_lake(spark.createDataFrame(rows, "k long, transaction_date date, name string"), lake_path)
    wh = ParquetWarehouse(spark, scratch("wh"))
    out = load_increment(spark.read.parquet(lake_path), wh, initial_cut="2024-01-01",
                         contract=[Rule("name", max_length=10)], reject_table="rejects")
    assert out["rows_loaded"] == 1 and out["rows_rejected"] == 1
    assert out["cut_after"] == dt.date(2024, 1, 3)
    assert [r.k for r in wh.read("market_data").collect()] == [1]
    rej = wh.read("rejects").first()
    assert rej.k == 2 and rej.violations == "name_too_long"


def test_partition_values_missing_in_path_are_null(spark, scratch):
    path = scratch("flat")
    spark.createDataFrame([(1,)], "k long").write.parquet(path)
    r = partition_values_from_path(spark.read.parquet(path)).first()
    assert r.year is None and r.month is None


def test_reruns_repeat_nothing_and_never_lower_the_cut(spark, scratch):
    from marketflow.operators.contracts import Rule
    from marketflow.session import shared_dir
    lake_path = scratch("lake")
    D = dt.date
    rows = [(1, D(2024, 1, 2), "ok"), (None, D(2024, 1, 2), "null key"), (2, D(2024, 1, 2), "x" * 20), (3, D(2024, 1, 5), None)]
    append_lake(spark.createDataFrame(rows, "k long, transaction_date date, name string"), lake_path)
    wh = ParquetWarehouse(spark, scratch("wh"))
    kwargs = dict(initial_cut="2023-12-01", lookback_days=10, contract=[Rule("name", max_length=10)], reject_table="rejects")
    outs = [load_increment(spark.read.parquet(lake_path), wh, **kwargs) for _ in range(3)]
    assert [(o["rows_loaded"], o["rows_rejected"]) for o in outs] == [(3, 1), (0, 0), (0, 0)]
    assert [o["cut_after"] for o in outs] == [D(2024, 1, 5)] * 3
    assert (wh.read("market_data").count(), wh.read("rejects").count(), wh.read("cutting_dates").count()) == (3, 1, 1)
    # a crash after the rejects were written: data and cut follow, the reject is not repeated
    crashed = ParquetWarehouse(spark, scratch("wh"))
    crashed.append("rejects", wh.read("rejects"))
    assert load_increment(spark.read.parquet(lake_path), crashed, **kwargs)["rows_loaded"] == 3
    assert crashed.read("rejects").count() == 1
    # an older late row leaves the cut where it is
    append_lake(spark.createDataFrame([(9, D(2024, 1, 1), "late")], "k long, transaction_date date, name string"), lake_path)
    out = load_increment(spark.read.parquet(lake_path), wh, **kwargs)
    assert out["rows_loaded"] == 1 and out["cut_after"] == D(2024, 1, 5) and wh.read("cutting_dates").count() == 1
    # no staged copy stays behind
    fs = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark) + "/marketflow")
    names = [f.getPath().getName() for f in fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(fs)]
    assert not [n for n in names if n.startswith("stage-market_data")]


def test_daily_cut_opens_one_months_files(spark, scratch):
    lake_path = scratch("lake")
    append_lake(_orders(spark, [(m, dt.date(2023, m, 3)) for m in range(1, 13)]), lake_path)
    lake = spark.read.parquet(lake_path)
    cut = lake_cut(lake, "2020-01-01", since="2023-12-01")
    assert cut.first().cut_date == dt.date(2023, 12, 3)
    month = lake.where("year = 2023 AND month = 12")
    assert len(cut.inputFiles()) <= len(lake.inputFiles())
    assert "PartitionFilters: [isnotnull(year" in cut._jdf.queryExecution().executedPlan().toString()
    assert month.count() == 1
