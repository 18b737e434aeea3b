"""The daily job end to end on small landed inputs."""

import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators.calendar import request_days
from marketflow.operators.incremental import ParquetWarehouse, read_cut
from marketflow.plans import catalog, jobs
from marketflow.plans.jobs import daily_run, lake_cut_token


def _land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(path)


def _master(t, name, version):
    return (t, name, "stocks", "us", "X", "CS", True, "usd", "1", version)


def test_daily_run(spark, scratch):
    raw, master, bars, lake, ckpt, news = (scratch(n) for n in
                                           ("raw", "master", "bars", "lake", "ckpt", "news"))
    spark.createDataFrame([_master("A", "old", "2024-01-01"), _master("A", "new", "2024-02-01"),
                           _master("B", "b", "2024-01-01")], schemas.MASTER_MESSAGE) \
        .write.parquet(raw)
    msgs = [{"T": t, "v": 10, "vw": 1.0, "o": 1, "c": c, "h": 2, "l": 0.5, "n": 3, "date_time": d}
            for t, d, c in [("A", "2024-06-03", 1.0), ("A", "2024-06-04", 1.1), ("B", "2024-06-04", 5.0),
                            ("Z", "2024-06-04", 9.0)]]
    _land(spark, bars, [json.dumps(m) for m in msgs])
    article = {"title": "t", "publisher": {"name": "p"}, "author": "a",
               "published_utc": "2024-06-04T10:00:00Z",
               "insights": [{"ticker": "A", "sentiment": "positive"},
                            {"ticker": "B", "sentiment": "far too long a label"}]}
    _land(spark, news, [json.dumps([article, article])])
    wh = ParquetWarehouse(spark, scratch("wh"))
    out = daily_run(spark, master_raw_path=raw, master_path=master, bar_messages_path=bars,
                    lake_path=lake, lake_checkpoint=ckpt, warehouse=wh, news_texts_path=news,
                    tickers="A,B", initial_cut="2024-06-01", first_day_after="2024-01-01",
                    horizon_days=None)
    assert out["bars_in"] == 4
    assert out["load"]["rows_loaded"] == 3
    assert out["articles"] == {"rows_published": 1, "rows_rejected": 1, "texts_unparsed": 0, "articles_undated": 0}
    assert [r.violations for r in wh.read("articles_rejects").collect()] == ["sentiment_too_long"]
    data = wh.read("market_data")
    assert sorted((r.ticker, r.name) for r in data.collect()) == [("A", "new"), ("A", "new"), ("B", "b")]
    assert read_cut(wh) == dt.date(2024, 6, 4)
    tok = lake_cut_token(spark, lake, "2024-01-01").first()
    assert tok.cut_date == dt.date(2024, 6, 4)
    assert base64.b64decode(tok.token).decode().strip() == "2024-06-04"
    arts = wh.read("articles").collect()
    assert len(arts) == 1 and arts[0].related_ticker == "A,B"
    # second day: nothing new lands -> nothing loaded, cut unchanged
    out2 = daily_run(spark, master_raw_path=raw, master_path=master, bar_messages_path=bars,
                     lake_path=lake, lake_checkpoint=ckpt, warehouse=wh, news_texts_path=news,
                     tickers="A,B", initial_cut="2024-06-01", first_day_after="2024-01-01",
                    horizon_days=None)
    assert out2["bars_in"] == 0 and out2["load"]["rows_loaded"] == 0
    assert wh.read("market_data").count() == 3


def test_request_days_until_yesterday(spark):
    days = [r.day for r in request_days(spark, "2024-06-01", "2024-06-03").collect()]
    assert days == [dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 3)]
    last = request_days(spark, dt.date.today() - dt.timedelta(days=3)).collect()
    assert len(last) == 3
    paths = request_days(spark, "2024-06-01", "2024-06-02", base_path="bars/").collect()
    assert [r.path for r in paths] == ["bars/2024-06-01", "bars/2024-06-02"]


def test_sentiment_study_from_articles_and_lake(spark):
    from marketflow.plans.jobs import sentiment_study
    D = dt.date.fromisoformat
    bars = spark.createDataFrame(
        [("A", D("2024-06-03"), 100.0), ("A", D("2024-06-04"), 110.0), ("A", D("2024-06-04"), 110.0),
         ("A", D("2024-06-05"), 99.0), ("A", D("2024-06-07"), 118.8)],
        "ticker string, transaction_date date, close_price double")
    arts = spark.createDataFrame(
        [("A", "2024-06-04", "positive"), ("A", "2024-06-05", "negative"),
         ("A", "2024-06-06", "positive"), ("A", "2024-06-06", "positive"), ("A", "2024-06-09", "x")],
        "ticker string, publication_date string, sentiment string")
    row = sentiment_study(arts, bars).first()
    # 06-06 (no bar) rolls to 06-07; 06-09 has no label score and no later bar
    assert row.ticker == "A" and row.n_pairs == 3 and row.corr > 0.9


def test_enrich_batch_to_lake(spark, scratch):
    from marketflow.plans.jobs import enrich_batch_to_lake
    master = scratch("master")
    spark.createDataFrame([_master("A", "a", "v1")], schemas.MASTER_MESSAGE) \
        .drop("last_updated_utc").write.parquet(master)
    bars = spark.createDataFrame(
        [("A", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, dt.date(2024, 6, 4)),
         ("A", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, dt.date(2024, 7, 1)),
         ("A", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, dt.date(2024, 6, 1))],
        "ticker string, volume double, volume_weighted double, open_price double, close_price double, "
        "high_price double, low_price double, number_of_transaction int, transaction_date date")
    lake = scratch("lake")
    enrich_batch_to_lake(spark, bars, master, lake, cut="2024-06-03")
    got = sorted((r.year, r.month, r.name) for r in spark.read.parquet(lake).collect())
    assert got == [(2024, 6, "a"), (2024, 7, "a")]


def test_publish_articles_table_shape(spark, scratch):
    from marketflow.plans.jobs import publish_articles
    news = scratch("news")
    article = {"title": "t", "publisher": {"name": "p"}, "author": "a",
               "published_utc": "2024-06-04T10:00:00Z",
               "insights": [{"ticker": "A", "sentiment": "positive"}]}
    _land(spark, news, [json.dumps([article])])
    wh = ParquetWarehouse(spark, scratch("wh"))
    out = publish_articles(spark, news, "A", wh, table_shape=True)
    assert out == {"rows_published": 1, "rows_rejected": 0, "texts_unparsed": 0, "articles_undated": 0}
    rows = wh.read("articles")
    assert rows.columns == ["article_title", "publisher", "author", "publication_date", "ticker",
                            "sentiment"]
    assert rows.first().publication_date == dt.date(2024, 6, 4)


def test_late_bars_reach_lake_and_warehouse(spark, scratch):
    """A bar of a day already loaded, or of an earlier one, that lands later is not lost."""
    p = {n: scratch(n) for n in ("raw", "master", "bars", "lake", "ckpt", "news")}
    spark.createDataFrame([_master(t, t, "2024-01-01T00:00:00Z") for t in "ABC"], schemas.MASTER_MESSAGE).write.parquet(p["raw"])
    _land(spark, p["news"], ["[]"])
    wh = ParquetWarehouse(spark, scratch("wh"))

    def run(*bars):
        _land(spark, p["bars"], [json.dumps({"T": t, "v": 1, "vw": 1, "o": 1, "c": 1, "h": 1, "l": 1, "n": 1, "date_time": d})
                                 for t, d in bars])
        return daily_run(spark, master_raw_path=p["raw"], master_path=p["master"], bar_messages_path=p["bars"],
                         lake_path=p["lake"], lake_checkpoint=p["ckpt"], warehouse=wh, news_texts_path=p["news"],
                         tickers="A", initial_cut="2023-05-01")
    run(("A", "2024-06-04"))
    out = run(("B", "2024-06-04"), ("C", "2024-06-01"), ("C", "2023-05-02"))
    # 2023-05-02 lies 399 days behind the cut
    assert out["load"]["cut_after"] == dt.date(2024, 6, 4) and out["load"]["rows_loaded"] == 3
    assert spark.read.parquet(p["lake"]).count() == 4
    assert sorted(r.ticker for r in wh.read("market_data").collect()) == ["A", "B", "C", "C"]
    out = run(("A", "2022-01-03"), ("D", "2024-06-05"))
    # at or before the first cut: in the lake alone; D is not in the master yet and waits
    assert out["load"]["rows_loaded"] == 0 and out["bars_by_route"] == {"lake": 1, "unmatched": 1}
    spark.createDataFrame([_master("D", "D", "2024-01-01T00:00:00Z")], schemas.MASTER_MESSAGE).write.mode("append").parquet(p["raw"])
    out = run(("C", "2024-06-05"))
    assert out["bars_replayed"] == 1 and out["load"]["rows_loaded"] == 2 and out["load"]["batches"] == 2
    assert wh.read("market_data").where("ticker = 'D' and name = 'D'").count() == 1


def test_articles_from_envelopes_whole_files_and_odd_texts(spark, scratch):
    from marketflow.plans.jobs import publish_articles
    now = dt.datetime.now(dt.timezone.utc)
    art = lambda title, when: {"title": title, "publisher": {"name": "p"}, "author": None, "published_utc": when,
                               "insights": [{"ticker": "A", "sentiment": "positive"}]}
    fresh = now.strftime("%Y-%m-%dT%H:%M:%S.5Z")
    lines = [json.dumps({"results": [art("page", fresh)], "request_id": "1"}), json.dumps({"request_id": "2"}),
             json.dumps([art("old", "2001-01-01T00:00:00Z"), art("undated", None)]), "not json", ""]
    news, pretty, wh = scratch("news"), scratch("pretty"), ParquetWarehouse(spark, scratch("wh"))
    _land(spark, news, lines)
    out = publish_articles(spark, news, "A", wh, horizon_days=100)
    assert out["texts_unparsed"] == 1 and out["articles_undated"] == 1
    assert publish_articles(spark, news, spark.createDataFrame([("A",)], "ticker string"), wh, horizon_days=100) == out
    titles = [r.article_title for t in ("articles", "articles_rejects") for r in wh.read(t).collect()]
    assert titles == ["page"]
    _land(spark, pretty, json.dumps([art("pretty", "2024-01-01T00:00:00Z")], indent=1).split("\n"))
    assert publish_articles(spark, pretty, "A", wh)["rows_published"] == 0
    assert publish_articles(spark, pretty, "A", wh, whole_files=True)["rows_published"] == 1


def test_calendars_of_empty_ranges(spark):
    from marketflow.operators.calendar import month_calendar
    assert request_days(spark, dt.date.today()).count() == 0
    bounds = spark.sql("SELECT date'2024-03-01' AS s, date'2024-01-01' AS e")
    assert month_calendar(bounds, "s", "e").count() == 0


def test_only_local_masters_do_without_a_shared_folder():
    import pytest

    from marketflow.session import _local_dir
    assert _local_dir("local[4]")
    for master in ("yarn", "k8s://x", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _local_dir(master)


def test_jdbc_warehouse_options_without_a_database(spark, monkeypatch):
    """What would be sent to a database; nothing is run."""
    from marketflow.operators import incremental
    from marketflow.operators.incremental import JdbcWarehouse, load_increment
    seen = []
    monkeypatch.setattr(incremental, "table_exists", lambda s, u, p, t: t == "cutting_dates")
    monkeypatch.setattr(incremental, "read_max_cut", lambda *a: spark.sql("SELECT date'2024-01-01' AS cut_date"))
    monkeypatch.setattr(incremental, "append_jdbc", lambda df, url, t, p, n: seen.append((t, df.columns, n, df.count())))
    ran = []
    monkeypatch.setattr(incremental, "run_transaction", lambda s, u, p, statements: ran.append(statements))
    monkeypatch.setattr(incremental, "read_jdbc_table", lambda s, u, t, p, **k: seen.append((t, k)))
    wh = JdbcWarehouse(spark, "jdbc:x", {}, connections=3, splits={"big": {"partition_column": "d", "num_partitions": 8}})
    assert wh.read("market_data") is None
    names = [f.name for f in schemas.ENRICHED_BAR]
    lake = spark.createDataFrame([], schemas.ENRICHED_BAR).withColumns({"year": F.lit(2024), "month": F.lit(1)})
    row = lake.drop("year", "month").unionByName(spark.range(1).select(
        *[(F.lit(dt.date(2024, 1, 5)) if f.name == "transaction_date" else F.lit(None).cast(f.dataType)).alias(f.name)
          for f in schemas.ENRICHED_BAR])).withColumns({"year": F.lit(2024), "month": F.lit(1)})
    assert wh.read("cutting_dates") is None and seen.pop() == ("cutting_dates", {})
    load_increment(row, wh, drop_columns=["year", "month"])
    data, cut = seen[-2:]
    assert seen == [data, cut] and data[1:] == (names, 3, 1) and cut[1:] == (["cut_date"], 3, 1)
    load = data[0].removeprefix("market_data__load_")
    assert cut[0] == f"cutting_dates__load_{load}"
    listed = ", ".join(f'"{n}"' for n in names)
    assert ran == [
        [f'CREATE TABLE {cut[0]} AS SELECT "cut_date" FROM cutting_dates WHERE 1 = 0'],
        # one transaction: a table that is not there yet is created in it
        [f"CREATE TABLE market_data AS SELECT {listed} FROM {data[0]}",
         f'INSERT INTO cutting_dates ("cut_date") SELECT "cut_date" FROM {cut[0]}'],
        [f"DROP TABLE IF EXISTS {data[0]}", f"DROP TABLE IF EXISTS {cut[0]}"]]
    monkeypatch.setattr(incremental, "table_exists", lambda *a: True)
    wh.read("big")
    assert seen[-1] == ("big", {"partition_column": "d", "num_partitions": 8})


def test_failed_jdbc_load_moves_nothing_and_drops_its_staging_tables(spark, monkeypatch):
    import pytest

    from marketflow.operators import incremental
    from marketflow.operators.incremental import JdbcWarehouse
    ran = []

    def append(df, url, table, p, n):
        if table.startswith("b__"):
            raise RuntimeError("connection lost")
    monkeypatch.setattr(incremental, "table_exists", lambda *a: True)
    monkeypatch.setattr(incremental, "append_jdbc", append)
    monkeypatch.setattr(incremental, "run_transaction", lambda s, u, p, statements: ran.extend(statements))
    one = spark.range(1)
    with pytest.raises(RuntimeError):
        JdbcWarehouse(spark, "jdbc:x", {}).append_all([("a", one), ("b", one)])
    assert [s.split()[0] for s in ran] == ["CREATE", "CREATE", "DROP", "DROP"]


def test_catalogue_question_quotes_names_and_keeps_to_one_schema():
    from marketflow.sources.jdbc import listing_query
    assert listing_query("x").endswith("lower('x') AND lower(table_schema) = lower(CURRENT_SCHEMA)")
    assert "lower('o''brien') AND lower(table_schema) = lower('s')" in listing_query("s.o'brien")


def test_parquet_overwrite_survives_a_crash(spark, scratch, monkeypatch):
    import pytest

    from marketflow.operators import incremental
    wh = ParquetWarehouse(spark, scratch("wh"))
    wh.overwrite("t", spark.range(3))
    real, calls = incremental.rename_path, []

    def second_fails(s, path, to):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(s, path, to)
    monkeypatch.setattr(incremental, "rename_path", second_fails)
    with pytest.raises(RuntimeError):
        wh.overwrite("t", spark.range(5))
    assert wh.read("t").count() == 3
    monkeypatch.setattr(incremental, "rename_path", real)
    wh.overwrite("t", spark.range(7))
    assert wh.read("t").count() == 7
    wh.overwrite("t", wh.read("t").where("id < 2"))  # reading what is replaced
    assert wh.read("t").count() == 2


def test_rolling_study_over_articles_and_bars(spark):
    """Against a plain computation, with constant stretches, gaps and several articles a day."""
    import math
    import random

    from marketflow.operators.signals import daily_return, daily_sentiment, sentiment_vs_return
    from marketflow.plans.jobs import rolling_study
    rng, first = random.Random(1), dt.date(2024, 1, 1)
    day = lambda i: first + dt.timedelta(days=i)
    bars = [(t, day(i), 100.0 if t == "flat" else 100 + rng.random()) for t in ("A", "B", "flat") for i in range(120) if rng.random() < 0.8]
    arts = [(t, str(day(i)), "positive" if 30 <= i < 60 else rng.choice(["positive", "negative", "neutral"]))
            for t in ("A", "B", "flat") for i in range(120) for _ in range(rng.randrange(3))]
    bars = spark.createDataFrame(bars, "ticker string, transaction_date date, close_price double")
    arts = spark.createDataFrame(arts, "ticker string, publication_date string, sentiment string")
    got = {(r.ticker, r.day): (r.n_pairs, r["corr"]) for r in rolling_study(arts, bars, days=20).collect()}
    pairs = [(r.ticker, r.day, round(r.avg_score, 9), round(r.ret, 9))
             for r in sentiment_vs_return(daily_sentiment(arts), daily_return(bars.withColumn("day", F.col("transaction_date")))).collect()
             if r.avg_score is not None and r.ret is not None]
    assert set(got) == {(t, d) for t, d, _, _ in pairs}
    for (ticker, end), (n, corr) in got.items():
        xy = [(x, y) for t, d, x, y in pairs if t == ticker and end - dt.timedelta(days=20) < d <= end]
        assert n == len(xy)
        mx, my = (sum(v) / n for v in zip(*xy))
        if len({x for x, _ in xy}) < 2 or len({y for _, y in xy}) < 2:
            assert corr is None
        else:
            cov = sum((x - mx) * (y - my) for x, y in xy)
            assert math.isclose(corr, cov / math.sqrt(sum((x - mx) ** 2 for x, _ in xy) * sum((y - my) ** 2 for _, y in xy)), abs_tol=1e-9)
    assert any(c is None for _, c in got.values()) and any(c is not None for _, c in got.values())
    assert rolling_study(arts.limit(0), bars).count() == 0


def test_news_stream_keeps_each_article_once(spark, scratch):
    from marketflow.plans.jobs import stream_articles
    art = lambda title, when, n=1: {"title": title, "publisher": {"name": "p"}, "author": None, "published_utc": when,
                                    "insights": [{"ticker": "A", "sentiment": "positive"}] * n}
    news, out, ckpt = scratch("news"), scratch("out"), scratch("ckpt")
    run = lambda: stream_articles(spark, news, "A", out, ckpt, delay_days=10)
    _land(spark, news, [json.dumps([art("one", "2024-03-01T10:00:00Z"), art("two", "2024-03-05T10:00:00.5Z")]),
                        json.dumps([art("one", "2024-03-01T10:00:00Z"), art("undated", "soon")]), "not json"])
    assert run() == {"articles_read": 4, "articles_late": 0, "articles_undated": 1}
    # Returned again by the next day's request, with a new one and one that is too old.
    _land(spark, news, [json.dumps({"results": [art("two", "2024-03-05T10:00:00.5Z"), art("three", "2024-03-20T10:00:00Z", 2)], "request_id": "1"}),
                        json.dumps([art("old", "2024-02-01T10:00:00Z")])])
    assert run() == {"articles_read": 3, "articles_late": 1, "articles_undated": 0}
    assert run() == {"articles_read": 0, "articles_late": 0, "articles_undated": 0}
    _land(spark, news, [json.dumps([art("three", "2024-03-20T10:00:00Z", 2)])])
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.article_title, r.ticker, r.related_ticker) for r in rows) == [
        ("one", "A", "A"), ("three", "A", "A,A"), ("three", "A", "A,A"), ("two", "A", "A")]


def test_the_late_daily_run_loads_every_bar(spark, scratch, monkeypatch):
    """Bars of any year: the first run's and, in the second run, those decades older than what is loaded."""
    sf, out = scratch("sf"), []
    days = ["1931-03-01", "1969-12-31", "1996-06-30", "1998-12-31", "1998-12-31", "1999-01-01", "2000-12-31", "2001-01-01", None]
    lines = [(1, i % 2, 1, float(min(i, 3)), 10.0, 0.1, 0.2, None if d is None else dt.datetime.fromisoformat(d)) for i, d in enumerate(days)]
    lines += [(2, 7, 1, 1.0, 10.0, 0.1, 0.2, dt.datetime(1998, 5, 1)), lines[0]]  # part 7 is not there; a bar twice
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(f"{sf}/lineitem.parquet")
    spark.createDataFrame([(0, "a", "b", "t", 30), (1, "c", "d", "t", 3)], "p_partkey bigint, p_name string, p_brand string, p_type string, "
                          "p_size int").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(0, dt.datetime(2024, 6, 4), "click", 30.0)], "event_id bigint, ts timestamp_ntz, event_type string, value double") \
        .write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(jobs, "daily_run", lambda *a, **k: out.append(daily_run(*a, **k)))
    rows = catalog.q_daily_run_late(spark, sf).collect()
    assert sorted((r.ticker, r.name, r.volume, str(r.transaction_date)) for r in rows) == sorted(
        (str(i % 2), "ac"[i % 2], float(min(i, 3)), d) for i, d in enumerate(days) if d)
    assert [x["bars_by_route"] for x in out] == [{"lake": 3}, {"lake": 6, "unmatched": 1, "rejected": 1}]
    assert [x["load"]["rows_loaded"] for x in out] == [3, 5]
