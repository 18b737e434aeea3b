"""The query catalogue: every operator run on the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables. Entries that need a lake, a stream or a warehouse derive it from
the tables into a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.functions.dates import (
    decode_cut_token, encode_cut_token, parse_day, published_date, day_text,
    within_horizon, within_lookback, ISO_Z_FORMAT,
)
from marketflow.functions.json import encode_rows, parse_json, parse_messages
from marketflow.operators.calendar import calendar_gaps, day_calendar, month_calendar
from marketflow.operators.contracts import Rule, contract_report, split_by_contract
from marketflow.operators.enrich import bars_from_messages, enrich
from marketflow.operators.incremental import ParquetWarehouse, lake_cut, load_increment
from marketflow.operators.master import clean_master, latest_per_ticker
from marketflow.operators.news import flatten_articles, keep_tickers, related_as_text, zip_explode
from marketflow.operators.rows import count_rows, dedupe_rows, union_to_schema
from marketflow.operators.signals import (
    daily_moments, daily_return, daily_sentiment, next_trading_day, rolling_corr, sentiment_price_corr,
    sentiment_vs_return,
)
from marketflow.operators.sizing import spread
from marketflow.plans import jobs
from marketflow.plans import analogues as A
from marketflow.session import scratch_path
from marketflow.sinks.landed import LandedLog
from marketflow.sinks.messages import write_json_lines
from marketflow.sinks.parquet import append_lake, overwrite_parquet
from marketflow.sources.messages import flatten_envelopes, read_article_texts, read_message_files
from marketflow.sources.parquet import latest_partition, read_lake, scan_month_range
from marketflow.streaming.lake import rejected_messages, replay_unmatched
from marketflow.streaming.runner import master_ingest_stream, run_available_now

# Fixed parameters of the catalogue (the oracle SQL repeats them).
ENRICH_CUT = "2000-12-31"
AFTER_CUT_TEXT = "  1998-01-31\n"
LATE_CUT, LATE_DAYS = "1998-01-31", 7
HORIZON_DAYS = 20
RANGE_START, RANGE_END = "2000-12-15", "2002-01-10"
LAKE_DEFAULT_CUT = "2024-01-01"
LOAD_SEED_CUT, LOAD_SPLIT, LOAD_LOOKBACK = "1996-06-30", "1997-12-31", 3
LONG_LOOKBACK = 36_500  # days
STREAM_SPLIT_YEAR = 1999
MASTER_SPLIT_NATION = 13
CALENDAR_BASE = "lake"
SIGNAL_LAG_DAYS = 1
ROLLING_DAYS = 10
STREAM_DELAY = 15  # days; the second landing's articles begin about ten days before the first one's end
WATCH_VALUE = 400
LANDED_ROWS = 1 << 18  # texts in a packed file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_master(A.part_as_master(table(spark, sf_dir, "part")))


def orders_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_lake")
    append_lake(A.orders_as_lake_rows(table(spark, sf_dir, "orders")), path, mode="overwrite")
    return spark.read.parquet(path)


def _wide(df: DataFrame) -> DataFrame:
    """A small scan dealt over all cores, as its file may be one row group and JSON is heavy per row. A scan of more than
    twice as many splits as cores stays as it is, so no dealt part is larger than two splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > 2 * cores else spread(df, cores)


def _land_packed(texts: DataFrame, path: str) -> None:
    """Lands texts as gzip files. A packed file is read whole by one task, so none holds more than ``LANDED_ROWS`` texts."""
    texts.select("value").write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS).text(path)


# ---------------------------------------------------------------- sources


def q_scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def q_json_parse_master(spark, sf_dir):
    messages = encode_rows(A.part_as_master(table(spark, sf_dir, "part")), as_binary=True)
    text = messages.selectExpr("CAST(value AS STRING) AS json")
    return parse_messages(text, schemas.MASTER_MESSAGE, value_col="json")


def q_json_parse_bars(spark, sf_dir):
    messages = A.lineitem_as_bar_messages(_wide(table(spark, sf_dir, "lineitem"))) \
        .select(F.col("value").cast("binary").alias("value"))
    return bars_from_messages(parse_messages(messages, schemas.BAR_MESSAGE))


def q_json_encode_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_json")
    write_json_lines(customer, path, mode="overwrite")
    return spark.read.schema(customer.schema).json(path)


def q_json_parse_props(spark, sf_dir):
    """The permissive typed parse on JSON text that comes with the tables."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    events = table(spark, sf_dir, "events")
    return events.select("event_id", parse_json("props", schema).getField("k").alias("k"))


def q_envelope_flatten(spark, sf_dir):
    pages = A.events_as_pages(table(spark, sf_dir, "events"))
    result_type = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    ])
    return flatten_envelopes(pages, result_type, text_col="value",
                             stamp=F.col("request_date"), stamp_name="date_time")


# ------------------------------------------------------------------ news


def q_news_flatten(spark, sf_dir):
    texts = A.articles_as_texts(A.events_as_articles(table(spark, sf_dir, "events")))
    path = scratch_path(spark, "news_texts")
    texts.write.mode("overwrite").text(path)
    rows = flatten_articles(read_article_texts(spark, path), A.WATCHED_TICKERS)
    return related_as_text(rows)


def q_arrays_zip_explode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    groups = events.groupBy(day.alias("day"), F.expr(f"event_id div {A.EVENTS_PER_PAGE}").alias("g")) \
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("items"))
    lists = groups.select(
        "day",
        F.transform("items", lambda x: x.getField("event_id")).alias("ids"),
        F.transform("items", lambda x: x.getField("event_type")).alias("types"),
    )
    return zip_explode(lists, "ids", "types").select(
        F.col("z.ids").alias("event_id"), F.col("z.types").alias("event_type"), "day")


def q_parse_published(spark, sf_dir):
    events = _wide(table(spark, sf_dir, "events"))
    good = F.date_format("ts", ISO_Z_FORMAT)
    fractional = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123Z"))
    junk = F.concat(F.lit("junk-"), F.col("event_id").cast("string"))
    variants = F.array(
        F.struct(F.lit("good").alias("variant"), good.alias("text")),
        F.struct(F.lit("fractional").alias("variant"), fractional.alias("text")),
        F.struct(F.lit("junk").alias("variant"), junk.alias("text")),
    )
    rows = events.select("event_id", F.explode(variants).alias("v"))
    date = published_date("v.text")
    return rows.select("event_id", F.col("v.variant").alias("variant"),
                       F.col("v.text").alias("published_utc"),
                       date.alias("publication_date"), day_text(date).alias("publication_day"))


def q_news_horizon(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    anchor = events.agg(F.max("ts")).scalar()
    return events.where(within_horizon("ts", anchor, HORIZON_DAYS)) \
        .select("event_id", "user_id", "event_type", "value")


def q_filter_semi(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    watch = events.where(F.col("value") > WATCH_VALUE).select(F.col("event_type").alias("ticker"))
    return keep_tickers(events, watch, col="event_type").select("event_id", "event_type")


def q_filter_isin(spark, sf_dir):
    return keep_tickers(table(spark, sf_dir, "events"), A.WATCHED_TICKERS, col="event_type") \
        .select("event_id", "event_type")


# ---------------------------------------------------------------- master


def q_master_clean(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    raw = A.part_as_master(part, A.MASTER_VERSION_1).unionByName(
        A.part_as_master(part, A.MASTER_VERSION_2))
    path = scratch_path(spark, "master_clean")
    overwrite_parquet(clean_master(raw), path)
    return spark.read.parquet(path)


def q_master_latest(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    raw = A.part_as_master(part, A.MASTER_VERSION_1).unionByName(A.part_as_master_renamed(part))
    return latest_per_ticker(raw)


def q_dedup_full_row(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size")
    return dedupe_rows(part.unionAll(part))


def q_master_count(spark, sf_dir):
    raw = A.part_as_master(table(spark, sf_dir, "part"))
    return count_rows(clean_master(raw.unionByName(raw)))


# ------------------------------------------------------------ enrichment


def q_enrich_batch(spark, sf_dir):
    bars = A.lineitem_as_bars(table(spark, sf_dir, "lineitem"))
    return enrich(bars, _master(spark, sf_dir), ENRICH_CUT)


def q_stream_master_ingest(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    first = F.coalesce(F.col("s_nationkey"), F.lit(0)) < MASTER_SPLIT_NATION
    landing, out, ckpt = (scratch_path(spark, n) for n in ("master_in", "master_raw", "master_ckpt"))
    write_json_lines(A.supplier_as_master(supplier.where(first)), landing)
    stream = master_ingest_stream(read_message_files(spark, landing, streaming=True))
    run_available_now(stream, out, ckpt)
    run_available_now(stream, out, ckpt)  # no new files: no new rows
    write_json_lines(A.supplier_as_master(supplier.where(~first)), landing)
    run_available_now(stream, out, ckpt)
    return spark.read.parquet(out)


def q_stream_enrich(spark, sf_dir):
    messages = A.lineitem_as_bar_messages(_wide(table(spark, sf_dir, "lineitem")))
    early = F.coalesce(F.year("ship_day"), F.lit(0)) < STREAM_SPLIT_YEAR
    landing, master_path, out, ckpt = (scratch_path(spark, n) for n in
                                       ("bars_in", "master", "bars_lake", "bars_ckpt"))
    overwrite_parquet(_master(spark, sf_dir), master_path)
    messages.where(early).select("value").write.mode("append").text(landing)
    stream = read_message_files(spark, landing, streaming=True)
    jobs.enrich_stream_to_lake(spark, stream, master_path, out, ckpt, ENRICH_CUT)
    jobs.enrich_stream_to_lake(spark, stream, master_path, out, ckpt, ENRICH_CUT)  # no new files: no new rows
    messages.where(~early).select("value").write.mode("append").text(landing)
    jobs.enrich_stream_to_lake(spark, stream, master_path, out, ckpt, ENRICH_CUT)
    return read_lake(spark, out)


def q_lake_backfill(spark, sf_dir):
    """Later bars streamed first, then the earlier ones backfilled into the same lake."""
    messages = A.lineitem_as_bar_messages(_wide(table(spark, sf_dir, "lineitem")))
    early = F.coalesce(F.year("ship_day"), F.lit(0)) < STREAM_SPLIT_YEAR
    landing, master_path, out, ckpt = (scratch_path(spark, n) for n in
                                       ("fill_in", "fill_master", "fill_lake", "fill_ckpt"))
    overwrite_parquet(_master(spark, sf_dir), master_path)
    jobs.backfill_streamed_lake(spark, messages.where(~early), landing, master_path, out, ckpt, ENRICH_CUT)
    jobs.backfill_streamed_lake(spark, messages.where(early), landing, master_path, out, ckpt, ENRICH_CUT)
    return read_lake(spark, out)


def _partly_broken_messages(spark, sf_dir):
    """Bar messages of all lineitems; some cut short, some without a ticker or with a day that is none."""
    rows = A.lineitem_as_bar_messages(table(spark, sf_dir, "lineitem").withColumn("mark", A.line_mark()), keep=["mark"])
    text = F.when(F.col("mark") % 11 == 0, F.concat(F.lit('{"T":"'), F.col("mark"), F.lit('","v":'))) \
        .when(F.col("mark") % 13 == 0, F.concat(F.lit('{"t":'), F.col("mark"), F.lit("}"))) \
        .when(F.col("mark") % 17 == 0, F.concat(F.lit('{"T":"1","date_time":"'), F.col("mark"), F.lit('th"}'))) \
        .otherwise(F.col("value"))
    return rows.select(text.alias("value"))


def q_message_rejects(spark, sf_dir):
    """Rejected texts with their reasons, and how many messages took each route; none is lost."""
    landing, master_path, out, ckpt = (scratch_path(spark, n) for n in
                                       ("reject_in", "reject_master", "reject_lake", "reject_ckpt"))
    overwrite_parquet(_master(spark, sf_dir).where(F.col("ticker").cast("int") % 3 != 0), master_path)
    _partly_broken_messages(spark, sf_dir).write.text(landing)
    jobs.enrich_stream_to_lake(spark, read_message_files(spark, landing, streaming=True), master_path, out, ckpt, ENRICH_CUT)
    rejects = rejected_messages(spark, out).groupBy("reason", "value").agg(F.count("*").alias("n_rows"))
    routes = LandedLog(spark, out).read().groupBy("route").agg(F.sum("n_rows").alias("n_rows"))
    return rejects.select(F.lit("message").alias("kind"), "reason", "value", "n_rows").unionByName(
        routes.select(F.lit("route").alias("kind"), F.col("route").alias("reason"), F.lit(None).cast("string").alias("value"), "n_rows"))


def q_unmatched_replay(spark, sf_dir):
    """Bars of tickers the master learns only later, in two steps; in the end the lake holds them all once."""
    landing, master_path, out, ckpt = (scratch_path(spark, n) for n in
                                       ("wait_in", "wait_master", "wait_lake", "wait_ckpt"))
    master, known = _master(spark, sf_dir), F.col("ticker").cast("int") % 4
    A.lineitem_as_bar_messages(table(spark, sf_dir, "lineitem")).select("value").write.text(landing)
    overwrite_parquet(master.where(known == 0), master_path)
    jobs.enrich_stream_to_lake(spark, read_message_files(spark, landing, streaming=True), master_path, out, ckpt, ENRICH_CUT)
    replay_unmatched(spark, out, master.where(known == 0))  # nothing new: nothing is written
    replay_unmatched(spark, out, master.where(known <= 2))
    replay_unmatched(spark, out, master)
    return read_lake(spark, out)


def q_daily_run_late(spark, sf_dir):
    """Two daily runs; the second one's bars are the earlier dates. The warehouse holds them all: no floor is set,
    neither to the stream nor to the load."""
    part = table(spark, sf_dir, "part")
    messages = A.lineitem_as_bar_messages(_wide(table(spark, sf_dir, "lineitem")))
    early = F.coalesce(F.year("ship_day"), F.lit(0)) < STREAM_SPLIT_YEAR
    p = {n: scratch_path(spark, f"daily_{n}") for n in ("raw", "master", "bars", "lake", "ckpt", "news", "wh")}
    A.part_as_master(part).write.parquet(p["raw"])
    _land_packed(A.articles_as_texts(A.events_as_articles(table(spark, sf_dir, "events"))), p["news"])
    wh = ParquetWarehouse(spark, p["wh"])
    for some in (~early, early):
        _land_packed(messages.where(some), p["bars"])
        jobs.daily_run(spark, master_raw_path=p["raw"], master_path=p["master"], bar_messages_path=p["bars"],
                       lake_path=p["lake"], lake_checkpoint=p["ckpt"], warehouse=wh, news_texts_path=p["news"],
                       tickers=A.WATCHED_TICKERS, initial_cut=None, horizon_days=None)
    return wh.read("market_data")


def q_publish_articles(spark, sf_dir):
    """The published rows and the rejected ones, marked."""
    news, root = scratch_path(spark, "publish_news"), scratch_path(spark, "publish_wh")
    A.articles_as_texts(A.events_as_articles(table(spark, sf_dir, "events"))).write.text(news)
    wh = ParquetWarehouse(spark, root)
    jobs.publish_articles(spark, news, A.WATCHED_TICKERS, wh)
    good = wh.read("articles").withColumn("violations", F.lit(None).cast("string"))
    return good.unionByName(wh.read("articles_rejects"))


def q_news_stream(spark, sf_dir):
    """Two landings that share a third of the articles, then a run without news; every article's rows once."""
    landing, out, ckpt = (scratch_path(spark, n) for n in ("stream_news", "stream_articles", "stream_news_ckpt"))
    articles = A.events_as_articles(table(spark, sf_dir, "events"))
    top = articles.agg(F.max("aid")).scalar()
    for some in (F.col("aid") <= top * 2 / 3, F.col("aid") >= top / 3):
        A.articles_as_texts(articles.where(some)).write.mode("append").text(landing)
        jobs.stream_articles(spark, landing, A.WATCHED_TICKERS, out, ckpt, delay_days=STREAM_DELAY)
    jobs.stream_articles(spark, landing, A.WATCHED_TICKERS, out, ckpt, delay_days=STREAM_DELAY)
    return spark.read.parquet(out)


# --------------------------------------------------------- lake and cuts


def _orders_dated(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
                         "o_totalprice")


def q_late_rows(spark, sf_dir):
    return _orders_dated(spark, sf_dir).where(within_lookback("order_date", LATE_CUT, LATE_DAYS)) \
        .select("o_orderkey", "order_date", "o_totalprice")


def q_filter_after_cut(spark, sf_dir):
    cut = parse_day(F.lit(AFTER_CUT_TEXT))
    return _orders_dated(spark, sf_dir).where(F.col("order_date") > cut)


def q_scan_month_range(spark, sf_dir):
    return scan_month_range(orders_lake(spark, sf_dir), RANGE_START, RANGE_END) \
        .select("o_orderkey", "transaction_date", "year", "month")


def q_latest_partition(spark, sf_dir):
    return latest_partition(orders_lake(spark, sf_dir))


def q_lake_cut_date(spark, sf_dir):
    return lake_cut(orders_lake(spark, sf_dir), LAKE_DEFAULT_CUT)


def q_cut_roundtrip(spark, sf_dir):
    rows = A.orders_as_lake_rows(table(spark, sf_dir, "orders"))
    wh = ParquetWarehouse(spark, scratch_path(spark, "warehouse_cuts"))
    split = F.lit(_dt.date.fromisoformat(LOAD_SPLIT))
    wh.append("cutting_dates", rows.where(F.col("transaction_date") <= split)
              .agg(F.max("transaction_date").alias("cut_date")))
    wh.append("cutting_dates", rows.agg(F.max("transaction_date").alias("cut_date")))
    return wh.max_cut("cutting_dates")


def q_table_overwrite(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    wh = ParquetWarehouse(spark, scratch_path(spark, "warehouse_supplier"))
    wh.overwrite("supplier", supplier)
    wh.overwrite("supplier", supplier)
    return wh.read("supplier")


def q_union_widen(spark, sf_dir):
    schema = T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.DoubleType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ])
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return union_to_schema(spark, schema, [part], by_name=False)


def q_incremental_load(spark, sf_dir):
    rows = A.orders_as_lake_rows(table(spark, sf_dir, "orders"))
    split = F.lit(_dt.date.fromisoformat(LOAD_SPLIT))
    early = F.coalesce(F.col("transaction_date") <= split, F.lit(True))
    lake_path = scratch_path(spark, "load_lake")
    wh = ParquetWarehouse(spark, scratch_path(spark, "warehouse"),
                          partition_by={"market_data": ["year", "month"]})
    append_lake(rows.where(early), lake_path)
    kwargs = dict(initial_cut=LOAD_SEED_CUT, lookback_days=LOAD_LOOKBACK)
    load_increment(spark.read.parquet(lake_path), wh, **kwargs)
    load_increment(spark.read.parquet(lake_path), wh, cut=LOAD_SEED_CUT, **kwargs)  # rerun
    append_lake(rows.where(~early), lake_path)
    load_increment(spark.read.parquet(lake_path), wh, **kwargs)
    return wh.read("market_data").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "transaction_date",
        "o_orderpriority")


LOAD_RULES = [Rule("o_orderpriority", max_length=6)]


def _nullable_orders(spark, sf_dir):
    """Orders as lake rows; every seventh without a customer, so rows with nulls are loaded too."""
    rows = A.orders_as_lake_rows(table(spark, sf_dir, "orders"))
    return rows.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))


def q_incremental_rerun(spark, sf_dir):
    """Loaded three times from one lake, with rejects, nulls and a lookback; every row must be there once."""
    lake_path, wh = scratch_path(spark, "rerun_lake"), ParquetWarehouse(spark, scratch_path(spark, "rerun_wh"))
    append_lake(_nullable_orders(spark, sf_dir), lake_path)
    for _ in range(3):
        load_increment(spark.read.parquet(lake_path), wh, initial_cut=LOAD_SEED_CUT, lookback_days=LOAD_LOOKBACK,
                       drop_columns=["year", "month"], contract=LOAD_RULES, reject_table="rejects")
    good = wh.read("market_data").withColumn("violations", F.lit(None).cast("string"))
    cuts = wh.read("cutting_dates").agg(F.count("*").alias("n"), F.max("cut_date").alias("cut")).first()
    rows = good.unionByName(wh.read("rejects"))
    return rows.withColumn("n_cuts", F.lit(cuts["n"]).cast("bigint")).withColumn("cut", F.lit(cuts["cut"]))


def q_incremental_versions(spark, sf_dir):
    """Two versions of every order, split over two loads; both stay, as with one load."""
    rows = _nullable_orders(spark, sf_dir)
    newer = rows.withColumn("o_orderstatus", F.lit("X"))
    lake_path, wh = scratch_path(spark, "versions_lake"), ParquetWarehouse(spark, scratch_path(spark, "versions_wh"))
    odd = F.col("o_orderkey") % 2 == 1
    kwargs = dict(initial_cut=LOAD_SEED_CUT, lookback_days=LONG_LOOKBACK, drop_columns=["year", "month"])
    append_lake(rows.where(odd).unionByName(newer.where(~odd)), lake_path)
    load_increment(spark.read.parquet(lake_path), wh, **kwargs)
    append_lake(rows.where(~odd).unionByName(newer.where(odd)).unionByName(newer), lake_path)
    load_increment(spark.read.parquet(lake_path), wh, **kwargs)
    return wh.read("market_data")


# -------------------------------------------------------------- calendars


def _order_bounds(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").agg(F.min(d).alias("first"), F.max(d).alias("last"))


def q_day_calendar(spark, sf_dir):
    return day_calendar(_order_bounds(spark, sf_dir), "first", "last")


def q_calendar_gaps(spark, sf_dir):
    days = day_calendar(_order_bounds(spark, sf_dir), "first", "last")
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return calendar_gaps(days, dates)


def q_month_calendar(spark, sf_dir):
    return month_calendar(_order_bounds(spark, sf_dir), "first", "last", base_path=CALENDAR_BASE)


def q_decode_cut_token(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", encode_cut_token(F.col("o_orderdate").cast("date")).alias("token"))
    return orders.select("o_orderkey", decode_cut_token("token").alias("cut_date"))


# -------------------------------------------------------------- contracts

# Fixed rules for the contract check on the driver's text tables.
DOCUMENT_RULES = [
    Rule("text", not_null=True, max_length=255),
    Rule("lang", not_null=True, max_length=10),
    Rule("source", not_null=True, max_length=10),
]
CUSTOMER_RULES = [
    Rule("c_name", not_null=True, max_length=255),
    Rule("c_mktsegment", not_null=True, max_length=10),
]


def q_contract_rejects(spark, sf_dir):
    _, rejected = split_by_contract(table(spark, sf_dir, "documents"), DOCUMENT_RULES)
    return rejected.select("doc_id", F.array_join("violations", ",").alias("violations"))


def q_contract_split(spark, sf_dir):
    return contract_report(table(spark, sf_dir, "documents"), DOCUMENT_RULES, "documents") \
        .unionByName(contract_report(table(spark, sf_dir, "customer"), CUSTOMER_RULES, "customer"))


# ---------------------------------------------------------------- signals


def _sentiment_daily(spark, sf_dir):
    return daily_sentiment(A.events_as_scored_articles(table(spark, sf_dir, "events")))


def _returns(spark, sf_dir):
    return daily_return(A.events_as_closes(table(spark, sf_dir, "events")))


def q_next_trading_day(spark, sf_dir):
    days = A.events_as_scored_articles(table(spark, sf_dir, "events")) \
        .select("ticker", F.col("publication_date").alias("day")).distinct()
    trading = A.events_as_closes(table(spark, sf_dir, "events")) \
        .select("ticker", F.col("transaction_date").alias("day"))
    return next_trading_day(days, trading)


def q_sentiment_daily(spark, sf_dir):
    return _sentiment_daily(spark, sf_dir).select(
        "ticker", "day", "n_articles", F.round("avg_score", 6).alias("avg_score"))


def q_daily_return(spark, sf_dir):
    return _returns(spark, sf_dir).select(
        "ticker", "day", F.round("close", 6).alias("close"), F.round("ret", 6).alias("ret"))


def q_sentiment_price_corr(spark, sf_dir):
    corr = sentiment_price_corr(_sentiment_daily(spark, sf_dir), _returns(spark, sf_dir),
                                lag_days=SIGNAL_LAG_DAYS)
    return corr.select("ticker", "n_pairs", F.round("corr", 6).alias("corr"))


def q_rolling_sentiment_corr(spark, sf_dir):
    pairs = sentiment_vs_return(_sentiment_daily(spark, sf_dir), _returns(spark, sf_dir), lag_days=SIGNAL_LAG_DAYS)
    return rolling_corr(daily_moments(pairs), ROLLING_DAYS).select(
        "ticker", "day", "n_pairs", F.round("corr", 6).alias("corr"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": q_scan_parquet,
    "json_parse_master": q_json_parse_master,
    "json_parse_bars": q_json_parse_bars,
    "json_encode_rows": q_json_encode_rows,
    "json_parse_props": q_json_parse_props,
    "envelope_flatten": q_envelope_flatten,
    "news_flatten": q_news_flatten,
    "arrays_zip_explode": q_arrays_zip_explode,
    "parse_published": q_parse_published,
    "news_horizon": q_news_horizon,
    "filter_isin": q_filter_isin,
    "filter_semi": q_filter_semi,
    "master_clean": q_master_clean,
    "master_latest": q_master_latest,
    "dedup_full_row": q_dedup_full_row,
    "master_count": q_master_count,
    "enrich_batch": q_enrich_batch,
    "stream_master_ingest": q_stream_master_ingest,
    "stream_enrich": q_stream_enrich,
    "late_rows": q_late_rows,
    "filter_after_cut": q_filter_after_cut,
    "scan_month_range": q_scan_month_range,
    "latest_partition": q_latest_partition,
    "lake_cut_date": q_lake_cut_date,
    "cut_roundtrip": q_cut_roundtrip,
    "table_overwrite": q_table_overwrite,
    "union_widen": q_union_widen,
    "incremental_load": q_incremental_load,
    "incremental_rerun": q_incremental_rerun,
    "incremental_versions": q_incremental_versions,
    "lake_backfill": q_lake_backfill,
    "message_rejects": q_message_rejects,
    "unmatched_replay": q_unmatched_replay,
    "daily_run_late": q_daily_run_late,
    "publish_articles": q_publish_articles,
    "day_calendar": q_day_calendar,
    "calendar_gaps": q_calendar_gaps,
    "month_calendar": q_month_calendar,
    "decode_cut_token": q_decode_cut_token,
    "contract_split": q_contract_split,
    "contract_rejects": q_contract_rejects,
    "next_trading_day": q_next_trading_day,
    "sentiment_daily": q_sentiment_daily,
    "daily_return": q_daily_return,
    "sentiment_price_corr": q_sentiment_price_corr,
    "rolling_sentiment_corr": q_rolling_sentiment_corr,
    "news_stream": q_news_stream,
}
