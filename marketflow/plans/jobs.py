"""End-to-end jobs in the order a daily run executes them.

Sources, sinks and credentials are arguments; nothing is read from files or
the environment. Scheduling is left to the caller's orchestrator.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.functions.dates import encode_cut_token
from marketflow.operators.contracts import ARTICLES_CONTRACT, MARKET_DATA_CONTRACT, with_violations
from marketflow.operators.enrich import TO_LAKE, enrich
from marketflow.operators.incremental import lake_cut, load_increment, load_landed
from marketflow.operators.master import clean_master, latest_per_ticker
from marketflow.operators.news import (
    ARTICLE_METRICS, OK, UNDATED, UNPARSED, articles_table_rows, flatten_with_status, new_articles, related_as_text,
)
from marketflow.operators.signals import (
    daily_moments, daily_return, daily_sentiment, rolling_corr, sentiment_price_corr, sentiment_vs_return,
)
from marketflow.operators.sizing import spread
from marketflow.session import delete_path, path_exists, scratch_path
from marketflow.sinks.landed import LandedLog
from marketflow.sinks.parquet import append_lake, overwrite_parquet
from marketflow.sources.messages import read_article_texts, read_kafka, read_message_files
from marketflow.sources.parquet import newest_month, read_lake
from marketflow.streaming.lake import replay_unmatched, stream_to_lake
from marketflow.streaming.runner import master_ingest_stream, run_available_now, run_totals

log = logging.getLogger(__name__)


def ingest_master(spark: SparkSession, messages: DataFrame, raw_path: str, checkpoint: str) -> int:
    """Master messages (a stream) -> raw master Parquet, exactly once."""
    return run_available_now(master_ingest_stream(messages), raw_path, checkpoint)


def ingest_master_from_kafka(spark: SparkSession, kafka_options: dict, raw_path: str,
                             checkpoint: str) -> int:
    """Master topic from its first offset -> raw master Parquet."""
    options = {"startingOffsets": "earliest", **kafka_options}
    return ingest_master(spark, read_kafka(spark, options), raw_path, checkpoint)


def clean_master_table(spark: SparkSession, raw_path: str, cleaned_path: str,
                       one_per_ticker: bool = True) -> DataFrame:
    """Raw master -> cleaned master (overwrite). Returns the cleaned frame."""
    raw = spark.read.parquet(raw_path)
    cleaned = latest_per_ticker(raw) if one_per_ticker else clean_master(raw)
    overwrite_parquet(cleaned, cleaned_path)
    return spark.read.parquet(cleaned_path)


def enrich_batch_to_lake(spark: SparkSession, bars: DataFrame, master_path: str,
                         lake_path: str, cut=None) -> None:
    """Typed bars -> enriched rows appended to a lake that only batches write."""
    append_lake(enrich(bars, spark.read.parquet(master_path), cut), lake_path)


def enrich_stream_to_lake(spark: SparkSession, messages: DataFrame, master_path: str,
                          lake_path: str, checkpoint: str, cut=None) -> dict:
    """Bar messages (Kafka or landed files, streaming) -> the lake, with a record of
    what each micro-batch landed. Returns the messages of the run by route: into
    the lake, rejected, without a master row, before the cut."""
    # Every micro-batch reads the static side again: keep it cached for the run.
    master = spark.read.parquet(master_path).persist()
    try:
        return stream_to_lake(messages, master, lake_path, checkpoint, cut)
    finally:
        master.unpersist()


def backfill_streamed_lake(spark: SparkSession, bar_messages: DataFrame, landing_path: str,
                           master_path: str, lake_path: str, checkpoint: str, cut=None) -> dict:
    """Older bar messages (JSON text in ``value``) -> a lake that a stream
    writes: they are landed where the stream reads and go through its sink, so
    every reader of the lake sees them."""
    bar_messages.select("value").write.mode("append").text(landing_path)
    messages = read_message_files(spark, landing_path, streaming=True)
    return enrich_stream_to_lake(spark, messages, master_path, lake_path, checkpoint, cut)


def enrich_kafka_to_lake(spark: SparkSession, kafka_options: dict, master_path: str,
                         lake_path: str, checkpoint: str, cut=None) -> dict:
    """Bar topic (new offsets; tolerate expired ones) -> the lake."""
    options = {"startingOffsets": "latest", "failOnDataLoss": "false", **kafka_options}
    return enrich_stream_to_lake(spark, read_kafka(spark, options), master_path, lake_path,
                                 checkpoint, cut)


def lake_cut_token(spark: SparkSession, lake_path: str, default, since=None) -> DataFrame:
    """The lake high-water mark handed to the next enrichment run: one row
    ``cut_date`` plus ``token``, its base64 text form for passing between
    processes (``decode_cut_token`` reverses it). The newest month comes from the
    lake's record or its folders' names; only that month's dates are read. (A plain
    file stream's folders may hold files it has not committed: there ``since``, the
    last known cut, leaves the files of all months before it unopened.)"""
    by_name = not path_exists(spark, f"{lake_path.rstrip('/')}/_spark_metadata")
    cut = lake_cut(read_lake(spark, lake_path), default, since=since,
                   newest=newest_month(spark, lake_path) if by_name else None)
    return cut.withColumn("token", encode_cut_token("cut_date"))


def load_warehouse(spark: SparkSession, lake_path: str, warehouse, initial_cut,
                   lookback_days: int = 0, reject_table: str | None = "market_data_rejects") -> dict:
    """Lake -> warehouse ``market_data`` by high-water mark, idempotently.
    Rows breaking the table's length limits go to ``reject_table`` instead of
    failing the whole insert. ``year`` and ``month`` are no columns of the table:
    they are written only to a warehouse that keeps it partitioned by them.

    From a lake with a record of its batches exactly the batches not loaded yet are
    taken, whatever their dates; ``lookback_days`` serves other lakes, whose rows
    are found by date alone."""
    parts = getattr(warehouse, "partition_by", {}).get("market_data") or []
    extra = [c for c in schemas.LAKE_PARTITION_COLUMNS if c not in parts]
    if LandedLog(spark, lake_path).exists():
        return load_landed(spark, lake_path, warehouse, initial_cut=initial_cut, drop_columns=extra,
                           contract=MARKET_DATA_CONTRACT, reject_table=reject_table)
    return load_increment(spark.read.parquet(lake_path), warehouse, initial_cut=initial_cut, lookback_days=lookback_days,
                          drop_columns=extra, contract=MARKET_DATA_CONTRACT, reject_table=reject_table)


def publish_articles(spark: SparkSession, texts_path: str, tickers, warehouse,
                     table: str = "articles", reject_table: str = "articles_rejects",
                     horizon_days: int | None = None, table_shape: bool = False,
                     whole_files: bool = False, spread_tasks: int | None = None) -> dict:
    """News texts -> ``articles`` and, for rows breaking the table's contract,
    ``reject_table`` with their ``violations`` (both overwritten).

    Texts are JSON arrays of articles or page envelopes, one per line or, with
    ``whole_files``, one per file (pretty-printed ones need that).
    ``horizon_days`` keeps articles published within that many days before now;
    ``table_shape`` writes only the table's own columns (for a warehouse that
    keeps its table definitions on overwrite); ``spread_tasks`` deals few
    unsplittable files over so many tasks. The rows are computed once, staged,
    and written from there. Returns counts, taken from the same pass, also of texts that
    are neither form and of articles that a horizon leaves out as they have no readable time.
    """
    after = None
    if horizon_days is not None:
        after = F.current_timestamp() - F.make_interval(days=F.lit(horizon_days))
    texts = spread(read_article_texts(spark, texts_path, whole_files), spread_tasks)
    rows = related_as_text(flatten_with_status(texts, tickers, published_after=after))
    if table_shape:
        rows = articles_table_rows(rows, "status")
    stage = scratch_path(spark, "stage-articles")
    staged = with_violations(rows, ARTICLES_CONTRACT)
    staged.write.parquet(stage)
    staged = spark.read.schema(staged.schema).parquet(stage)
    bad, status = F.size("violations") > 0, F.col("status")
    counts = staged.agg(F.count(F.when((status == OK) & ~bad, 1)).alias("good"), F.count(F.when((status == OK) & bad, 1)).alias("bad"),
                        *[F.count(F.when(status == s, 1)).alias(s) for s in (UNDATED, UNPARSED)]).first()
    staged = staged.where(status == OK).drop("status")
    warehouse.overwrite(table, staged.where(~bad).drop("violations"))
    warehouse.overwrite(reject_table, staged.where(bad).withColumn("violations", F.array_join("violations", ",")))
    delete_path(spark, stage)
    return {"rows_published": counts["good"], "rows_rejected": counts["bad"],
            "texts_unparsed": counts[UNPARSED], "articles_undated": counts[UNDATED]}


def stream_articles(spark: SparkSession, texts_path: str, tickers, out_path: str, checkpoint: str,
                    delay_days: int = 100, whole_files: bool = False,
                    max_files_per_trigger: int | None = None) -> dict:
    """News texts that have landed since the last run -> article rows appended to
    ``out_path``, each article once over all runs (``news.new_articles``). Every text is read
    once, not every day. Returns counts of the run: articles read, undated, too late."""
    reader = spark.readStream.format("text").option("wholetext", whole_files)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    texts = reader.load(texts_path).select(F.col("value").alias("json_data"))
    sums = run_totals(related_as_text(new_articles(texts, tickers, delay_days)), out_path, checkpoint)
    return {"articles_read": sums.get(f"{ARTICLE_METRICS}.read", 0), "articles_late": sums["late"],
            "articles_undated": sums.get(f"{ARTICLE_METRICS}.undated", 0)}


def sentiment_study(articles: DataFrame, bars: DataFrame, lag_days: int = 0) -> DataFrame:
    """Per ticker: how article sentiment relates to price returns.

    ``articles`` are flattened article rows (``ticker, publication_date,
    sentiment``); ``bars`` are lake rows (``ticker, transaction_date,
    close_price``). Bars are first reduced to one close per (ticker, day)
    (their mean, should a day hold several rows), so every per-ticker window
    runs on a calendar-sized series.
    """
    closes = (bars.groupBy("ticker", "transaction_date")
              .agg(F.avg("close_price").alias("close_price")))
    return sentiment_price_corr(daily_sentiment(articles), daily_return(closes), lag_days)


def rolling_study(articles: DataFrame, bars: DataFrame, days: int = 90, lag_days: int = 0) -> DataFrame:
    """The study of ``sentiment_study`` over time: for each ticker and day the correlation of the last ``days`` days."""
    closes = (bars.groupBy("ticker", "transaction_date")
              .agg(F.avg("close_price").alias("close_price")))
    pairs = sentiment_vs_return(daily_sentiment(articles), daily_return(closes), lag_days)
    return rolling_corr(daily_moments(pairs), days)


def daily_run(spark: SparkSession, *, master_raw_path: str, master_path: str,
              bar_messages_path: str, lake_path: str, lake_checkpoint: str, warehouse,
              news_texts_path: str, tickers, initial_cut, first_day_after=None,
              max_files_per_trigger: int | None = None,
              horizon_days: int | None = 100, whole_files: bool = False) -> dict:
    """One day's steps in order: clean master, bring in the bars that waited for
    it, enrich landed bars, load the warehouse, publish articles.

    The stream's checkpoint is its progress: every landed bar is read once and
    kept, however late its date, unless it is not after ``first_day_after`` (a
    fixed floor, None: none). A bar that comes before its master row waits in the
    lake's store of unmatched bars. The load takes the batches the lake's record
    names as new, so late bars reach the warehouse too; the news step reads the
    last ``horizon_days``.
    """
    master = clean_master_table(spark, master_raw_path, master_path)
    replayed = replay_unmatched(spark, lake_path, master)
    messages = read_message_files(spark, bar_messages_path, streaming=True,
                                  max_files_per_trigger=max_files_per_trigger)
    routes = enrich_stream_to_lake(spark, messages, master_path, lake_path, lake_checkpoint,
                                   first_day_after)
    loaded = load_warehouse(spark, lake_path, warehouse, initial_cut)
    articles = publish_articles(spark, news_texts_path, tickers, warehouse,
                                horizon_days=horizon_days, whole_files=whole_files)
    summary = {"bars_in": sum(routes.values()), "bars_by_route": routes, "bars_replayed": replayed.get(TO_LAKE, 0),
               "load": loaded, "articles": articles}
    log.info("daily run: %s", summary)
    return summary
