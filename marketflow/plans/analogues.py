"""Mappings of the generic test tables onto the market-data shapes.

``part`` plays the ticker master, ``lineitem`` the daily bars, ``supplier`` a
small master for the stream, ``orders`` the lake and the cut tables, and
``events`` the messages, news articles and prices. Every rule here is a plain
column expression, so the DuckDB side can state the same rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.dates import ISO_Z_FORMAT
from marketflow.operators.news import insight_struct

# Fixed values of the mapping (the oracle SQL repeats them).
MASTER_VERSION_1 = "2024-01-01T00:00:00Z"
MASTER_VERSION_2 = "2024-06-01T00:00:00Z"
WATCHED_TICKERS = "click,view,purchase"
EVENTS_PER_ARTICLE = 10
ARTICLES_PER_TEXT = 20
EVENTS_PER_PAGE = 100


def _key_text(c: str) -> Column:
    return F.col(c).cast("string")


def part_as_master(part: DataFrame, version: str = MASTER_VERSION_1) -> DataFrame:
    """One master message row per part."""
    return part.select(
        _key_text("p_partkey").alias("ticker"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("market"),
        F.lit("us").alias("locale"),
        F.col("p_size").cast("string").alias("primary_exchange"),
        F.col("p_type").alias("type"),
        (F.col("p_size") > 25).alias("active"),
        F.lit("usd").alias("currency_name"),
        F.lpad(_key_text("p_partkey"), 10, "0").alias("cik"),
        F.lit(version).alias("last_updated_utc"),
    )


def part_as_master_renamed(part: DataFrame) -> DataFrame:
    """The second master version: active parts (``p_size > 25``) renamed."""
    v2 = part_as_master(part, MASTER_VERSION_2)
    return v2.withColumn("name", F.when(F.col("active"), F.concat(F.lit("new "), F.col("name")))
                         .otherwise(F.col("name")))


def supplier_as_master(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        _key_text("s_suppkey").alias("ticker"),
        F.col("s_name").alias("name"),
        F.lit("stocks").alias("market"),
        F.lit("us").alias("locale"),
        F.concat(F.lit("X"), F.col("s_nationkey").cast("string")).alias("primary_exchange"),
        F.lit("CS").alias("type"),
        (F.col("s_acctbal") > 0).alias("active"),
        F.lit("usd").alias("currency_name"),
        F.lpad(_key_text("s_suppkey"), 10, "0").alias("cik"),
        F.lit(MASTER_VERSION_1).alias("last_updated_utc"),
    )


def _bar_values(lineitem: DataFrame) -> list[Column]:
    price = F.col("l_extendedprice")
    return [
        _key_text("l_partkey"),
        F.col("l_quantity"),
        price,
        price,
        price * (F.lit(1) - F.col("l_discount")),
        price * (F.lit(1) + F.col("l_tax")),
        price * (F.lit(1) - F.col("l_discount")) * (F.lit(1) - F.col("l_tax")),
        F.col("l_linenumber"),
        F.col("l_shipdate").cast("date"),
    ]


def lineitem_as_bars(lineitem: DataFrame) -> DataFrame:
    """Typed bar rows (``ticker ... transaction_date``)."""
    names = ["ticker", "volume", "volume_weighted", "open_price", "close_price",
             "high_price", "low_price", "number_of_transaction", "transaction_date"]
    return lineitem.select(*[v.alias(n) for v, n in zip(_bar_values(lineitem), names)])


def line_mark() -> Column:
    """A number for each lineitem."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def lineitem_as_bar_messages(lineitem: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Bar messages as JSON text in ``value``, with the API's short names plus
    a field (``t``) the parser must ignore; ``ship_day`` is kept beside for
    landing the messages in batches.

    ``T`` and ``t`` differ only in case, so the object is built in one
    expression and never addressed by column name.
    """
    names = ["T", "v", "vw", "o", "c", "h", "l", "n", "date_time"]
    fields = [v.alias(n) for v, n in zip(_bar_values(lineitem), names)]
    fields.append(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("t"))
    return lineitem.select(F.to_json(F.struct(*fields)).alias("value"),
                           F.col("l_shipdate").cast("date").alias("ship_day"), *(keep or []))


def orders_as_lake_rows(orders: DataFrame) -> DataFrame:
    """Orders as dated lake rows with ``year``/``month``."""
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        day.alias("transaction_date"), "o_orderpriority",
        F.year(day).alias("year"), F.month(day).alias("month"),
    )


def article_id() -> Column:
    return F.expr(f"event_id div {EVENTS_PER_ARTICLE}")


def sentiment_band(value: Column) -> Column:
    """>20 positive, >10 neutral, >1 negative, else no sentiment."""
    return (F.when(value > 20, "positive").when(value > 10, "neutral")
            .when(value > 1, "negative"))


def events_as_articles(events: DataFrame) -> DataFrame:
    """One article document per block of consecutive events.

    Insights are the block's events in id order (ticker = event type,
    sentiment = banded value); every third article also carries a null
    insight, every fourth has no author.
    """
    ev = events.select(
        article_id().alias("aid"), "event_id", "ts",
        F.struct("event_id", insight_struct(
            sentiment_band(F.col("value")),
            F.concat(F.lit("value of event "), F.col("event_id").cast("string")),
            F.col("event_type")).alias("ins")).alias("ins"),
        "event_type",
    )
    arts = ev.groupBy("aid").agg(
        F.sort_array(F.collect_list("ins")).alias("ins"),
        F.min("ts").alias("first_ts"),
        F.array_sort(F.collect_set("event_type")).alias("tickers"),
    )
    insights = F.transform(F.col("ins"), lambda x: x.getField("ins"))
    insights = F.when(F.col("aid") % 3 == 0,
                      F.concat(insights, F.array(F.lit(None).cast(insights_type())))) \
        .otherwise(insights)
    aid_text = F.col("aid").cast("string")
    return arts.select(
        F.col("aid"),
        F.struct(
            F.lit(None).cast("string").alias("amp_url"),
            F.concat(F.lit("https://news.example/a/"), aid_text).alias("article_url"),
            F.when(F.col("aid") % 4 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("author "), (F.col("aid") % 13).cast("string"))).alias("author"),
            F.lit(None).cast("string").alias("description"),
            aid_text.alias("id"),
            F.lit(None).cast("string").alias("image_url"),
            insights.alias("insights"),
            F.array(F.lit("markets")).alias("keywords"),
            F.date_format("first_ts", ISO_Z_FORMAT).alias("published_utc"),
            F.struct(
                F.lit(None).cast("string").alias("favicon_url"),
                F.lit(None).cast("string").alias("homepage_url"),
                F.lit(None).cast("string").alias("logo_url"),
                F.concat(F.lit("publisher "), (F.col("aid") % 5).cast("string")).alias("name"),
            ).alias("publisher"),
            F.col("tickers"),
            F.concat(F.lit("article "), aid_text).alias("title"),
        ).alias("article"),
    )


def insights_type() -> str:
    return "struct<sentiment:string,sentiment_reasoning:string,ticker:string>"


def articles_as_texts(articles: DataFrame) -> DataFrame:
    """Bundle articles into JSON-array texts of at most ``ARTICLES_PER_TEXT``,
    each bundle also holding one article without insights. Every text is
    emitted twice, as overlapping requests return the same articles."""
    bundle = F.expr(f"aid div {ARTICLES_PER_TEXT}")
    grouped = articles.groupBy(bundle.alias("bundle")).agg(
        F.sort_array(F.collect_list(F.struct("aid", "article"))).alias("items"))
    empty = F.struct(
        *[F.lit(None).cast("string").alias(n) for n in
          ("amp_url", "article_url", "author", "description", "id", "image_url")],
        F.array().cast(f"array<{insights_type()}>").alias("insights"),
        F.array().cast("array<string>").alias("keywords"),
        F.lit(None).cast("string").alias("published_utc"),
        F.lit(None).cast("struct<favicon_url:string,homepage_url:string,logo_url:string,name:string>")
         .alias("publisher"),
        F.array().cast("array<string>").alias("tickers"),
        F.concat(F.lit("bundle "), F.col("bundle").cast("string")).alias("title"),
    )
    docs = F.concat(F.transform(F.col("items"), lambda x: x.getField("article")), F.array(empty))
    texts = grouped.select(F.to_json(docs).alias("value"))
    return texts.unionAll(texts)


def events_as_pages(events: DataFrame) -> DataFrame:
    """REST pages of events per request day (``EVENTS_PER_PAGE`` rows at most
    per page), plus one page per day without ``results`` (the last page)."""
    day = F.col("ts").cast("date")
    page = F.expr(f"event_id div {EVENTS_PER_PAGE}")
    item = F.struct("event_id", "user_id", "event_type", "value")
    pages = events.groupBy(day.alias("request_date"), page.alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("results"))
    body = F.struct(
        F.col("results"),
        F.lit(None).cast("string").alias("next_url"),
        F.concat(F.lit("req-"), F.col("request_date").cast("string"), F.lit("-"),
                 F.col("page").cast("string")).alias("request_id"))
    full = pages.select("request_date", F.to_json(body).alias("value"))
    last = events.select(day.alias("request_date")).distinct().select(
        "request_date",
        F.to_json(F.struct(F.concat(F.lit("req-"), F.col("request_date").cast("string"),
                                    F.lit("-end")).alias("request_id"))).alias("value"))
    return full.unionByName(last)


def events_as_scored_articles(events: DataFrame) -> DataFrame:
    """Article rows for the sentiment study: ticker = event type, date = the
    event's day, label by ``user_id % 3`` (0 positive, 1 neutral, 2 negative)."""
    label = (F.when(F.col("user_id") % 3 == 0, "positive")
             .when(F.col("user_id") % 3 == 1, "neutral").otherwise("negative"))
    return events.select(F.col("event_type").alias("ticker"),
                         F.col("ts").cast("date").alias("publication_date"),
                         label.alias("sentiment"))


def events_as_closes(events: DataFrame) -> DataFrame:
    """Daily close per event type on weekdays (the trading days): the mean
    value of that day's events, one row per (ticker, day)."""
    day = F.col("ts").cast("date")
    return (events.where(F.weekday(day) < 5)
            .groupBy(F.col("event_type").alias("ticker"), day.alias("transaction_date"))
            .agg(F.avg("value").alias("close_price")))
