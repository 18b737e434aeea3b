"""News articles -> one row per (article, insight) for watched tickers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.functions.dates import ISO_Z_FORMAT, day_text, published_date


def explode_articles(texts: DataFrame, text_col: str = "json_data") -> DataFrame:
    """Texts holding a JSON array of articles, or a page envelope with the
    articles in ``results`` -> one row per article document. Only the fields
    used further on are parsed."""
    return texts.select(F.explode(article_documents(text_col)).alias("a")).select("a.*")


def article_documents(text_col: str = "json_data") -> Column:
    """The article documents of a text as an array; null for a text that is neither form."""
    text = F.col(text_col)
    pages = F.from_json(text, schemas.envelope(schemas.ARTICLE_USED)).getField("results")
    return F.when(F.ltrim(text).startswith("{"), pages).otherwise(
        F.from_json(text, T.ArrayType(schemas.ARTICLE_USED, True)))


def article_projection(articles: DataFrame, *more: str) -> DataFrame:
    """The article fields kept, with the insight lists still as arrays.

    Distinct on these columns, the same article returned for several ticker
    requests collapses to one before it is exploded.
    """
    return articles.select(
        # The output column names are those of the articles table.
        F.col("title").alias("article_title"),
        F.col("publisher.name").alias("publisher"),
        F.col("author"),
        day_text(published_date("published_utc")).alias("publication_date"),
        F.col("insights.ticker").alias("ticker"),
        F.col("insights.sentiment").alias("sentiment"),
        *more,
    )


def zip_explode(df: DataFrame, left: str, right: str, alias: str = "z") -> DataFrame:
    """Pair two arrays by position and emit one row per pair (null/empty -> none)."""
    return df.withColumn(alias, F.explode(F.arrays_zip(F.col(left), F.col(right))))


def _ticker_list(tickers) -> list[str] | None:
    """A comma list or a sequence of tickers as a list; None for a frame."""
    if tickers is None or isinstance(tickers, DataFrame):
        return None
    if isinstance(tickers, str):
        return [t.strip() for t in tickers.split(",") if t.strip()]
    return list(tickers)


def keep_tickers(df: DataFrame, tickers, col: str = "ticker") -> DataFrame:
    """Rows whose ``col`` is in ``tickers``.

    ``tickers`` is a comma list, a Python list (a literal ``IN``), or a frame
    with a ``ticker`` column (left-semi join; Spark broadcasts it only below
    its own threshold).
    """
    if tickers is None:
        return df
    if isinstance(tickers, str):
        tickers = _ticker_list(tickers)
    if isinstance(tickers, DataFrame):
        watch = tickers.select(F.col("ticker").alias("_watch")).distinct()
        return df.join(watch, df[col] == watch["_watch"], "left_semi")
    return df.where(F.col(col).isin(list(tickers)))


def flatten_articles(texts: DataFrame, tickers=None, text_col: str = "json_data",
                     published_after=None) -> DataFrame:
    """Article texts -> ``ticker, article_title, publisher, author,
    publication_date, sentiment, related_ticker``.

    ``related_ticker`` is the whole insight ticker list of the article. An
    article without insights gives no rows; an insight without sentiment gives
    a null sentiment; a null insight gives a null ticker, which the ticker
    filter removes. The same ticker twice in one article gives two rows.
    ``published_after`` (a timestamp value or Column, e.g. ``anchor - 100
    days``) keeps only articles published strictly later, the news horizon;
    times with fractional seconds or an offset count too, and an article whose
    time cannot be read at all is left out.
    """
    articles = explode_articles(texts, text_col)
    if published_after is not None:
        bound = published_after if isinstance(published_after, Column) else F.lit(published_after)
        articles = articles.where(published_time() > bound)
    projected = article_projection(_naming(articles, tickers)).dropDuplicates()
    return keep_tickers(_insight_rows(projected), tickers)


def published_time() -> Column:
    """An article's time; also with fractional seconds or an offset; null if it cannot be read."""
    return F.coalesce(F.try_to_timestamp(F.col("published_utc"), F.lit(ISO_Z_FORMAT)),
                      F.col("published_utc").try_cast("timestamp"))


def _naming(articles: DataFrame, tickers) -> DataFrame:
    """Articles naming no watched ticker give no rows: drop them before the
    de-duplication rather than after the explode."""
    watched = _ticker_list(tickers)
    if watched is None:
        return articles
    return articles.where(F.exists(F.col("insights"), lambda i: i.getField("ticker").isin(watched)))


def _insight_rows(projected: DataFrame) -> DataFrame:
    zipped = zip_explode(projected, "ticker", "sentiment")
    return zipped.select(
        F.col("z.ticker").alias("ticker"),
        "article_title", "publisher", "author", "publication_date",
        F.col("z.sentiment").alias("sentiment"),
        F.col("ticker").alias("related_ticker"),
    )


# What became of a text or an article on its way to the rows.
OK, UNDATED, UNPARSED = "ok", "undated", "unparsed"


def flatten_with_status(texts: DataFrame, tickers=None, text_col: str = "json_data", published_after=None) -> DataFrame:
    """The rows of ``flatten_articles`` with ``status`` ok, and beside them, from the same pass over the texts, a row
    without values for every text that is neither form (``unparsed``) and, under ``published_after``, for every
    distinct article whose time cannot be read (``undated``)."""
    documents = article_documents(text_col)
    read = texts.select(documents.alias("docs"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("nth"))
    last_page = F.from_json("text", schemas.envelope(T.StringType())).getField("request_id").isNotNull()
    lost = F.col("docs").isNull() & (F.trim("text") != "") & ~last_page
    docs = read.select(F.explode_outer("docs").alias("a"), F.when(lost, F.col("nth")).alias("_text")) \
        .where(F.col("a").isNotNull() | F.col("_text").isNotNull())
    articles = docs.select("a.*", "_text")
    status = F.when(F.col("_text").isNotNull(), UNPARSED)
    if published_after is not None:
        bound = published_after if isinstance(published_after, Column) else F.lit(published_after)
        articles = articles.where(F.col("_text").isNotNull() | published_time().isNull() | (published_time() > bound))
        status = status.when(published_time().isNull(), UNDATED)
    articles = articles.withColumn("status", status.otherwise(OK))
    watched = _ticker_list(tickers)
    if watched is not None:
        articles = articles.where((F.col("status") != OK) | F.exists(F.col("insights"), lambda i: i.getField("ticker").isin(watched)))
    once = article_projection(articles, "status", "_text").dropDuplicates()
    pairs = F.when(F.col("status") == OK, F.arrays_zip("ticker", "sentiment"))
    rows = once.withColumn("z", F.explode_outer(pairs)).where((F.col("status") != OK) | F.col("z").isNotNull())
    rows = rows.select(F.col("z.ticker").alias("ticker"), "article_title", "publisher", "author", "publication_date",
                       F.col("z.sentiment").alias("sentiment"), F.col("ticker").alias("related_ticker"), "status")
    if tickers is None:
        return rows
    if isinstance(tickers, DataFrame):
        watch = tickers.select(F.col("ticker").alias("_watch")).distinct()
        rows = rows.join(watch, rows["ticker"] == watch["_watch"], "left")
        return rows.where((F.col("status") != OK) | F.col("_watch").isNotNull()).drop("_watch")
    return rows.where((F.col("status") != OK) | F.col("ticker").isin(watched))


ARTICLE_METRICS = "articles"


def new_articles(texts: DataFrame, tickers=None, delay_days: int = 100, text_col: str = "json_data") -> DataFrame:
    """The rows of ``flatten_articles`` for a stream of texts, each article once however often it is returned.

    De-duplication is stateful: the state holds a day and a digest per article, not the
    article, and forgets days more than ``delay_days`` before the newest one seen. An
    article that old is taken for known (or out of the horizon) and left out, as
    is one whose time cannot be read; both are counted, the latter as ``undated``
    in the observed metrics ``articles`` (whose ``read`` counts all). Articles alike
    but for the time of day are one.
    """
    articles = explode_articles(texts, text_col).withColumn("_day", F.date_trunc("day", published_time()))
    articles = articles.observe(ARTICLE_METRICS, F.count(F.lit(1)).alias("read"),
                                F.count(F.when(F.col("_day").isNull(), 1)).alias("undated"))
    dated = _naming(articles.where(F.col("_day").isNotNull()), tickers)
    projected = article_projection(dated, "_day")
    digest = F.sha2(F.to_json(F.struct(*[c for c in projected.columns if c != "_day"]), {"ignoreNullFields": "false"}), 256)
    once = (projected.withColumn("_digest", digest).withWatermark("_day", f"{delay_days} days")
            .dropDuplicates(["_day", "_digest"]))
    return keep_tickers(_insight_rows(once), tickers)


def related_as_text(df: DataFrame, col: str = "related_ticker", sep: str = ",") -> DataFrame:
    """Array column -> joined text (for JDBC and for comparisons)."""
    return df.withColumn(col, F.array_join(F.col(col), sep))


def insight_struct(sentiment: Column, reasoning: Column, ticker: Column) -> Column:
    """Build one insight element (used when assembling article documents)."""
    return F.struct(sentiment.alias("sentiment"), reasoning.alias("sentiment_reasoning"),
                    ticker.alias("ticker"))


# The columns of the warehouse ``articles`` table, in order.
ARTICLES_TABLE_COLUMNS = ["article_title", "publisher", "author", "publication_date", "ticker",
                          "sentiment"]


def articles_table_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Flattened article rows in the shape of the ``articles`` table: its six
    columns, ``publication_date`` as a DATE (no related-ticker list)."""
    return rows.select(*[F.col(c).try_cast("date").alias(c) if c == "publication_date" else F.col(c)
                         for c in ARTICLES_TABLE_COLUMNS], *more)
