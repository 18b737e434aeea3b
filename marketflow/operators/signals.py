"""News sentiment against price behaviour.

Every per-ticker window below runs on series already reduced to one row per
(ticker, day), so a window partition holds at most one row per calendar day of
that ticker however many bars or articles the ticker has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.sentiment import sentiment_score


def guarded_pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that is null (never an error) for fewer than two
    pairs or a constant side. ``corr`` raises a divide-by-zero under ANSI for
    a constant group, so it is built from population moments with a guard."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    ok = (F.count(F.lit(1)) > 1) & (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    denom = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(ok, F.try_divide(F.covar_pop(x, y), F.nullif(denom, F.lit(0.0))))


def daily_sentiment(articles: DataFrame, ticker: str = "ticker", day: str = "publication_date",
                    sentiment: str = "sentiment") -> DataFrame:
    """One row per (ticker, day): ``score_sum``, ``n_articles``, ``avg_score``.
    Articles whose label has no score are left out."""
    scored = articles.select(
        F.col(ticker).alias("ticker"), F.col(day).try_cast("date").alias("day"),
        sentiment_score(sentiment).alias("score"),
    ).where(F.col("score").isNotNull() & F.col("day").isNotNull() & F.col("ticker").isNotNull())
    return scored.groupBy("ticker", "day").agg(
        F.sum("score").cast("long").alias("score_sum"),
        F.count(F.lit(1)).alias("n_articles"),
        F.avg("score").alias("avg_score"),
    )


def daily_return(closes: DataFrame, ticker: str = "ticker", day: str = "transaction_date",
                 close: str = "close_price") -> DataFrame:
    """``ret = close / previous trading day's close - 1`` per ticker.

    ``closes`` must hold one row per (ticker, day) (reduce bars first).
    """
    w = Window.partitionBy("ticker").orderBy("day")
    base = closes.select(F.col(ticker).alias("ticker"), F.col(day).cast("date").alias("day"),
                         F.col(close).alias("close"))
    prev = F.lag("close").over(w)
    return base.withColumn("ret", F.try_divide(F.col("close"), prev) - F.lit(1.0))


def _days_from_last():
    """Per ticker, all days on or after a row's day: a running frame, as days come in descending order."""
    return (Window.partitionBy("ticker").orderBy(F.col("day").desc())
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))


def next_trading_day(days: DataFrame, trading: DataFrame) -> DataFrame:
    """For each (ticker, day) of ``days``: the first trading day on or after it
    for that ticker (null when there is none yet).

    Computed as an as-of lookup without a range join: both day lists are
    unioned, and a running ``min`` over the ticker's days from the last to the
    first picks the next trading day (linear in the series' length).
    """
    marks = days.select("ticker", "day", F.lit(None).cast("date").alias("trade_day"))
    trades = trading.select("ticker", "day", F.col("day").alias("trade_day")).distinct()
    both = marks.unionByName(trades).withColumn("next_trade", F.min("trade_day").over(_days_from_last()))
    return both.where(F.col("trade_day").isNull()).select("ticker", "day", "next_trade")


def sentiment_vs_return(sentiment_daily: DataFrame, returns: DataFrame, lag_days: int = 0) -> DataFrame:
    """Per (ticker, trading day): average score of the articles that count to
    that day (a non-trading day rolls forward to the next trading day; after
    the last one it is dropped) and the return ``lag_days`` trading days later.

    One pass: daily sentiment rows and trading-day rows are unioned, a
    running ``min`` finds each row's trading day, and one aggregate
    per (ticker, trading day) combines both sides. Each input is read once.
    """
    w = Window.partitionBy("ticker").orderBy("day")
    future = F.lead("ret", lag_days).over(w) if lag_days else F.col("ret")
    trades = returns.select("ticker", "day", future.alias("ret_k"),
                            F.col("day").alias("trade_day"),
                            F.lit(None).cast("long").alias("score_sum"),
                            F.lit(None).cast("long").alias("n_articles"))
    marks = sentiment_daily.select("ticker", "day", F.lit(None).cast("double").alias("ret_k"),
                                   F.lit(None).cast("date").alias("trade_day"),
                                   "score_sum", "n_articles")
    both = trades.unionByName(marks).withColumn("next_trade", F.min("trade_day").over(_days_from_last()))
    per_day = both.where(F.col("next_trade").isNotNull()).groupBy("ticker", "next_trade").agg(
        (F.sum("score_sum") / F.sum("n_articles")).alias("avg_score"),
        F.max("ret_k").alias("ret"),
        F.count("trade_day").alias("_is_trade"),
    )
    return per_day.where(F.col("_is_trade") > 0).select(
        "ticker", F.col("next_trade").alias("day"), "avg_score", "ret")


def sentiment_price_corr(sentiment_daily: DataFrame, returns: DataFrame, lag_days: int = 0) -> DataFrame:
    """Per ticker: ``n_pairs`` and guarded Pearson ``corr`` of the average
    sentiment score against the (lagged) daily return."""
    pairs = sentiment_vs_return(sentiment_daily, returns, lag_days) \
        .where(F.col("avg_score").isNotNull() & F.col("ret").isNotNull())
    return pairs.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        guarded_pearson("avg_score", "ret").alias("corr"),
    )


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def daily_moments(pairs: DataFrame, x: str = "avg_score", y: str = "ret") -> DataFrame:
    """Per (ticker, day): count and sums of ``x, y, x*x, y*y, x*y`` over the pairs with both sides.

    Sums of several days, or of partial tables, add up to those of their union. They are
    exact decimals of values rounded to 9 places, so what is added can be taken
    away again without a trace; a value of 1e9 or more leaves its pair out.
    """
    exact = lambda c: F.round(F.col(c), 9).try_cast("decimal(18,9)")
    rows = pairs.select("ticker", "day", exact(x).alias("x"), exact(y).alias("y"))
    rows = rows.where(F.col("ticker").isNotNull() & F.col("day").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    products = {"sx": F.col("x"), "sy": F.col("y"), "sxx": F.col("x") * F.col("x"), "syy": F.col("y") * F.col("y"),
                "sxy": F.col("x") * F.col("y")}
    return rows.groupBy("ticker", "day").agg(F.count("*").alias("n"), *[F.sum(v).alias(k) for k, v in products.items()])


def moments_corr() -> Column:
    """Pearson correlation from a row of moments; null for fewer than two pairs or a constant side, as ``guarded_pearson``."""
    n = F.col("n").cast("decimal(7,0)")

    def spread(ab: str, a: str, b: str) -> Column:
        narrow = lambda c: F.col(c).try_cast("decimal(18,9)")
        return n * F.col(ab).try_cast("decimal(30,18)") - narrow(a) * narrow(b)
    xx, yy, xy = spread("sxx", "sx", "sx"), spread("syy", "sy", "sy"), spread("sxy", "sx", "sy")
    root = F.sqrt(xx.cast("double")) * F.sqrt(yy.cast("double"))
    return F.when((F.col("n") > 1) & (xx > 0) & (yy > 0), F.try_divide(xy.cast("double"), root))


def rolling_corr(moments: DataFrame, days: int) -> DataFrame:
    """``ticker, day, n_pairs, corr`` for each day with pairs, over the ``days`` calendar days that end with it.

    Every day's moments are added on their day and taken away ``days`` later, so
    one running sum per ticker gives all windows, whatever their length. The sums
    are exact, so nothing drifts and a constant side is told as such.
    """
    leave = moments.select("ticker", F.date_add("day", days).alias("day"), F.lit(0).alias("here"),
                           *[(-F.col(c)).alias(c) for c in _MOMENTS])
    both = moments.withColumn("here", F.lit(1)).unionByName(leave)
    w = Window.partitionBy("ticker").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # One row a day before the window, so a day that is left on and one that is counted meet in it.
    daily = both.groupBy("ticker", "day").agg(F.max("here").alias("here"), *[F.sum(c).alias(c) for c in _MOMENTS])
    summed = daily.select("ticker", "day", "here", *[F.sum(c).over(w).alias(c) for c in _MOMENTS])
    return summed.where("here = 1").select("ticker", "day", F.col("n").alias("n_pairs"), moments_corr().alias("corr"))
