"""Sentiment/return signals, calendars, contracts, unions."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.operators.calendar import calendar_gaps, day_calendar, month_calendar
from marketflow.operators.contracts import ARTICLES_CONTRACT, Rule, contract_report, split_by_contract
from marketflow.operators.rows import union_to_schema
from marketflow.operators.signals import (
    daily_return, daily_sentiment, guarded_pearson, next_trading_day, sentiment_price_corr,
)


def _corr(spark, pairs):
    df = spark.createDataFrame(pairs, "g string, x double, y double")
    return {r.g: r.c for r in df.groupBy("g").agg(guarded_pearson("x", "y").alias("c")).collect()}


def test_guarded_pearson_cases(spark):
    got = _corr(spark, [("const", 1.0, 1.0), ("const", 1.0, 2.0), ("one", 1.0, 2.0),
                        ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0)])
    assert got["const"] is None and got["one"] is None
    assert abs(got["line"] - 1.0) < 1e-12


def D(s):
    return dt.date.fromisoformat(s)


def test_weekend_article_rolls_to_next_trading_day(spark):
    # 2024-06-07 is a Friday; trading days Fri and Mon
    trading = spark.createDataFrame([("A", D("2024-06-07")), ("A", D("2024-06-10"))], "ticker string, day date")
    days = spark.createDataFrame([("A", D("2024-06-07")), ("A", D("2024-06-08")),
                                  ("A", D("2024-06-11"))], "ticker string, day date")
    got = {r.day: r.next_trade for r in next_trading_day(days, trading).collect()}
    assert got == {D("2024-06-07"): D("2024-06-07"), D("2024-06-08"): D("2024-06-10"),
                   D("2024-06-11"): None}


def test_return_and_correlation_exact_line(spark):
    closes = spark.createDataFrame(
        [("A", D("2024-06-03"), 100.0), ("A", D("2024-06-04"), 110.0), ("A", D("2024-06-05"), 99.0),
         ("A", D("2024-06-06"), 118.8)], "ticker string, transaction_date date, close_price double")
    ret = {r.day: r.ret for r in daily_return(closes).collect()}
    assert ret[D("2024-06-03")] is None and abs(ret[D("2024-06-04")] - 0.1) < 1e-12
    # scores chosen on an exact line with the same-day return: score = 10 * ret
    arts = spark.createDataFrame(
        [("A", D("2024-06-04"), "positive"), ("A", D("2024-06-05"), "negative"),
         ("A", D("2024-06-06"), "positive"), ("A", D("2024-06-06"), "positive")],
        "ticker string, publication_date date, sentiment string")
    corr = sentiment_price_corr(daily_sentiment(arts), daily_return(closes)).first()
    assert corr.n_pairs == 3 and corr.corr is not None and corr.corr > 0.9


def test_day_and_month_calendar_and_gaps(spark):
    b = spark.createDataFrame([(D("2023-11-30"), D("2024-02-02"))], "s date, e date")
    months = [(r.year, r.month) for r in month_calendar(b, "s", "e", "lake").orderBy("year", "month").collect()]
    assert months == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    path = month_calendar(b, "s", "e", "root").first().path
    assert path == "root/year=2023/month=11"
    days = day_calendar(b, "s", "e")
    assert days.count() == (D("2024-02-02") - D("2023-11-30")).days + 1
    seen = spark.createDataFrame([(D("2023-11-30") + dt.timedelta(days=i),) for i in range(0, 65, 2)], "day date")
    gaps = calendar_gaps(days, seen).count()
    assert gaps == days.count() - seen.count()


def test_contract_split_and_report(spark):
    rows = spark.createDataFrame(
        [("t", "p", "a", "2024-06-03", "AAA", "positive"),
         (None, "p", "a", "2024-06-03", "AAA", "positive"),
         ("t", "p", None, "2024-06-03", "AVERYLONGTICKER", "positive")],
        "article_title string, publisher string, author string, publication_date string, "
        "ticker string, sentiment string")
    valid, rejected = split_by_contract(rows, ARTICLES_CONTRACT)
    assert valid.count() == 1
    reasons = sorted(tuple(r.violations) for r in rejected.collect())
    assert reasons == [("article_title_null",), ("ticker_too_long",)]
    rep = {r.rule: r.n_rows for r in contract_report(rows, ARTICLES_CONTRACT, "articles").collect()}
    assert rep["valid"] == 1 and rep["ticker_too_long"] == 1 and rep["article_title_null"] == 1


def test_union_widens_int_to_double(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    ints = spark.createDataFrame([(1, 2)], "k long, v int")
    out = union_to_schema(spark, schema, [ints, ints], by_name=False)
    assert out.schema == schema and out.collect()[0].v == 2.0 and out.count() == 2


def test_next_trading_day_is_linear_in_a_tickers_days(spark):
    import time
    n = 40_000
    start = spark.range(n).selectExpr("'A' AS ticker", "date_add(date'1900-01-01', cast(id AS int)) AS day")
    trading = start.where("weekday(day) < 5")
    began = time.time()
    out = next_trading_day(start, trading)
    late = out.where("next_trade <> day").count()
    assert time.time() - began < 15
    assert 0 < late < n * 0.3
