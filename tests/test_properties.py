"""Property tests (hypothesis) on small generated inputs."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketflow.operators.calendar import day_calendar, month_calendar
from marketflow.operators.incremental import ParquetWarehouse, load_increment
from marketflow.operators.rows import dedupe_rows
from marketflow.sinks.parquet import append_lake

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                             st.one_of(st.none(), st.integers(0, 3))), max_size=30)
dates_st = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


@SETTINGS
@given(rows=rows_st)
def test_dedupe_idempotent_and_union_invariant(spark, rows):
    df = spark.createDataFrame(rows, "s string, i int")
    once = sorted(dedupe_rows(df).collect(), key=repr)
    assert once == sorted(dedupe_rows(dedupe_rows(df)).collect(), key=repr)
    assert once == sorted(dedupe_rows(df.unionAll(df)).collect(), key=repr)
    assert len(once) == len(set(rows))


@SETTINGS
@given(a=dates_st, b=dates_st)
def test_month_calendar_contiguous(spark, a, b):
    s, e = min(a, b), max(a, b)
    bounds = spark.createDataFrame([(s, e)], "s date, e date")
    months = sorted((r.year, r.month) for r in month_calendar(bounds, "s", "e").collect())
    assert months[0] == (s.year, s.month) and months[-1] == (e.year, e.month)
    for (y1, m1), (y2, m2) in zip(months, months[1:]):
        assert y2 * 12 + m2 == y1 * 12 + m1 + 1
    days = day_calendar(bounds, "s", "e").count()
    assert days == (e - s).days + 1


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets=st.lists(st.integers(0, 90), min_size=1, max_size=40),
       split=st.integers(0, 90), lookback=st.integers(0, 5))
def test_load_in_two_landings_equals_all_after_seed(spark, scratch, offsets, split, lookback):
    """However rows land, late ones too, with null keys, copies and whatever
    rows are re-read: with a lookback over the whole range the warehouse ends
    with every distinct lake row after the seed cut, exactly once."""
    base = dt.date(2024, 1, 1)
    rows = [(i // 2 if i % 5 else None, base + dt.timedelta(days=o)) for i, o in enumerate(offsets)]
    first = [r for i, r in enumerate(rows) if (i + split) % 3 == 0]  # by no rule of dates
    second = [r for i, r in enumerate(rows) if (i + split) % 3 != 0]
    lake = scratch("lake")
    wh = ParquetWarehouse(spark, scratch("wh"))
    seed = base + dt.timedelta(days=10)
    landed = False
    for part in (first, second):
        if part:
            append_lake(spark.createDataFrame(part, "k long, transaction_date date"), lake)
            landed = True
        if landed:
            for _ in range(1 + lookback % 2):
                load_increment(spark.read.parquet(lake), wh, initial_cut=seed, lookback_days=200)
    got = wh.read("market_data")
    expected = sorted({r for r in rows if r[1] > seed}, key=repr)
    found = sorted(((r.k, r.transaction_date) for r in got.collect()), key=repr) if got is not None else []
    assert found == expected


insight_st = st.one_of(
    st.none(),
    st.fixed_dictionaries({"ticker": st.sampled_from(["A", "B", "C"])},
                          optional={"sentiment": st.sampled_from(["positive", "negative"])}))
articles_st = st.lists(st.lists(insight_st, max_size=5), min_size=1, max_size=8)


@SETTINGS
@given(insight_lists=articles_st, repeats=st.integers(1, 3))
def test_flatten_counts_watched_insights(spark, insight_lists, repeats):
    import json as _json

    from marketflow.operators.news import flatten_articles
    docs = [{"title": f"t{i}", "publisher": {"name": "p"}, "author": "a",
             "published_utc": "2024-06-03T10:00:00Z", "insights": ins}
            for i, ins in enumerate(insight_lists)]
    texts = spark.createDataFrame([(_json.dumps(docs),)] * repeats, "json_data string")
    watched = ["A", "B"]
    expected = sum(1 for ins in insight_lists for i in ins if i is not None and i["ticker"] in watched)
    rows = flatten_articles(texts, watched).collect()
    assert len(rows) == expected
    assert all(r.ticker in watched for r in rows)
