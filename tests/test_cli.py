"""The command line, run as its own process."""

import argparse
import base64
import datetime as dt
import json
import os
import subprocess
import sys

import pytest

from marketflow import __main__ as cli
from marketflow.sinks.parquet import append_lake

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(*args):
    cmd = [sys.executable, "-m", "marketflow", "--master-url", "local[2]",
           "--conf", "spark.ui.enabled=false", "--conf", "spark.ui.showConsoleProgress=false", *args]
    out = subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return (out.stdout.strip().splitlines() or [""])[-1]


def test_lake_cut_then_load(spark, scratch):
    lake, wh = scratch("lake"), scratch("wh")
    from marketflow.schemas import ENRICHED_BAR
    bar = ("n", "stocks", "us", "X", "CS", True, "usd", "1")
    rows = [bar + (t, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, d)
            for t, d in [("A", dt.date(2024, 1, 2)), ("B", dt.date(2024, 2, 3))]]
    append_lake(spark.createDataFrame(rows, ENRICHED_BAR), lake)
    token = _cli("lake-cut", "--lake", lake, "--default", "2023-01-01")
    assert base64.b64decode(token).decode().strip() == "2024-02-03"
    out = json.loads(_cli("load", "--lake", lake, "--warehouse", wh, "--initial-cut", "2024-01-01"))
    assert out["rows_loaded"] == 2 and out["cut_after"] == "2024-02-03"


def test_news_step(spark, scratch):
    news, wh = scratch("news"), scratch("wh")
    article = {"title": "t", "publisher": {"name": "p"}, "author": "a",
               "published_utc": "2024-06-04T10:00:00Z",
               "insights": [{"ticker": "A", "sentiment": "positive"},
                            {"ticker": "A", "sentiment": "way too long label"}]}
    spark.createDataFrame([(json.dumps([article, article]),)], "value string").write.text(news)
    out = json.loads(_cli("news", "--texts", news, "--tickers", "A,B", "--warehouse", wh))
    assert out["rows_published"] == 1 and out["rows_rejected"] == 1
    rows = spark.read.parquet(f"{wh}/articles").collect()
    assert [(r.ticker, r.sentiment) for r in rows] == [("A", "positive")]


def test_steps_from_messages_to_the_study(spark, scratch):
    def land(name, objs):
        path = scratch(name)
        spark.createDataFrame([(json.dumps(o),) for o in objs], "value string").coalesce(1).write.text(path)
        return path
    raw, master, lake, news, study = (scratch(n) for n in ("raw", "master", "lake", "news", "study"))
    names = land("names", [{"ticker": t, "name": t, "market": "stocks", "locale": "us", "primary_exchange": "X", "type": "CS", "active": True,
                            "currency_name": "usd", "cik": "1", "last_updated_utc": "2024-01-01T00:00:00Z"} for t in "AB"])
    closes = [10.0, 11.0, 11.0, 12.5, 12.0, 13.0]
    bars = land("bars", [{"T": t, "v": 1, "vw": 1.5, "o": 1, "c": c, "h": 3, "l": 0.5, "n": 1, "date_time": f"2024-06-{3 + i:02d}"}
                         for i, c in enumerate(closes) for t in "AZ"])
    moods = ["positive", "neutral", "positive", "negative", "positive"]
    texts = land("texts", [[{"title": f"t{i}", "publisher": {"name": "p"}, "author": "a", "published_utc": f"2024-06-{4 + i:02d}T10:00:00Z",
                             "insights": [{"ticker": "A", "sentiment": m}]}] for i, m in enumerate(moods)])
    assert json.loads(_cli("ingest-master", "--messages", names, "--raw", raw, "--checkpoint", scratch("c1"))) == {"rows_in": 2}
    _cli("clean-master", "--raw", raw, "--out", master)
    routes = json.loads(_cli("enrich", "--messages", bars, "--master", master, "--lake", lake, "--checkpoint", scratch("c2"), "--cut", "2024-06-01"))
    assert routes["messages_in"] == 12 and sorted(v for k, v in routes.items() if k != "messages_in") == [6, 6]
    stream = ("news-stream", "--texts", texts, "--tickers", "A", "--out", news, "--checkpoint", scratch("c3"))
    assert json.loads(_cli(*stream))["articles_read"] == 5 and json.loads(_cli(*stream))["articles_read"] == 0
    _cli("study", "--articles", news, "--lake", lake, "--out", study, "--days", "30")
    got = {str(r.day): (r.n_pairs, r["corr"]) for r in spark.read.parquet(study).collect()}
    returns = [b / a - 1 for a, b in zip(closes, closes[1:])]
    scores = [{"positive": 1, "neutral": 0, "negative": -1}[m] for m in moods]
    mean_x, mean_y = sum(scores) / 5, sum(returns) / 5
    cov = sum((x - mean_x) * (y - mean_y) for x, y in zip(scores, returns))
    corr = cov / (sum((x - mean_x) ** 2 for x in scores) * sum((y - mean_y) ** 2 for y in returns)) ** 0.5
    assert got["2024-06-08"][0] == 5 and abs(got["2024-06-08"][1] - corr) < 1e-9 and len(got) == 5


def test_topic_arguments(capsys):
    args = argparse.Namespace(brokers="b:1", topic="bars", option=["startingOffsets=earliest", "kafka.security.protocol=SASL_SSL"])
    assert cli._topic_options(args) == {"kafka.bootstrap.servers": "b:1", "subscribe": "bars", "startingOffsets": "earliest",
                                        "kafka.security.protocol": "SASL_SSL"}
    for wrong in (["ingest-master", "--topic", "t"], ["ingest-master"], ["ingest-master", "--topic", "t", "--messages", "m"]):
        with pytest.raises(SystemExit):
            cli.main([*wrong, "--raw", "r", "--checkpoint", "c"])
    assert "--topic needs --brokers" in capsys.readouterr().err
