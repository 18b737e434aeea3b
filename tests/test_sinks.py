"""Sink helpers that need no external system."""

from marketflow.sinks.jdbc import _jdbc_safe
from marketflow.sinks.parquet import append_lake


def test_arrays_become_text_for_jdbc(spark):
    df = spark.createDataFrame([("A", ["A", "B"]), ("B", None)], "ticker string, related array<string>")
    out = _jdbc_safe(df)
    assert dict(out.dtypes)["related"] == "string"
    assert sorted((r.ticker, r.related) for r in out.collect()) == [("A", "A,B"), ("B", None)]


def test_lake_append_writes_unpadded_partitions(spark, scratch):
    import datetime as dt
    path = scratch("lake")
    append_lake(spark.createDataFrame([(1, dt.date(2024, 6, 3))], "k long, transaction_date date"), path)
    leaf = spark.read.parquet(f"{path}/year=2024/month=6")
    assert leaf.count() == 1
