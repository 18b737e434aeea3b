"""Bar and master message parsing, envelopes, JSON encoding."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.functions.json import encode_rows, parse_messages
from marketflow.operators.enrich import bars_from_messages
from marketflow.sources.messages import flatten_envelopes


def _bars(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return bars_from_messages(parse_messages(df, schemas.BAR_MESSAGE))


def test_full_bar_parsed_extra_field_ignored(spark):
    msg = '{"T":"AAA","v":10,"vw":1.1,"o":1,"c":2,"h":3,"l":0.5,"n":7,"date_time":"2024-06-03","t":1}'
    row = _bars(spark, [msg]).first()
    assert row.asDict() == {
        "ticker": "AAA", "volume": 10.0, "volume_weighted": 1.1, "open_price": 1.0,
        "close_price": 2.0, "high_price": 3.0, "low_price": 0.5, "number_of_transaction": 7,
        "transaction_date": dt.date(2024, 6, 3)}


def test_volume_is_double_not_nulled(spark):
    rows = _bars(spark, ['{"T":"A","v":10.0}', '{"T":"A","v":1.2e7}', '{"T":"A","v":3000000000}']).collect()
    assert [r.volume for r in rows] == [10.0, 1.2e7, 3000000000.0]


def test_price_not_widened_from_float(spark):
    assert _bars(spark, ['{"T":"A","vw":1.1}']).first().volume_weighted == 1.1


def test_junk_date_is_null_other_fields_kept(spark):
    row = _bars(spark, ['{"T":"A","v":5,"date_time":"junk"}']).first()
    assert row.transaction_date is None and row.ticker == "A" and row.volume == 5.0


def test_bad_document_all_null_and_empty_text_null_struct(spark):
    df = spark.createDataFrame([("{bad",), ("",)], "value string")
    parsed = df.select(F.from_json("value", schemas.BAR_MESSAGE).alias("s")).collect()
    assert parsed[0].s is not None and all(v is None for v in parsed[0].s)
    assert parsed[1].s is None


def test_binary_value_like_kafka(spark):
    df = spark.createDataFrame([(bytearray(b'{"T":"B","n":3}'),)], "value binary")
    row = bars_from_messages(parse_messages(df, schemas.BAR_MESSAGE)).first()
    assert row.ticker == "B" and row.number_of_transaction == 3


def test_encode_then_parse_round_trip(spark):
    df = spark.createDataFrame([(1, "x", 2.5, True)], "a long, b string, c double, d boolean")
    enc = encode_rows(df)
    assert json.loads(enc.first().value) == {"a": 1, "b": "x", "c": 2.5, "d": True}
    back = parse_messages(enc, df.schema)
    assert back.collect() == df.collect()


def test_envelope_without_results_gives_no_rows(spark):
    item = T.StructType([T.StructField("id", T.LongType())])
    pages = spark.createDataFrame(
        [('{"results":[{"id":1},{"id":2}],"next_url":null}', "2024-06-03"),
         ('{"request_id":"x"}', "2024-06-04"),
         ('not json', "2024-06-05")], "value string, d string")
    out = flatten_envelopes(pages, item, stamp=F.to_date("d"), stamp_name="date_time").collect()
    assert [(r.id, r.date_time) for r in out] == [(1, dt.date(2024, 6, 3)), (2, dt.date(2024, 6, 3))]
