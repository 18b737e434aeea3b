"""Typed schemas of the messages, the lake and the warehouse tables.

All fields are nullable, as the JSON sources give no guarantees. Two choices
differ on purpose from a naive reading of the message format: bar volume is a
double (an integer field turns ``10.0`` or ``3000000000`` into null) and prices
are parsed as doubles directly (parsing as float and widening later turns 1.1
into 1.100000023841858).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name, dtype in pairs]


S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

# The field names of the market-data API's messages (bar,
# ticker master, news article, page envelope) and the warehouse column names
# below must stay as they are for the data to parse and load.

# Daily bar message as published by the market-data API (short field names),
# with the request date stamped by the producer as ``date_time``.
BAR_MESSAGE = T.StructType(_fields(
    ("T", S), ("v", D), ("vw", D), ("o", D), ("c", D), ("h", D), ("l", D),
    ("n", I), ("date_time", T.DateType()),
))

# Short message names -> typed bar column names.
BAR_RENAMES = {
    "T": "ticker",
    "v": "volume",
    "vw": "volume_weighted",
    "o": "open_price",
    "c": "close_price",
    "h": "high_price",
    "l": "low_price",
    "n": "number_of_transaction",
    "date_time": "transaction_date",
}

# Ticker master message. ``last_updated_utc`` stays text, as sent.
MASTER_MESSAGE = T.StructType(_fields(
    ("ticker", S), ("name", S), ("market", S), ("locale", S),
    ("primary_exchange", S), ("type", S), ("active", B), ("currency_name", S),
    ("cik", S), ("last_updated_utc", S),
))

MASTER_VERSION_COLUMN = "last_updated_utc"

# Master attributes carried onto every enriched bar, in output order.
MASTER_ATTRIBUTES = [
    "name", "market", "locale", "primary_exchange", "type", "active",
    "currency_name", "cik",
]

# The 17 columns of an enriched bar (lake rows without year/month, and the
# warehouse ``market_data`` table).
ENRICHED_BAR = T.StructType(_fields(
    ("name", S), ("market", S), ("locale", S), ("primary_exchange", S),
    ("type", S), ("active", B), ("currency_name", S), ("cik", S),
    ("ticker", S), ("volume", D), ("volume_weighted", D), ("open_price", D),
    ("close_price", D), ("high_price", D), ("low_price", D),
    ("number_of_transaction", I), ("transaction_date", T.DateType()),
))

LAKE_PARTITION_COLUMNS = ["year", "month"]

# A lake with a record of its batches, with its partition columns.
RECORDED_LAKE = T.StructType([*ENRICHED_BAR.fields, *_fields(("year", I), ("month", I), ("batch", S))])

# News article document (one element of the API's ``results`` array).
INSIGHT = T.StructType(_fields(("sentiment", S), ("sentiment_reasoning", S), ("ticker", S)))
PUBLISHER = T.StructType(_fields(
    ("favicon_url", S), ("homepage_url", S), ("logo_url", S), ("name", S),
))
ARTICLE = T.StructType(_fields(
    ("amp_url", S), ("article_url", S), ("author", S), ("description", S),
    ("id", S), ("image_url", S),
    ("insights", T.ArrayType(INSIGHT, True)),
    ("keywords", T.ArrayType(S, True)),
    ("published_utc", S),
    ("publisher", PUBLISHER),
    ("tickers", T.ArrayType(S, True)),
    ("title", S),
))
ARTICLE_ARRAY = T.ArrayType(ARTICLE, True)

# The fields of an article that the flattening uses; the others are not parsed.
ARTICLE_USED = T.StructType(_fields(
    ("title", S), ("author", S), ("published_utc", S),
    ("publisher", T.StructType(_fields(("name", S)))),
    ("insights", T.ArrayType(T.StructType(_fields(("sentiment", S), ("ticker", S))), True)),
))

# Warehouse high-water mark table.
CUT_TABLE = T.StructType([T.StructField("cut_date", T.DateType(), True)])

# Names of the lake's batches that were loaded.
BATCH_TABLE = T.StructType([T.StructField("batch", T.StringType(), True)])


def envelope(result_type: T.DataType) -> T.StructType:
    """REST page envelope ``{results: [...], next_url, request_id}``."""
    return T.StructType(_fields(
        ("results", T.ArrayType(result_type, True)),
        ("next_url", S),
        ("request_id", S),
    ))
