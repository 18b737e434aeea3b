"""Scalar column functions: JSON, dates, cut tokens, sentiment scores."""

from marketflow.functions.dates import (  # noqa: F401
    after, as_date_value, day_text, decode_cut_token, encode_cut_token,
    parse_day, published_date, strip_text, within_horizon, within_lookback,
)
from marketflow.functions.json import encode_rows, parse_json, parse_messages, value_text  # noqa: F401
from marketflow.functions.sentiment import sentiment_score  # noqa: F401
