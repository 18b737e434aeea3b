"""Date parsing and day arithmetic on columns.

Spark 4 runs with ANSI mode on, where ``to_date`` raises on bad text; every
parse of outside text here uses the ``try_`` forms and yields null instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the data sources.
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_value(value) -> Column:
    """A Python date/datetime/ISO text, or a Column, as a DATE column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value.strip())
    return F.lit(value)


def published_date(text: str | Column) -> Column:
    """``2024-06-03T23:30:00Z`` -> DATE 2024-06-03; the ``Z`` is a literal, so
    there is no zone shift. Fractional seconds or junk -> null."""
    return F.try_to_date(_col(text), ISO_Z_FORMAT)


def day_text(date: str | Column) -> Column:
    """DATE -> ``yyyy-MM-dd`` text."""
    return F.date_format(_col(date), DAY_FORMAT)


def strip_text(text: str | Column) -> Column:
    """Remove leading/trailing whitespace including newlines (``trim`` only
    removes spaces, and the token printed by a job ends with a newline)."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def parse_day(text: str | Column) -> Column:
    """Padded ``yyyy-MM-dd`` text -> DATE, null when it is not a date."""
    return F.try_to_date(strip_text(text), DAY_FORMAT)


def decode_cut_token(token: str | Column) -> Column:
    """Base64 of a ``yyyy-MM-dd`` text (possibly newline-terminated) -> DATE;
    null for a token that is not base64 (``unbase64`` would fail the job)."""
    return parse_day(F.try_to_binary(_col(token), F.lit("base64")).cast("string"))


def encode_cut_token(date: str | Column) -> Column:
    """DATE -> base64 of its ``yyyy-MM-dd`` text followed by a newline, the
    shape a job's printed last line takes when passed to the next job."""
    return F.base64(F.concat(day_text(date), F.lit("\n")).cast("binary"))


def after(col: str | Column, cut) -> Column:
    """Strictly after the cut; null dates fail the test and drop."""
    return _col(col) > as_date_value(cut)


def within_lookback(col: str | Column, cut, days: int) -> Column:
    """``cut - days < col <= cut``: rows a lookback of ``days`` re-reads."""
    c, cut_c = _col(col), as_date_value(cut)
    return (c > F.date_sub(cut_c, days)) & (c <= cut_c)


def within_horizon(ts: str | Column, anchor, days: int) -> Column:
    """``ts > anchor - days`` (strict), the rolling news window."""
    anchor_c = anchor if isinstance(anchor, Column) else F.lit(anchor)
    return _col(ts) > anchor_c - F.make_interval(days=F.lit(days))
