"""Ticker master: clean, de-duplicate, one version per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.schemas import MASTER_VERSION_COLUMN
from marketflow.operators.rows import dedupe_rows


def clean_master(raw: DataFrame, order: str = "drop_then_dedupe",
                 version_col: str = MASTER_VERSION_COLUMN) -> DataFrame:
    """Remove the version column and duplicate rows.

    ``drop_then_dedupe`` (default) collapses versions that differ only in
    ``version_col``. ``dedupe_then_drop`` is the historical order: it keeps one
    identical row per version, which later multiplies joined bars.
    """
    if order == "dedupe_then_drop":
        return dedupe_rows(raw).drop(version_col)
    if order == "drop_then_dedupe":
        return dedupe_rows(raw.drop(version_col))
    raise ValueError(f"unknown order {order!r}")


def latest_per_ticker(raw: DataFrame, key: str = "ticker",
                      version_col: str = MASTER_VERSION_COLUMN) -> DataFrame:
    """Exactly one row per ticker: the newest version (ties broken by the
    other columns, so the result is deterministic).

    Versions are compared as times (as text, ``...00Z`` would come after
    ``...00.5Z``); one that is no time loses to any that is. Re-sent rows are
    merged by hash first, and a ``max`` of a struct is a partial aggregate, so a
    ticker with very many versions is reduced map-side.
    """
    others = [c for c in raw.columns if c not in (key, version_col)]
    newest = F.struct(F.col(version_col).try_cast("timestamp").alias("_at"), F.col(version_col).alias("_text"),
                      *[F.col(f"`{c}`") for c in others])
    best = raw.dropDuplicates().groupBy(key).agg(F.max(newest).alias("v"))
    return best.select(key, *[F.col(f"v.{c}").alias(c) for c in others])
