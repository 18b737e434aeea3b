"""Sentiment label -> numeric score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentiment labels of the news API and their scores.
SENTIMENT_SCORES = {"positive": 1, "neutral": 0, "negative": -1}


def sentiment_score(label: str | Column) -> Column:
    """positive/neutral/negative -> 1/0/-1 (case-insensitive); else null."""
    c = F.lower(F.col(label) if isinstance(label, str) else label)
    out = F.lit(None).cast("int")
    for name, score in SENTIMENT_SCORES.items():
        out = F.when(c == name, F.lit(score)).otherwise(out)
    return out
