"""Explicit redistribution of inputs that arrive in few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """Deal the rows evenly over ``tasks`` tasks; None leaves the frame as it is.

    For inputs that cannot be split (a gzip landing file, one large row group)
    ahead of steps that are CPU-heavy per row, such as JSON. A stream is never
    redistributed.
    """
    return df if tasks is None or df.isStreaming else df.repartition(tasks)
