"""Row-set operators: de-duplication, counting, typed union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole-row (or key) distinct; nulls compare equal. A two-phase hash
    aggregate: copies are merged map-side before the shuffle, so a key with
    many copies costs one row per map task in the exchange."""
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


def count_rows(df: DataFrame) -> DataFrame:
    """One row ``n_rows``; kept as a frame so no driver round trip is needed."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def union_to_schema(spark: SparkSession, schema: T.StructType, frames: list[DataFrame],
                    by_name: bool = True) -> DataFrame:
    """Fold frames onto an empty frame of ``schema`` and pin the result types.

    Positional ``union`` (``by_name=False``) is what a fold over leaf reads
    without partition columns needs; ``unionByName`` is safer otherwise.
    Narrower numerics widen (int -> double).
    """
    base = spark.createDataFrame([], schema)

    def step(acc: DataFrame, nxt: DataFrame) -> DataFrame:
        if by_name:
            return acc.unionByName(nxt.select(*[F.col(f"`{n}`") for n in schema.fieldNames()]))
        return acc.union(nxt)

    combined = reduce(step, frames, base)
    return combined.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                             for f in schema.fields])
