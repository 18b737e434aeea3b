"""Helpers shared by the operators: white space, written tables, worker state, folds by id."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import scratch_path

WS = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialise(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once under the cluster's shared folder and read it back, in at most ``files`` files.

    This cuts the lineage: what follows reads files every executor can see, so
    a lost executor never makes Spark repeat the work above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state(key, make):
    """The value ``make()`` gave for ``key``, kept between the tasks of a Python worker process.

    A worker keeps one value: another key replaces it, so the caches of one
    operator never lie beside the next one's.
    """
    store = sys.__dict__.setdefault("_llm_worker_state", {})
    if key not in store:
        store.clear()
        store[key] = make()
    return store[key]


def strip_white_space(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WS, "")


def crc32_mod(key: Column, m: int) -> Column:
    """``crc32`` of the key's text, modulo ``m``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % m
