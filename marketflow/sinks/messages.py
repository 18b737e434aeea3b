"""Message sinks: rows as JSON objects to files or to a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketflow.functions.json import encode_rows


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Each row as one JSON object per line (a landed topic)."""
    encode_rows(df).write.mode(mode).text(path)


def write_kafka(df: DataFrame, options: dict) -> None:
    """Each row as JSON bytes to a topic (``kafka.bootstrap.servers``, ``topic``)."""
    encode_rows(df, as_binary=True).write.format("kafka").options(**options).save()
