"""Readers: Parquet lake, message streams and texts, JDBC."""

from marketflow.sources.jdbc import read_jdbc_query, read_jdbc_table, read_max_cut  # noqa: F401
from marketflow.sources.messages import (  # noqa: F401
    flatten_envelopes, read_article_texts, read_kafka, read_message_files,
)
from marketflow.sources.parquet import (  # noqa: F401
    latest_partition, newest_month, partition_values_from_path, read_lake, read_parquet, scan_month_range,
)
