"""Writers: Parquet tables and lake, JSON lines / Kafka, JDBC."""

from marketflow.sinks.jdbc import append_jdbc, overwrite_jdbc  # noqa: F401
from marketflow.sinks.landed import LandedLog  # noqa: F401
from marketflow.sinks.messages import write_json_lines, write_kafka  # noqa: F401
from marketflow.sinks.parquet import append_lake, overwrite_parquet  # noqa: F401
