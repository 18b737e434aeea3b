"""Structured Streaming runners over the same transforms as batch."""

from marketflow.streaming.runner import (  # noqa: F401
    enrich_stream, master_ingest_stream, run_available_now, run_for, start_console_sink, start_file_sink,
)
from marketflow.streaming.lake import rejected_messages, replay_unmatched, stream_to_lake, unmatched_bars  # noqa: F401
