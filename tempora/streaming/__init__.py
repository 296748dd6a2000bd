"""Structured Streaming: enrichment, watermarked windows, sinks, lifecycle."""

from tempora.streaming.queries import (
    await_all,
    latest_updates,
    run_to_completion,
    start_console_update,
    start_parquet_append,
    start_update_table,
    stop_all,
)
from tempora.streaming.windows import enrich, flatten_window, to_unified, windowed_measures

__all__ = [
    "await_all",
    "enrich",
    "flatten_window",
    "latest_updates",
    "run_to_completion",
    "start_console_update",
    "start_parquet_append",
    "start_update_table",
    "stop_all",
    "to_unified",
    "windowed_measures",
]
