from parcelflow.streaming.queries import (
    AVAILABLE_NOW,
    ProgressLog,
    append_files,
    append_updates,
    every,
    finish,
    inspect,
    latest_result,
    latest_updates,
    observed,
    replace_result,
    skip_present,
    stop_all,
    to_console,
    to_function,
    to_kafka,
    to_memory,
    to_table,
)
from parcelflow.streaming.state import large_state
from parcelflow.streaming.stateful import first_arrivals, running_totals, status_transitions
from parcelflow.streaming.together import run_together

__all__ = [
    "AVAILABLE_NOW",
    "ProgressLog",
    "append_files",
    "append_updates",
    "every",
    "finish",
    "first_arrivals",
    "inspect",
    "large_state",
    "latest_result",
    "latest_updates",
    "observed",
    "replace_result",
    "run_together",
    "running_totals",
    "skip_present",
    "status_transitions",
    "stop_all",
    "to_console",
    "to_function",
    "to_kafka",
    "to_memory",
    "to_table",
]
