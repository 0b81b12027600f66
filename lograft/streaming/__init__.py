"""Structured Streaming jobs."""

from lograft.streaming.accounting import BatchAccounts, batch_account
from lograft.streaming.keyed import drop_repeats, flag_late
from lograft.streaming.job import (
    checkpoint_root,
    ensure_checkpoint_dir,
    highest_routed,
    ordered_file_writer,
    sink_writer,
    skip_to_end,
    start_after,
    start_chunked_job,
    start_file_job,
    start_initial_job,
    start_sink_job,
)

__all__ = [
    "checkpoint_root",
    "ensure_checkpoint_dir",
    "start_file_job",
    "start_initial_job",
    "start_sink_job",
    "ordered_file_writer",
    "sink_writer",
    "start_after",
    "start_chunked_job",
    "skip_to_end",
    "highest_routed",
    "BatchAccounts",
    "batch_account",
    "flag_late",
    "drop_repeats",
]
