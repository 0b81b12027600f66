"""Sources: snapshots, change feeds (batch or stream), startup modes."""

from lograft.sources.snapshot import image_columns, snapshot_events, snapshot_records, read_jdbc_snapshot, epoch_micros
from lograft.sources.feeds import read_feed, read_kafka_feed, write_feed
from lograft.sources.splits import read_jdbc_splits, split_of, split_points, split_predicates
from lograft.sources.chunked import after_waves, merge_waves, read_in_waves, read_waves
from lograft.sources.startup import after_position, highest_position, kafka_starting_offsets, startup

__all__ = [
    "image_columns",
    "snapshot_events",
    "snapshot_records",
    "read_jdbc_snapshot",
    "epoch_micros",
    "split_points",
    "split_predicates",
    "split_of",
    "read_jdbc_splits",
    "read_in_waves",
    "read_waves",
    "merge_waves",
    "after_waves",
    "read_feed",
    "read_kafka_feed",
    "write_feed",
    "startup",
    "after_position",
    "highest_position",
    "kafka_starting_offsets",
]
