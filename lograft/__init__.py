"""lograft: change-feed routing on Spark.

Turns database snapshots and change feeds (insert / update / delete envelopes
as JSON text) into keyed, routed records for a message log, using DataFrame
expressions only, so the same transforms run in batch and in Structured
Streaming and can be checked against plain SQL.
"""

from lograft.config import DocumentSource, KafkaTarget, KinesisTarget, RelationalSource
from lograft.operators import (
    include,
    kinesis_frame,
    order_by_key,
    parse_document,
    parse_relational,
    rebalance,
    route,
    sink_frame,
    snapshot_diff,
    split_rejects,
    unknown_root_fields,
)
from lograft.plans.jobs import SnapshotTable, document_job, relational_job, snapshot_job, start_job
from lograft.sources import read_feed, read_kafka_feed, snapshot_events, snapshot_records, startup
from lograft.streaming import start_file_job, start_initial_job, start_sink_job

__version__ = "0.1.0"

__all__ = [
    "DocumentSource", "KafkaTarget", "KinesisTarget", "RelationalSource",
    "include", "kinesis_frame", "order_by_key", "parse_document", "parse_relational", "rebalance",
    "route", "sink_frame", "snapshot_diff", "split_rejects", "unknown_root_fields",
    "document_job", "relational_job", "snapshot_job", "SnapshotTable", "start_job",
    "read_feed", "read_kafka_feed", "snapshot_events", "snapshot_records", "startup",
    "start_file_job", "start_initial_job", "start_sink_job",
]
