"""DataFrame -> DataFrame transforms; each works on batch and streaming input."""

from lograft.operators.envelope import parse_document, parse_relational, split_rejects, unknown_root_fields
from lograft.operators.filters import include, include_condition
from lograft.operators.route import event_id_header, kinesis_frame, route, sink_frame
from lograft.operators.order import order_by_key, ordering_report, written_order_report
from lograft.operators.diff import changed_ranges, snapshot_diff, snapshot_diff_by_range
from lograft.operators.schema import schema_in_force
from lograft.operators.spread import rebalance

__all__ = [
    "parse_relational",
    "parse_document",
    "split_rejects",
    "unknown_root_fields",
    "include",
    "include_condition",
    "route",
    "sink_frame",
    "kinesis_frame",
    "order_by_key",
    "ordering_report",
    "written_order_report",
    "snapshot_diff",
    "snapshot_diff_by_range",
    "changed_ranges",
    "schema_in_force",
    "event_id_header",
    "rebalance",
]
