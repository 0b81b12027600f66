"""File sink for routed records, idempotent per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lograft.operators.envelope import split_rejects, unheld_rejects
from lograft.operators.order import order_by_key
from lograft.operators.spread import hold_packed


def require_reject_path(reject_path: str | None) -> str:
    """Rejected events have to go somewhere: without a place they would vanish."""
    if not reject_path:
        raise ValueError("reject_path is required: events that cannot be routed are kept there")
    return reject_path


def write_batch_files(
    routed: DataFrame,
    output_path: str,
    reject_path: str,
    batch_id: int | str,
    fmt: str = "json",
    num_partitions: int | None = None,
    partition_by: tuple[str, ...] | None = None,
    strategy: str | None = "range",
) -> None:
    """Write one batch: good rows ordered per key, rejects aside.

    Ordering uses the ``range`` strategy by default, so a hot key is spread
    over several files in position order instead of loading one task. The folder
    columns (``topic``, or ``db`` for records without one) come first in the sort,
    so the writer does not sort again and the order per key reaches the files.
    ``strategy=None`` writes rows as they come, with no exchange: for a snapshot,
    which has each key once.

    Each batch goes to its own ``batch_id=N`` directory in overwrite mode, so
    a batch replayed after a failure replaces its earlier partial output:
    exactly-once together with the stream checkpoint.
    """
    require_reject_path(reject_path)
    folders = partition_by or (("topic",) if "topic" in routed.columns else ("db",))
    held, kept = hold_packed(routed) if strategy else (None, routed)  # a micro-batch, read three times
    try:
        good, bad = split_rejects(kept)
        if held is None:
            bad = unheld_rejects(kept)
        rows = order_by_key(good, num_partitions, strategy=strategy, within=folders) if strategy else good
        rows.write.mode("overwrite").partitionBy(*folders).format(fmt).save(f"{output_path}/batch_id={batch_id}")
        bad.write.mode("overwrite").format(fmt).save(f"{reject_path}/batch_id={batch_id}")
    finally:
        if held is not None:
            held.unpersist()
