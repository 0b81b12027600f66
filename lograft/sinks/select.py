"""Choose the sink named by the source configuration."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame

from lograft.config import SINK_TARGETS, KafkaTarget, KinesisTarget
from lograft.operators.route import kinesis_frame, sink_frame
from lograft.sinks.files import require_reject_path
from lograft.sinks.kafka import check_delivery, write_kafka
from lograft.sinks.kinesis import write_kinesis


def make_sink(
    sink_target: str,
    kafka: KafkaTarget | None = None,
    kinesis: KinesisTarget | None = None,
    kinesis_client_factory: Callable[[], object] | None = None,
    reject_path: str | None = None,
) -> Callable[[DataFrame, int | str], None]:
    """Writer for a batch of routed records and its id: ``msk`` (Kafka) or ``kds``
    (Kinesis).

    An unknown target raises instead of silently attaching no sink. Kinesis
    records that still fail after retries go to ``reject_path`` (Parquet), which
    is required, in a folder per batch: a replayed batch replaces its rejects.
    """
    if sink_target == "msk":
        if kafka is None:
            raise ValueError("sinkTarget 'msk' needs a Kafka target")
        check_delivery(kafka)
        return lambda routed, batch_id: write_kafka(sink_frame(routed, kafka.allow_duplicates), kafka)
    if sink_target == "kds":
        if kinesis is None:
            raise ValueError("sinkTarget 'kds' needs a Kinesis target")

        require_reject_path(reject_path)

        def write(routed: DataFrame, batch_id: int | str) -> None:
            rejects = write_kinesis(kinesis_frame(routed, kinesis.stream_name), kinesis, kinesis_client_factory)
            rejects.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")

        return write
    raise ValueError(f"unknown sinkTarget {sink_target!r}; expected one of {SINK_TARGETS}")
