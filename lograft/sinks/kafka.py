"""Kafka sink (needs the spark-sql-kafka package on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lograft.config import KafkaTarget


def check_delivery(target: KafkaTarget) -> None:
    """Spark's Kafka writer is at-least-once. Refuse an exactly-once target
    unless the caller accepts duplicates (records then carry an ``event_id``
    header for readers to drop repeats)."""
    if target.delivery_guarantee == "exactly-once" and not target.allow_duplicates:
        raise ValueError(
            "exactly-once delivery to Kafka is not available from Spark; set "
            "deliveryGuarantee=at-least-once or allowDuplicates=true"
        )


def kafka_options(target: KafkaTarget) -> dict[str, str]:
    """Producer settings, applied to fixed-topic and per-database targets alike."""
    if not target.brokers:
        raise ValueError("Kafka target needs 'kafkaBrokers'")
    return {"kafka.bootstrap.servers": target.brokers, "kafka.acks": target.acks}


def write_kafka(frame: DataFrame, target: KafkaTarget) -> None:
    """Batch write of a ``sink_frame`` (``topic``, ``key``, ``value``,
    ``partition`` and optional ``headers``). Streams call this from
    ``foreachBatch`` after ``order_by_key``."""
    check_delivery(target)
    frame.write.format("kafka").options(**kafka_options(target)).save()
