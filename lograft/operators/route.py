"""Topic and partition routing, and the sink record frames."""

from __future__ import annotations

from itertools import chain
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.config import KafkaTarget
from lograft.functions.encoding import to_bytes
from lograft.functions.hashing import key_partition
from lograft.functions.topics import fixed_topic, topic_for_database


def partition_count(topic: Column, default: int, per_topic: Mapping[str, int] | None = None) -> Column:
    """Partition count of each row's topic.

    Counts come from configuration, so they are bounded by it: a literal map
    lookup replaces a join (no shuffle, no broadcast exchange).
    """
    if not per_topic:
        return F.lit(int(default))
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(n))) for k, n in per_topic.items()))
    return F.coalesce(F.try_element_at(m, topic), F.lit(int(default)))


def route(df: DataFrame, target: KafkaTarget, hash_method: str = "reflect") -> DataFrame:
    """Add ``topic`` (fixed or per database) and ``partition`` (key hash)."""
    topic = topic_for_database(F.col("db"), target.topic_prefix) if target.per_db_topics else fixed_topic(target.topic)
    n = partition_count(F.col("topic"), target.partitions, target.topic_partitions)
    return df.withColumn("topic", topic).withColumn(
        "partition", key_partition(F.col("partition_key"), n, hash_method)
    )


def event_id() -> Column:
    """A hash of a routed record's names, key, operation, position and text."""
    return F.sha2(
        F.concat_ws("\u0001", F.col("db"), F.col("table"), F.col("partition_key"),
                    F.coalesce(F.col("op"), F.lit("")), F.coalesce(F.col("pos").cast("string"), F.lit("")),
                    F.col("value")),
        256,
    )


def event_id_header(headers: Column) -> Column:
    """The ``event_id`` of a record that was read with its headers, else NULL."""
    return F.decode(F.get(F.filter(headers, lambda h: h["key"] == "event_id"), F.lit(0))["value"], "UTF-8")


def sink_frame(routed: DataFrame, with_event_id: bool = False) -> DataFrame:
    """Kafka sink columns: ``topic``, ``key``/``value`` as UTF-8 bytes, ``partition``.

    ``with_event_id`` adds a ``headers`` column with a content hash readers can
    use to drop duplicates written by at-least-once delivery.
    """
    cols = [
        F.col("topic"),
        to_bytes(F.col("partition_key")).alias("key"),
        to_bytes(F.col("value")).alias("value"),
        F.col("partition").cast("int").alias("partition"),
    ]
    if with_event_id:
        eid = event_id()
        cols.append(F.array(F.struct(F.lit("event_id").alias("key"), to_bytes(eid).alias("value"))).alias("headers"))
    return routed.select(*cols)


def kinesis_frame(routed: DataFrame, stream_name: str) -> DataFrame:
    """Kinesis record columns: ``stream_name``, ``partition_key`` (string), ``data`` (bytes)."""
    return routed.select(
        F.lit(stream_name).alias("stream_name"),
        F.col("partition_key"),
        to_bytes(F.col("value")).alias("data"),
    )
