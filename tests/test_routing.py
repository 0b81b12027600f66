from pyspark.sql import functions as F

from lograft.config import KafkaTarget
from lograft.operators import kinesis_frame, parse_relational, route, sink_frame
from lograft.sources.tables import events_change_feed
from tests.conftest import SF001, java_hash


def _routed(spark, target):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    return route(parse_relational(events_change_feed(ev), "id", stringify=True), target)


def test_one_key_one_topic_partition(spark):
    t = KafkaTarget(per_db_topics=True, partitions=7, topic_partitions={"cdc-app-db-view": 2})
    r = _routed(spark, t)
    multi = r.groupBy("partition_key").agg(F.countDistinct("topic", "partition").alias("n")).filter("n > 1")
    assert multi.count() == 0
    bounds = r.withColumn("n", F.when(F.col("topic") == "cdc-app-db-view", 2).otherwise(7))
    assert bounds.filter((F.col("partition") < 0) | (F.col("partition") >= F.col("n"))).count() == 0
    for row in r.select("partition_key", "partition", "topic").limit(50).collect():
        n = 2 if row.topic == "cdc-app-db-view" else 7
        # Java: abs(h % n) with a truncating remainder, equal to abs(h) % n.
        assert row.partition == abs(java_hash(row.partition_key)) % n


def test_fixed_topic_and_frames(spark):
    r = _routed(spark, KafkaTarget(topic="one", partitions=3))
    assert {x.topic for x in r.select("topic").distinct().collect()} == {"one"}
    f = sink_frame(r, with_event_id=True)
    assert f.columns == ["topic", "key", "value", "partition", "headers"]
    row = f.first()
    assert isinstance(row.key, (bytes, bytearray)) and row.headers[0].key == "event_id"
    back = f.select(F.decode("key", "UTF-8").alias("k")).first().k
    assert back.startswith("App_DB_")
    k = kinesis_frame(r, "s")
    assert k.columns == ["stream_name", "partition_key", "data"]


def test_kafka_paths_fail_clearly_without_connector(spark):
    import pytest

    from lograft.sinks import write_kafka
    from lograft.sources import read_kafka_feed

    r = _routed(spark, KafkaTarget(topic="t", partitions=2, delivery_guarantee="at-least-once", brokers="b:9092"))
    with pytest.raises(Exception, match="(?i)kafka"):
        write_kafka(sink_frame(r), KafkaTarget(topic="t", partitions=2, brokers="b:9092", delivery_guarantee="at-least-once"))
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_feed(spark, "b:9092", "t", streaming=False)
    # Exactly-once is refused before anything is written.
    with pytest.raises(ValueError, match="exactly-once"):
        write_kafka(sink_frame(r), KafkaTarget(topic="t", partitions=2, brokers="b:9092"))
