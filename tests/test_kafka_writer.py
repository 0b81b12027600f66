"""Options and columns that reach Kafka's writer (the connector itself is not in this image)."""

import pytest

from lograft.config import KafkaTarget
from lograft.operators import route, sink_frame
from lograft.sinks.kafka import write_kafka


class Recorder:
    """Stands for a frame and its writer: keeps what it is told."""

    def __init__(self, frame):
        self.frame, self.saved, self.said, self.kind = frame, 0, {}, None

    @property
    def write(self):
        return self

    def format(self, kind):
        self.kind = kind
        return self

    def options(self, **options):
        self.said.update(options)
        return self

    def save(self):
        self.saved += 1


@pytest.mark.parametrize("groups,topics", [
    ({"topic": "all"}, {"all"}),
    ({"perDBTopicPrefix": ""}, {"cdc-app-one", "cdc-two"}),
    ({"perDBTopicPrefix": "x-"}, {"x-app-one", "x-two"}),
])
def test_settings_and_columns_in_both_topic_modes(spark, groups, topics):
    target = KafkaTarget.from_properties({"kafkaBrokers": "b1:9092,b2:9092", "deliveryGuarantee": "at-least-once", "partitions": "5", **groups})
    rows = [("App_One", "t", "c", 1, "App_One.t.1", "{}"), ("Two", "t", "d", 2, "Two.t.é", None)]
    routed = route(spark.createDataFrame(rows, "db string, `table` string, op string, pos bigint, partition_key string, value string"), target)
    sent = Recorder(sink_frame(routed, with_event_id=True))
    write_kafka(sent, target)
    assert (sent.kind, sent.saved) == ("kafka", 1)
    assert sent.said == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "kafka.acks": "all"}
    assert [(f.name, f.dataType.simpleString()) for f in sent.frame.schema] == [
        ("topic", "string"), ("key", "binary"), ("value", "binary"), ("partition", "int"), ("headers", "array<struct<key:string,value:binary>>")]
    got = sent.frame.collect()
    assert {r.topic for r in got} == topics and all(0 <= r.partition < 5 for r in got)
    assert {bytes(r.key).decode() for r in got} == {"App_One.t.1", "Two.t.é"}


def test_exactly_once_reaches_no_writer(spark):
    target = KafkaTarget.from_properties({"kafkaBrokers": "b1:9092", "topic": "t", "partitions": "5"})
    sent = Recorder(None)
    with pytest.raises(ValueError, match="exactly-once"):
        write_kafka(sent, target)
    assert sent.saved == 0
