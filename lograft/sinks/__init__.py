"""Sinks: files, Kafka, Kinesis, and the choice between them."""

from lograft.sinks.files import write_batch_files
from lograft.sinks.kafka import kafka_options, write_kafka, check_delivery
from lograft.sinks.kinesis import KinesisPutter, write_kinesis
from lograft.sinks.select import make_sink

__all__ = [
    "write_batch_files",
    "kafka_options",
    "write_kafka",
    "check_delivery",
    "KinesisPutter",
    "write_kinesis",
    "make_sink",
]
