"""Kinesis sink: Spark ships no Kinesis writer, so each task puts its own
records with an injected client. Failed records are retried, then returned as
rows for a reject table instead of failing the job.
"""

from __future__ import annotations

import time
from collections import deque
from typing import Callable, Iterator

from pyspark.sql import DataFrame

from lograft.config import KinesisTarget

REJECT_SCHEMA = "partition_key string, data binary, error_code string, error_message string"
# Service limits per PutRecords call and per record (key and data bytes).
MAX_RECORDS_PER_CALL = 500
MAX_BYTES_PER_CALL = 5 << 20
MAX_BYTES_PER_RECORD = 1 << 20


def default_client_factory(region: str | None):
    try:
        import boto3  # optional dependency
    except ImportError as exc:  # pragma: no cover - depends on the image
        raise RuntimeError("boto3 is not installed; pass client_factory") from exc
    return boto3.client("kinesis", region_name=region)


class KinesisPutter:
    """Callable for ``mapInPandas``: puts every record of the task, yields rejects.

    A call holds at most one record of a key, and a record that fails stays at the
    head of its key, so a key's records arrive in order whatever is retried.
    After a call with failures the task waits, twice as long each time up to
    ``max_pause`` seconds, so a throttled shard can recover.

    ``client_factory`` is pickled to the executors and called once per task.
    """

    def __init__(self, stream_name: str, client_factory: Callable[[], object], max_retries: int = 3,
                 pause: float = 0.1, max_pause: float = 5.0, sleep: Callable[[float], None] = time.sleep):
        self.stream_name = stream_name
        self.client_factory = client_factory
        self.max_retries = max_retries
        self.pause = pause
        self.max_pause = max_pause
        self.sleep = sleep

    def _put(self, client, records):
        """Put records in order per key; a record is tried ``max_retries`` times again.
        Returns (key, data, error_code, error_message) for records still failing."""
        rejects, queues, wait = [], {}, self.pause
        for key, data in records:
            if len(key.encode()) + len(data) > MAX_BYTES_PER_RECORD:
                rejects.append((key, data, "RecordTooLarge", f"over {MAX_BYTES_PER_RECORD} bytes"))
            else:
                queues.setdefault(key, deque()).append([data, 0])
        while queues:
            heads, size = [], 0
            for key, queue in queues.items():
                size += len(key.encode()) + len(queue[0][0])
                if len(heads) == MAX_RECORDS_PER_CALL or (heads and size > MAX_BYTES_PER_CALL):
                    break
                heads.append(key)
            answer = client.put_records(
                StreamName=self.stream_name,
                Records=[{"Data": queues[k][0][0], "PartitionKey": k} for k in heads],
            )
            results = answer["Records"] if answer.get("FailedRecordCount") else [{}] * len(heads)
            for key, result in zip(heads, results):
                queue = queues.pop(key)  # back at the end: every key gets its turn
                if result.get("ErrorCode") and queue[0][1] < self.max_retries:
                    queue[0][1] += 1
                else:
                    data, _ = queue.popleft()
                    if result.get("ErrorCode"):
                        rejects.append((key, data, result["ErrorCode"], result.get("ErrorMessage")))
                if queue:
                    queues[key] = queue
            if answer.get("FailedRecordCount") and queues:
                self.sleep(wait)
                wait = min(wait * 2, self.max_pause)
            else:
                wait = self.pause
        return rejects

    def __call__(self, batches: Iterator) -> Iterator:
        import pandas as pd

        client = self.client_factory()
        for pdf in batches:
            rows = [(k, bytes(d)) for k, d in zip(pdf["partition_key"].tolist(), pdf["data"].tolist())]
            yield pd.DataFrame(self._put(client, rows), columns=["partition_key", "data", "error_code", "error_message"])


def write_kinesis(
    frame: DataFrame,
    target: KinesisTarget,
    client_factory: Callable[[], object] | None = None,
) -> DataFrame:
    """Lazily put a ``kinesis_frame``; the returned DataFrame of rejects runs
    the puts when an action (e.g. writing the reject table) evaluates it.
    Delivery is at-least-once: a retried task puts its records again."""
    if client_factory is None:
        region = target.region

        def client_factory():
            return default_client_factory(region)

    putter = KinesisPutter(target.stream_name, client_factory, target.max_retries)
    return frame.select("partition_key", "data").mapInPandas(putter, REJECT_SCHEMA)
