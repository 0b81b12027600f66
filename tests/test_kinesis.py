import sys

import pandas as pd
from pyspark import cloudpickle

from lograft.config import KinesisTarget
from lograft.sinks.kinesis import KinesisPutter, write_kinesis


class FakeKinesis:
    """Fails keys containing 'bad' always and keys containing 'flaky' once."""

    def __init__(self):
        self.calls = 0
        self.seen = set()
        self.stored = []

    def put_records(self, StreamName, Records):
        self.calls += 1
        out, failed = [], 0
        for r in Records:
            k = r["PartitionKey"]
            if "bad" in k or ("flaky" in k and k not in self.seen):
                self.seen.add(k)
                out.append({"ErrorCode": "ProvisionedThroughputExceededException", "ErrorMessage": "slow down"})
                failed += 1
            else:
                self.stored.append((StreamName, k, r["Data"]))
                out.append({"SequenceNumber": "1", "ShardId": "s-0"})
        return {"FailedRecordCount": failed, "Records": out}


# Ship this module's fake client to the Python workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_putter_retries_then_rejects():
    fake = FakeKinesis()
    p = KinesisPutter("s", lambda: fake, max_retries=2, sleep=lambda s: None)
    pdf = pd.DataFrame({"partition_key": ["ok1", "flaky1", "bad1"], "data": [b"a", b"b", b"c"]})
    rejects = pd.concat(list(p(iter([pdf]))))
    assert list(rejects.partition_key) == ["bad1"]
    assert rejects.error_code.iloc[0] == "ProvisionedThroughputExceededException"
    assert {k for _, k, _ in fake.stored} == {"ok1", "flaky1"}
    assert fake.calls == 3


def test_putter_batches_500():
    fake = FakeKinesis()
    p = KinesisPutter("s", lambda: fake)
    pdf = pd.DataFrame({"partition_key": [f"k{i}" for i in range(1201)], "data": [b"x"] * 1201})
    assert sum(len(r) for r in p(iter([pdf]))) == 0
    assert fake.calls == 3 and len(fake.stored) == 1201


def test_write_kinesis_returns_rejects(spark):
    df = spark.createDataFrame([("ok", b"1"), ("bad", b"2")], "partition_key string, data binary")
    rejects = write_kinesis(df, KinesisTarget("s", max_retries=1), client_factory=FakeKinesis)
    rows = rejects.collect()
    assert [r.partition_key for r in rows] == ["bad"]


def test_kinesis_stream_job_puts_everything_and_keeps_rejects(spark, scratch):
    from lograft.config import DocumentSource
    from lograft.plans.jobs import document_job
    from lograft.sinks import make_sink
    from lograft.sources import read_feed, write_feed
    from lograft.sources.tables import conversation_change_feed
    from lograft.streaming import start_sink_job
    from tests.conftest import SF001

    write_feed(conversation_change_feed(spark.read.parquet(f"{SF001}/conversations.parquet")), f"{scratch}/feed")
    routed = document_job(read_feed(spark, f"{scratch}/feed", streaming=True), DocumentSource(sink_target="kds"))
    writer = make_sink("kds", kinesis=KinesisTarget("s", max_retries=0), kinesis_client_factory=FailNoPk,
                       reject_path=f"{scratch}/kinesis_rejects")
    q = start_sink_job(routed, "t_kinesis", writer, f"{scratch}/chk", f"{scratch}/rej", available_now=True)
    q.awaitTermination()
    rejects = spark.read.parquet(f"{scratch}/kinesis_rejects")
    n_no_pk = spark.read.text(f"{scratch}/feed").filter("value NOT LIKE '%documentKey%'").count()
    assert rejects.count() == n_no_pk > 0
    assert rejects.filter("partition_key NOT LIKE '%.no_pk'").count() == 0


class FailNoPk(FakeKinesis):
    def put_records(self, StreamName, Records):
        out = [{"ErrorCode": "X", "ErrorMessage": "no"} if r["PartitionKey"].endswith("no_pk") else {"ShardId": "0"}
               for r in Records]
        return {"FailedRecordCount": sum("ErrorCode" in o for o in out), "Records": out}


class CountingKinesis(FakeKinesis):
    """Records everything it stores in a file, since workers run elsewhere."""

    path = None

    def put_records(self, StreamName, Records):
        with open(self.path, "a") as f:
            for r in Records:
                f.write(r["PartitionKey"] + "\n")
        return {"FailedRecordCount": 0, "Records": [{"ShardId": "0"} for _ in Records]}


def test_start_job_from_property_groups(spark, scratch):

    from lograft.plans import start_job
    from lograft.sources import read_feed, write_feed
    from lograft.sources.tables import conversation_change_feed
    from tests.conftest import SF001

    write_feed(conversation_change_feed(spark.read.parquet(f"{SF001}/conversations.parquet")), f"{scratch}/feed")
    groups = {"MongoSrcCDC": {"sinkTarget": "kds", "collections": r"chat\.conversations"},
              "KDSTargetCDC": {"streamName": "cdc", "region": "r"}}
    log = f"{scratch}/puts.txt"

    def factory():
        c = CountingKinesis()
        c.path = log
        return c

    # copyExisting is on by default: what is there is loaded, then streamed from the hand-off on.
    q = start_job(spark, "mongo", groups, read_feed(spark, f"{scratch}/feed", streaming=True), f"{scratch}/chk", f"{scratch}/rej",
                  snapshot=read_feed(spark, f"{scratch}/feed"), feed_now=read_feed(spark, f"{scratch}/feed"),
                  kinesis_client_factory=factory, available_now=True)
    q.awaitTermination()
    keys = open(log).read().split()
    assert len(keys) == spark.read.text(f"{scratch}/feed").count()
    assert all(k.startswith("chat.conversations.") for k in keys)


class Flaky:
    """Fails each record the first time; keeps the order in which records arrive."""

    def __init__(self, fail=lambda k, d: True):
        self.fail, self.tried, self.stored, self.calls = fail, set(), [], []

    def put_records(self, StreamName, Records):
        self.calls.append([(r["PartitionKey"], r["Data"]) for r in Records])
        out = []
        for r in Records:
            item = (r["PartitionKey"], r["Data"])
            if self.fail(*item) and item not in self.tried:
                self.tried.add(item)
                out.append({"ErrorCode": "Throttled", "ErrorMessage": "slow down"})
            else:
                self.stored.append(item)
                out.append({"ShardId": "0"})
        return {"FailedRecordCount": sum("ErrorCode" in o for o in out), "Records": out}


def _run(putter, rows):
    return pd.concat(list(putter(iter([pd.DataFrame(rows, columns=["partition_key", "data"])]))))


def test_key_order_is_kept_across_retries():
    fake = Flaky(lambda k, d: int(d) % 3 == 0)
    rows = [(f"k{i % 4}", str(i).encode()) for i in range(60)]
    assert len(_run(KinesisPutter("s", lambda: fake, sleep=lambda s: None), rows)) == 0
    for k in {k for k, _ in rows}:
        assert [d for key, d in fake.stored if key == k] == [d for key, d in rows if key == k]
    assert all(len({k for k, _ in call}) == len(call) for call in fake.calls)


def test_calls_are_bound_in_bytes():
    from lograft.sinks.kinesis import MAX_BYTES_PER_CALL

    fake = Flaky(lambda k, d: False)
    big = b"x" * 900_000
    rejects = _run(KinesisPutter("s", lambda: fake), [(f"k{i}", big) for i in range(13)] + [("huge", b"y" * (1 << 20))])
    assert [len(c) for c in fake.calls] == [5, 5, 3]
    assert all(sum(len(k) + len(d) for k, d in c) <= MAX_BYTES_PER_CALL for c in fake.calls)
    assert rejects.error_code.tolist() == ["RecordTooLarge"]


def test_pauses_grow_and_start_again():
    waits = []
    fake = Flaky(lambda k, d: k == "bad")
    fake.tried = type("Never", (set,), {"__contains__": lambda self, x: False})()
    rejects = _run(KinesisPutter("s", lambda: fake, max_retries=3, pause=1, max_pause=3, sleep=waits.append), [("bad", b"1"), ("bad", b"2")])
    assert len(rejects) == 2 and waits[:3] == [1, 2, 3]


def test_replayed_batch_replaces_its_rejects(spark, scratch):
    from lograft.sinks import make_sink

    rows = spark.createDataFrame([("bad", "v"), ("ok", "v")], "partition_key string, value string")
    write = make_sink("kds", kinesis=KinesisTarget("s", max_retries=0), kinesis_client_factory=FakeKinesis, reject_path=f"{scratch}/r")
    for _ in range(2):
        write(rows, 5)
    assert spark.read.parquet(f"{scratch}/r").count() == 1
