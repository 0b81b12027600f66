from pyspark.sql import functions as F

from lograft.config import KafkaTarget, RelationalSource
from lograft.operators import order_by_key, ordering_report
from lograft.plans.jobs import relational_job
from lograft.sources import read_feed, write_feed
from lograft.sources.tables import events_change_feed
from lograft.streaming import start_file_job
from tests.conftest import SF001

SRC = RelationalSource(kind="mysql", pk="id", stringify=True)
TGT = KafkaTarget(per_db_topics=True, partitions=7, delivery_guarantee="at-least-once")
OUT_SCHEMA = "topic string, partition_key string, partition int, pos bigint, op string, value string"


def _feed(spark):
    return events_change_feed(spark.read.parquet(f"{SF001}/events.parquet"))


def test_batch_equals_stream(spark, scratch):
    write_feed(_feed(spark).repartition(4), f"{scratch}/feed")
    batch = relational_job(read_feed(spark, f"{scratch}/feed"), SRC, TGT)
    stream = relational_job(read_feed(spark, f"{scratch}/feed", streaming=True, max_files_per_trigger=1), SRC, TGT)
    q = start_file_job(stream, "t_batch_stream", f"{scratch}/out", f"{scratch}/rej", f"{scratch}/chk",
                       available_now=True)
    q.awaitTermination()
    out = spark.read.schema(OUT_SCHEMA).json(f"{scratch}/out")
    cols = ["topic", "partition_key", "partition", "pos", "op", "value"]
    b = batch.filter("reject_reason IS NULL").select(*cols)
    assert out.count() == b.count() == 1000
    assert out.select(*cols).exceptAll(b).count() == 0 and b.exceptAll(out.select(*cols)).count() == 0


def test_restart_from_checkpoint_no_duplicates(spark, scratch):
    feed = _feed(spark)
    first, second = feed.filter("get_json_object(value, '$.source.pos') < 500"), \
        feed.filter("get_json_object(value, '$.source.pos') >= 500")
    write_feed(first, f"{scratch}/feed/a")
    src = f"{scratch}/feed/*"

    def run(name):
        s = relational_job(read_feed(spark, src, streaming=True), SRC, TGT)
        q = start_file_job(s, name, f"{scratch}/out", f"{scratch}/rej", f"{scratch}/chk", available_now=True)
        q.awaitTermination()

    run("t_restart_1")
    n1 = spark.read.schema(OUT_SCHEMA).json(f"{scratch}/out").count()
    write_feed(second, f"{scratch}/feed/b")
    run("t_restart_2")  # resumes from the checkpoint: only the new files
    out = spark.read.schema(OUT_SCHEMA).json(f"{scratch}/out")
    assert n1 == 500 and out.count() == 1000
    assert out.groupBy("pos").count().filter("count > 1").count() == 0


def test_order_by_key_has_no_inversions(spark):
    routed = relational_job(_feed(spark).repartition(5), SRC, TGT)
    rep = ordering_report(order_by_key(routed, 6))
    agg = rep.agg(F.sum("inversions").alias("inv"), F.max("n_tasks").alias("tasks"), F.sum("n_events").alias("n")).first()
    assert (agg.inv, agg.tasks, agg.n) == (0, 1, 1000)


def test_initial_job_snapshot_then_stream(spark, scratch):
    from lograft.operators import parse_relational
    from lograft.sources import snapshot_events
    from lograft.sources.tables import orders_change_log, orders_snapshots
    from lograft.streaming import start_initial_job

    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    old, _ = orders_snapshots(orders)
    history, tail = orders_change_log(orders)
    write_feed(history, f"{scratch}/feed/history")

    def job(df):
        return parse_relational(df, pk="o_orderkey").withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0))

    def run(name):
        q = start_initial_job(spark, job, snapshot_events(old, "tpch", "orders"),
                              read_feed(spark, f"{scratch}/feed/*"), read_feed(spark, f"{scratch}/feed/*", streaming=True),
                              name, f"{scratch}/out", f"{scratch}/rej", f"{scratch}/chk", available_now=True, fmt="parquet")
        q.awaitTermination()

    run("t_initial_1")
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == old.count()  # snapshot only: the history is before the hand-off
    write_feed(tail, f"{scratch}/feed/tail")
    run("t_initial_2")  # restart: no second snapshot, only the new changes
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == old.count() + tail.count()
    assert out.filter("op = 'r'").count() == old.count()


def test_range_ordering_splits_hot_key(spark):
    from lograft.sources.tables import events_change_feed as feed_of

    feed = feed_of(spark.read.parquet(f"{SF001}/events.parquet"), hot_key=True)
    routed = relational_job(feed.repartition(4), SRC, TGT)
    rep = ordering_report(order_by_key(routed, 40, strategy="range"))
    hot = rep.orderBy(F.desc("n_events")).first()
    assert hot.partition_key.endswith(".events.-1") and hot.n_tasks > 1
    assert rep.agg(F.sum("inversions")).first()[0] == 0
    # Reversing the order inside tasks is caught.
    bad = order_by_key(routed, 40, strategy="range").sortWithinPartitions(F.desc("pos"))
    assert ordering_report(bad).agg(F.sum("inversions")).first()[0] > 0


def test_crash_mid_batch_replays_without_duplicates(spark, scratch):
    """A batch whose output was written but not committed is replayed on
    restart into the same batch folder: no duplicates, nothing lost."""
    import pytest

    from lograft.streaming import ordered_file_writer

    feed = _feed(spark)
    write_feed(feed.repartition(3), f"{scratch}/feed")
    real = ordered_file_writer(f"{scratch}/out", f"{scratch}/rej", fmt="parquet")

    def crashing(batch, batch_id):
        real(batch, batch_id)
        raise RuntimeError("executor lost after writing")

    def query(name, writer):
        s = relational_job(read_feed(spark, f"{scratch}/feed", streaming=True, max_files_per_trigger=1), SRC, TGT)
        return (s.writeStream.queryName(name).option("checkpointLocation", f"{scratch}/chk")
                .foreachBatch(writer).trigger(availableNow=True).start())

    q = query("t_crash_1", crashing)
    with pytest.raises(Exception):
        q.awaitTermination()
    q = query("t_crash_2", real)
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == 1000
    assert out.groupBy("pos").count().filter("count > 1").count() == 0


def test_sink_job_hands_writer_key_ordered_batches(spark, scratch):
    from lograft.streaming import start_sink_job

    write_feed(_feed(spark).repartition(4), f"{scratch}/feed")
    stream = relational_job(read_feed(spark, f"{scratch}/feed", streaming=True, max_files_per_trigger=2), SRC, TGT)

    def writer(ordered, batch_id):
        ordering_report(ordered).write.mode("append").parquet(f"{scratch}/report")

    q = start_sink_job(stream, "t_sink_order", writer, f"{scratch}/chk", reject_path=f"{scratch}/rej",
                       available_now=True, num_partitions=5)
    q.awaitTermination()
    rep = spark.read.parquet(f"{scratch}/report")
    agg = rep.agg(F.sum("n_events").alias("n"), F.sum("inversions").alias("inv"), F.max("n_tasks").alias("t")).first()
    assert (agg.n, agg.inv, agg.t) == (1000, 0, 1)


def test_key_order_reaches_the_files(spark, scratch):
    """The folder column sorts first, so the writer adds no sort of its own."""
    from lograft.operators import written_order_report
    from lograft.sinks import write_batch_files
    from lograft.sources.tables import events_change_feed as feed_of

    feed = feed_of(spark.read.parquet(f"{SF001}/events.parquet"), hot_key=True).repartition(5)
    routed = relational_job(feed, SRC, TGT)
    for strategy in ("range", "hash"):
        write_batch_files(routed, f"{scratch}/{strategy}", f"{scratch}/rej-{strategy}", 0, "parquet", 4, strategy=strategy)
        rep = written_order_report(spark.read.parquet(f"{scratch}/{strategy}"))
        assert rep.agg(F.sum("inversions"), F.sum("n_events")).first() == (0, 1000)
    # Without the folder column in front the order is lost, and the report sees it.
    order_by_key(routed, 4).write.partitionBy("topic").parquet(f"{scratch}/lost/batch_id=0")
    lost = written_order_report(spark.read.parquet(f"{scratch}/lost"))
    assert lost.agg(F.sum("inversions")).first()[0] > 0


def test_events_without_position_are_spread(spark):
    df = spark.range(4000).select(F.lit("d.c.no_pk").alias("partition_key"), F.lit(None).cast("bigint").alias("pos"),
                                  F.col("id").cast("string").alias("value"))
    assert order_by_key(df, 8).select(F.spark_partition_id()).distinct().count() == 8


def test_one_file_stream_is_spread_through_the_job(spark, scratch):
    from lograft.plans import start_job

    write_feed(_feed(spark).coalesce(1), f"{scratch}/feed")
    groups = {"MySQLSrcCDC": {"startupMode": "earliest-offset"},
              "MSKTargetCDC": {"topic": "t", "partitions": "3", "deliveryGuarantee": "at-least-once"}}
    for n in (None, 6):
        q = start_job(spark, "mysql", groups, read_feed(spark, f"{scratch}/feed", streaming=True), f"{scratch}/chk{n}", f"{scratch}/rej{n}",
                      f"{scratch}/out{n}", num_partitions=n, available_now=True)
        q.awaitTermination()
        plan = q._jsq.explainInternal(True) if hasattr(q._jsq, "explainInternal") else ""
        assert spark.read.json(f"{scratch}/out{n}").count() == 1000
        if plan:
            assert ("REPARTITION_BY_NUM" in plan or "repartition" in plan.lower()) == bool(n)


def test_rejects_need_a_place(spark, scratch):
    import pytest

    from lograft.sinks import make_sink, write_batch_files
    from lograft.config import KinesisTarget
    from lograft.streaming import start_sink_job

    stream = relational_job(read_feed(spark, SF001, streaming=True), SRC, TGT)
    for start in (lambda: start_file_job(stream, "t", f"{scratch}/o", None, f"{scratch}/c"),
                  lambda: start_sink_job(stream, "t", lambda df, b: None, f"{scratch}/c", None),
                  lambda: write_batch_files(stream, f"{scratch}/o", "", 0),
                  lambda: make_sink("kds", kinesis=KinesisTarget("s"))):
        with pytest.raises(ValueError, match="reject_path"):
            start()


def test_hand_off_marker_errors_are_not_swallowed(spark, scratch):
    import os

    import pytest

    from lograft.streaming.job import _marker

    assert _marker(spark, f"{scratch}/none") == (False, None)
    os.makedirs(f"{scratch}/marker")
    with open(f"{scratch}/marker/part-0.json.gz", "wb") as f:
        f.write(b"not gzip")
    with pytest.raises(Exception):
        _marker(spark, f"{scratch}/marker")


def test_startup_modes_need_their_inputs(spark, scratch):
    import pytest

    from lograft.plans import start_job

    feed = read_feed(spark, SF001, streaming=True)
    kafka = {"MSKTargetCDC": {"topic": "t", "partitions": "3", "deliveryGuarantee": "at-least-once"}}
    for mode in ("initial", "snapshot"):  # a feed of files needs nothing but its offsets for the hand-off
        with pytest.raises(ValueError, match="snapshot"):
            start_job(spark, "mysql", {"MySQLSrcCDC": {"startupMode": mode}, **kafka}, feed, f"{scratch}/c", f"{scratch}/r", f"{scratch}/o")


def test_batches_are_held_as_one_packed_column(spark, scratch, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from lograft.streaming.job import ordered_file_writer, sink_writer

    held, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: held.append(df.schema) or persist(df, *level))
    rows = [("d", "t", "u", p, "row", f"d.t.{p}" if p % 5 else None, "é{\"a\":1}" if p % 2 else None, None if p % 5 else "key_null", "x", p % 7)
            for p in range(40)] + [("d", "t", "u", None, "row", "d.t.1", "", None, "x", 1)] * 2
    routed = spark.createDataFrame(rows, "db string, table string, op string, pos long, event_kind string, partition_key string, "
                                         "value string, reject_reason string, topic string, partition int")
    ordered_file_writer(f"{scratch}/out", f"{scratch}/rej", "parquet")(routed, 3)
    given = []
    sink_writer(lambda df, batch_id: given.extend(map(tuple, df.select(*routed.columns).collect())), f"{scratch}/sink_rej")(routed, 4)
    assert [s.fieldNames() for s in held] == [["row"], ["row"]] and all(s["row"].dataType == routed.schema for s in held)
    good, bad = ([r for r in rows if (r[7] is None) is ok] for ok in (True, False))

    def read(path):
        return sorted(map(tuple, spark.read.parquet(path).select(*routed.columns).collect()), key=repr)

    assert read(f"{scratch}/out/batch_id=3") == sorted(given, key=repr) == sorted(good, key=repr)
    assert read(f"{scratch}/rej/batch_id=3") == read(f"{scratch}/sink_rej/batch_id=4") == sorted(bad, key=repr)


def test_rejects_of_a_load_cost_no_second_pass(spark, scratch):
    from lograft.plans.jobs import SnapshotTable, snapshot_job
    from lograft.streaming.job import SNAPSHOT_BATCH, ordered_file_writer, sink_writer

    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    ids = [None, *range(1, 100)]
    table = spark.createDataFrame([(k, f"n{k}") for k in ids], "id long, name string").select("id", F.udf(seen, "string")("name").alias("name"))
    load = snapshot_job([SnapshotTable(table, "d", "t")], RelationalSource(kind="mysql", pk="id"), KafkaTarget(topic="x", partitions=7, delivery_guarantee="at-least-once"))
    ordered_file_writer(f"{scratch}/out", f"{scratch}/rej", "parquet")(load, SNAPSHOT_BATCH)
    assert read.value <= len(ids) + 1  # all rows in the pass that writes the good ones, then the reject alone
    out, rej = spark.read.parquet(f"{scratch}/out"), spark.read.parquet(f"{scratch}/rej")
    assert sorted(r.partition_key for r in out.collect()) == sorted(f"d.t.{k}" for k in ids[1:])
    assert [(r.reject_reason, r.partition_key, r.partition, '"name":"nNone"' in r.value) for r in rej.collect()] == [("key_null", None, None, True)]
    assert rej.schema["partition"].dataType.simpleString() == "int" and set(rej.columns) == {*load.columns, "batch_id"}
    sink_writer(lambda df, batch_id: None, f"{scratch}/sink_rej")(load, SNAPSHOT_BATCH)
    assert read.value <= len(ids) + 2 and spark.read.parquet(f"{scratch}/sink_rej").count() == 1
