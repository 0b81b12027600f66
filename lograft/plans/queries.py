"""Registered queries and their SQL oracles.

Every query reads the benchmark tables, turns them into change envelopes with
Spark (``lograft.sources.tables``), runs the operator under test over all
rows, and returns typed scalar columns. The matching SQL computes the same
columns straight from the tables, so JSON text never has to agree between
engines, only the values carried through it.
"""

from __future__ import annotations

import functools
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.config import DocumentSource, KafkaTarget, RelationalSource
from lograft.operators.diff import snapshot_diff, snapshot_diff_by_range
from lograft.operators.envelope import parse_document, parse_relational, unknown_root_fields
from lograft.functions.jsonfn import variant_kind
from lograft.operators.order import order_by_key, ordering_report, written_order_report
from lograft.operators.route import event_id_header, kinesis_frame, route, sink_frame
from lograft.operators.schema import schema_in_force
from lograft.operators.spread import rebalance
from lograft.operators.filters import include
from lograft.plans.jobs import SnapshotTable, document_job, relational_job, snapshot_job, start_job
from lograft.sources.feeds import read_feed, write_feed
from lograft.sources.snapshot import snapshot_events, snapshot_records
from lograft.sources.startup import MODES, highest_position, startup
from lograft.sources.tables import (
    ORDERS_DB,
    ORDERS_TABLE,
    RACE_BASE,
    RACE_SPAN,
    TAIL_POSITION_BASE,
    conversation_change_feed,
    events_change_feed,
    events_feed_with_faults,
    events_feed_spelled,
    events_feed_with_changes,
    events_feed_with_more_fields,
    events_schema_feed,
    orders_as_of,
    orders_change_log,
    orders_little_changed,
    orders_race_log,
    orders_snapshots,
)
from lograft.sources.splits import split_of, split_points, split_predicates
from lograft.streaming.accounting import BatchAccounts
from lograft.streaming.keyed import drop_repeats, flag_late
from lograft.streaming.job import (
    configured_checkpoint_dir,
    ensure_checkpoint_dir,
    ordered_file_writer,
    start_chunked_job,
    start_file_job,
    start_initial_job,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed settings of the registered queries.
MYSQL = RelationalSource(kind="mysql", pk="id", stringify=True)
PER_DB = KafkaTarget(per_db_topics=True, per_db_topic_prefix="", partitions=7,
                     delivery_guarantee="at-least-once")
PER_DB_SIZED = KafkaTarget(per_db_topics=True, partitions=7, delivery_guarantee="at-least-once",
                           topic_partitions={"cdc-app-db-signup": 3, "cdc-app-db-purchase": 5})
FIXED = KafkaTarget(topic="cdc-all", partitions=7, delivery_guarantee="at-least-once")
KINESIS_STREAM = "cdc-stream"
TIME_ZONE = "Asia/Shanghai"


def _t(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A test table. The files are single row groups, one reader each, so by default
    rows are spread over the cluster's cores before the per-row JSON work. Plans
    that shuffle on a key right away (joins) pass ``spread=False``: that shuffle
    spreads the work already."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return rebalance(df, _cores(spark)) if spread else df


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder (a temporary one only where none is set)."""
    import tempfile

    root = configured_checkpoint_dir(spark) or ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="lograft-ckpt-"))
    return f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _events_routed(spark, sf_dir, source=MYSQL, target=PER_DB, **kw) -> DataFrame:
    return relational_job(events_change_feed(_t(spark, sf_dir, "events"), **kw), source, target)


# --- sources -----------------------------------------------------------------

def relational_feed(spark, sf_dir):
    r = parse_relational(events_change_feed(_t(spark, sf_dir, "events")), pk="id", stringify=False)
    return r.select("db", "table", "op", "pos", "partition_key")


def document_feed(spark, sf_dir):
    r = parse_document(conversation_change_feed(_t(spark, sf_dir, "conversations")))
    return r.select("db", "table", "partition_key", "pos")


def _orders_snapshot(spark, sf_dir, time_zone=None):
    orders = _t(spark, sf_dir, "orders")
    return snapshot_records(orders, ORDERS_DB, ORDERS_TABLE, "o_orderkey", time_zone=time_zone, position=F.col("o_orderkey"))


def snapshot_full_load(spark, sf_dir):
    r = _orders_snapshot(spark, sf_dir)
    after = F.get_json_object("value", "$.after")
    return r.select(
        "db", "table", "op", "pos", "partition_key",
        F.get_json_object(after, "$.o_totalprice").cast("decimal(14,2)").alias("o_totalprice"),
        F.get_json_object(after, "$.o_orderstatus").alias("o_orderstatus"),
        F.get_json_object(after, "$.o_orderdate").cast("bigint").alias("o_orderdate_us"),
    )


def snapshot_time_zone(spark, sf_dir):
    r = _orders_snapshot(spark, sf_dir, time_zone=TIME_ZONE)
    return r.select(
        "partition_key",
        F.get_json_object("value", "$.after.o_orderdate").cast("bigint").alias("o_orderdate_utc_us"),
    )


def _orders_startup(spark, sf_dir, mode):
    # Only the branches without a join are spread; the diff's join shuffles
    # on the key and spreads its own work.
    orders = _t(spark, sf_dir, "orders", spread=False)
    history, tail = orders_change_log(orders, spread_history=_cores(spark))
    log = history.unionByName(tail)
    snap = snapshot_events(rebalance(orders, _cores(spark)), ORDERS_DB, ORDERS_TABLE)  # a full load
    # The hand-off from the unspread history: a pruned scan of the key column.
    hand_off = highest_position(orders_change_log(orders)[0])
    events = startup(mode, snapshot=snap, changes=log, start_position=hand_off)
    r = parse_relational(events, pk="o_orderkey", stringify=False)
    return r.select("op", "pos", "partition_key")


def startup_initial(spark, sf_dir):
    return _orders_startup(spark, sf_dir, "initial")


def startup_earliest(spark, sf_dir):
    return _orders_startup(spark, sf_dir, "earliest-offset")


def startup_latest(spark, sf_dir):
    return _orders_startup(spark, sf_dir, "latest-offset")


def startup_snapshot(spark, sf_dir):
    return _orders_startup(spark, sf_dir, "snapshot")


def snapshot_diff_query(spark, sf_dir):
    old, new = orders_snapshots(_t(spark, sf_dir, "orders", spread=False))
    d = snapshot_diff(old, new, "o_orderkey", ORDERS_DB, ORDERS_TABLE)
    return d.select(
        "op", "o_orderkey",
        F.get_json_object("value", "$.before.o_orderstatus").alias("before_status"),
        F.get_json_object("value", "$.after.o_orderstatus").alias("after_status"),
    )


def snapshot_diff_by_range_query(spark, sf_dir):
    old, new = orders_little_changed(_t(spark, sf_dir, "orders", spread=False))
    d = snapshot_diff_by_range(old, new, "o_orderkey", ORDERS_DB, ORDERS_TABLE)
    return d.select(
        "op", "o_orderkey",
        F.get_json_object("value", "$.before.o_orderstatus").alias("before_status"),
        F.get_json_object("value", "$.after.o_orderstatus").alias("after_status"),
    )


def schema_version_of_event(spark, sf_dir):
    """Each row event with the schema change of its table that is in force at its position."""
    feed = events_feed_with_changes(_t(spark, sf_dir, "events"))
    r = schema_in_force(parse_relational(feed, pk="id"), span=4096)
    return r.select("partition_key", "pos", "schema_pos", F.get_json_object("schema_value", "$.ddl").alias("ddl"))


def _events_with_schema_changes(spark, sf_dir) -> DataFrame:
    """Feed B plus schema-change events: per event type one DDL on the table
    and one without a table name. The types come from a pruned scan."""
    events = _t(spark, sf_dir, "events")
    types = _t(spark, sf_dir, "events", spread=False).select("event_type").distinct()
    db = F.concat(F.lit("App_DB_"), F.col("event_type"))
    ddl = types.select(F.to_json(F.struct(
        F.struct(db.alias("db"), F.lit("events").alias("table")).alias("source"),
        F.concat(F.lit("ALTER TABLE events ADD COLUMN c_"), F.col("event_type"), F.lit(" INT")).alias("ddl"),
    )).alias("value"))
    db_ddl = types.select(F.to_json(F.struct(
        F.struct(db.alias("db")).alias("source"),
        F.concat(F.lit("CREATE INDEX i_"), F.col("event_type"), F.lit(" ON t(c)")).alias("ddl"),
    )).alias("value"))
    return events_change_feed(events).unionByName(ddl).unionByName(db_ddl)


def schema_events(spark, sf_dir):
    feed = _events_with_schema_changes(spark, sf_dir)
    r = parse_relational(feed, pk="id", stringify=True)
    return r.select("event_kind", "db", "op", "partition_key")


def unknown_root_fields_query(spark, sf_dir):
    feed = _events_with_schema_changes(spark, sf_dir)
    r = unknown_root_fields(parse_relational(feed, pk="id", stringify=False))
    return r.select("event_kind", "partition_key", "n_unknown_fields",
                    F.array_join("unknown_fields", ",").alias("unknown_fields"))


def rejected_events(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    rule = F.col("event_id") % 8
    id_json = F.when(rule == 1, F.lit("null")).when(rule == 2, F.lit('{"scale":0,"value":"AQ=="}')) \
        .otherwise(F.col("user_id").cast("string"))
    image = F.concat(F.lit("{"), F.when(rule == 3, F.lit("")).otherwise(F.concat(F.lit('"id":'), id_json, F.lit(","))),
                     F.lit('"event_id":'), F.col("event_id").cast("string"), F.lit("}"))
    env = F.concat(F.lit('{"before":null,"after":'), image, F.lit(',"source":{"db":"App_DB_'), F.col("event_type"),
                   F.lit('","table":"events","pos":'), F.col("event_id").cast("string"), F.lit('},"op":"c"}'))
    value = F.when(rule == 0, env.substr(F.lit(1), F.length(env) - 1)).otherwise(env)
    r = parse_relational(ev.select(value.alias("value")), pk="id", stringify=True)
    return r.select("db", "op", "partition_key", "reject_reason")


# --- projections, keys, images ------------------------------------------------

def include_lists(spark, sf_dir):
    r = parse_relational(events_change_feed(_t(spark, sf_dir, "events")), pk="id", stringify=False)
    r = include(r, databases="App_DB_signup,App_DB_purchase", tables=r"App_DB_.*\.events")
    return r.select("db", "table", "op", "pos", "partition_key")


BEFORE_SHIFT = 10**6


def key_by_operation(spark, sf_dir):
    """``before`` and ``after`` have different keys, so the key shows which image it is from."""
    feed = events_change_feed(_t(spark, sf_dir, "events"), pk_as_string=True, before_shift=BEFORE_SHIFT)
    return parse_relational(feed, pk="id", stringify=True).select("op", "pos", "partition_key")


def key_spelling(spark, sf_dir):
    """Keys whose spelling matters: numbers with a fraction or exponent are keys as they are written."""
    ev = _t(spark, sf_dir, "events")
    rule = F.col("event_id") % 6
    spelled = F.when(rule == 1, F.lit('"1.50"')).when(rule == 2, F.lit("1.50")).when(rule == 3, F.lit("1e3")) \
        .when(rule == 4, F.lit('"7e1"')).when(rule == 5, F.lit("true")).otherwise(F.col("user_id").cast("string"))
    env = F.concat(F.lit('{"before":null,"after":{"id":'), spelled, F.lit('},"source":{"db":"d","table":"t","pos":'),
                   F.col("event_id").cast("string"), F.lit('},"op":"c"}'))
    r = parse_relational(ev.select(env.alias("value")), pk="id", stringify=False)
    return r.select("pos", "partition_key", "reject_reason")


def include_schemas(spark, sf_dir):
    """The include lists of a source with schemas, on its feed and on its snapshots: of two
    schemas and three tables, one table is loaded."""
    source = RelationalSource(kind="postgres", pk="id", stringify=True, databases="app", schemas="s_view,s_click,s_error",
                              tables=r"s_view\.events,s_click\.ev.*,s_error\.none")
    events = _t(spark, sf_dir, "events")
    routed = relational_job(events_schema_feed(events), source, PER_DB)
    rows = events.select(F.col("user_id").alias("id"), "event_id")
    tables = [SnapshotTable(rows, "app", "events", "s_click"), SnapshotTable(rows, "app", "none", "s_view"),
              SnapshotTable(rows, "app", "events", "s_signup")]
    loaded = snapshot_job(tables, source, PER_DB)
    return routed.unionByName(loaded).select("db", "table", "op", "pos", "partition_key", "topic", F.get_json_object("value", "$.source.schema").alias("schema"))


def envelope_fields(spark, sf_dir):
    """Each root field of the envelope that goes out, with its JSON type and value."""
    r = parse_relational(events_feed_with_more_fields(_t(spark, sf_dir, "events")), pk="id", stringify=True)
    fields = r.select("pos", "value", F.explode(F.json_object_keys("value")).alias("field"))
    typed = F.try_element_at(F.from_json("value", "map<string,variant>"), F.col("field"))
    text = F.try_element_at(F.from_json("value", "map<string,string>"), F.col("field"))
    return fields.select("pos", "field", variant_kind(typed).alias("kind"), text.alias("text"))


def stringified_images(spark, sf_dir):
    r = parse_relational(events_change_feed(_t(spark, sf_dir, "events")), pk="id", stringify=True)
    after = F.get_json_object("value", "$.after")
    before = F.get_json_object("value", "$.before")
    kind = F.schema_of_variant(F.variant_get(F.parse_json("value"), "$.after", "variant"))
    return r.select(
        "pos", "op",
        F.get_json_object(after, "$.value").cast("decimal(12,2)").alias("after_value"),
        F.get_json_object(after, "$.props").alias("after_props"),
        F.get_json_object(before, "$.event_type").alias("before_event_type"),
        F.when(F.col("op") != "d", kind == "STRING").alias("after_is_string"),
    )


def exact_envelope(spark, sf_dir):
    """What goes out of events with numbers, spaces and repeated fields of all spellings: their
    text, byte for byte, but for the images, which are strings of theirs."""
    r = parse_relational(events_feed_spelled(_t(spark, sf_dir, "events")), pk="id", stringify=True)
    return r.select("pos", "op", "partition_key", "value", "reject_reason")


# --- routing and sinks -----------------------------------------------------------

def topic_fixed(spark, sf_dir):
    return _events_routed(spark, sf_dir, target=FIXED).select("pos", "topic", "partition_key")


def topic_per_database(spark, sf_dir):
    return _events_routed(spark, sf_dir, target=PER_DB).select("pos", "topic", "partition_key")


def key_hash_partition(spark, sf_dir):
    ev = _events_routed(spark, sf_dir, target=PER_DB_SIZED).select("topic", "partition_key", "partition")
    li = _t(spark, sf_dir, "lineitem")
    li_routed = route(snapshot_records(li, "tpch", "lineitem", "l_orderkey"), PER_DB_SIZED)
    return ev.unionByName(li_routed.select("topic", "partition_key", "partition"))


def sink_record(spark, sf_dir):
    frame = sink_frame(_events_routed(spark, sf_dir))
    text = F.decode(F.col("value"), "UTF-8")
    return frame.select(
        "topic",
        F.decode(F.col("key"), "UTF-8").alias("key"),
        "partition",
        F.get_json_object(text, "$.op").alias("op"),
        F.get_json_object(text, "$.source.pos").cast("bigint").alias("pos"),
    )


def kinesis_record(spark, sf_dir):
    routed = document_job(conversation_change_feed(_t(spark, sf_dir, "conversations")),
                          DocumentSource(sink_target="kds"))
    frame = kinesis_frame(routed, KINESIS_STREAM)
    doc = F.get_json_object(F.decode(F.col("data"), "UTF-8"), "$.fullDocument")
    return frame.select(
        "stream_name", "partition_key",
        F.get_json_object(doc, "$.conv_id").cast("bigint").alias("conv_id"),
        F.get_json_object(doc, "$.turn").cast("bigint").alias("turn"),
    )


# --- streaming -----------------------------------------------------------------

def stream_routed_files(spark, sf_dir):
    """Feed files -> readStream -> job -> ordered, per-batch idempotent files."""
    run = _folder(spark, "stream_routed_files")
    write_feed(events_change_feed(_t(spark, sf_dir, "events")), f"{run}/feed")
    stream = read_feed(spark, f"{run}/feed", streaming=True)
    routed = relational_job(stream, MYSQL, PER_DB)
    q = start_file_job(routed, f"stream_routed_files_{uuid.uuid4().hex[:8]}", f"{run}/out", f"{run}/rejects",
                       f"{run}/checkpoint", available_now=True, fmt="parquet")
    q.awaitTermination()
    out = spark.read.parquet(f"{run}/out")
    return out.select("topic", "partition_key", "partition", "pos")


def ordered_files(spark, sf_dir):
    """The order in the files that a job writes: a feed in several files with positions
    out of order and a hot key, read back by file name and row."""
    run = _folder(spark, "ordered_files")
    write_feed(events_change_feed(_t(spark, sf_dir, "events"), hot_key=True), f"{run}/feed")
    routed = relational_job(read_feed(spark, f"{run}/feed", streaming=True), MYSQL, PER_DB)
    q = start_file_job(routed, f"ordered_files_{uuid.uuid4().hex[:8]}", f"{run}/out", f"{run}/rejects",
                       f"{run}/checkpoint", available_now=True, fmt="parquet", num_partitions=8)
    q.awaitTermination()
    return written_order_report(spark.read.parquet(f"{run}/out")).select("partition_key", "n_events", "inversions")


def event_accounting(spark, sf_dir):
    """What becomes of every event of a feed with faults, through a snapshot, a
    hand-off and a restart: a row per event that was written or rejected. The first
    half of the feed is there when the job starts, the second when it restarts."""
    run = _folder(spark, "event_accounting")
    events = _t(spark, sf_dir, "events")
    top = F.broadcast(_t(spark, sf_dir, "events", spread=False).agg(F.max("event_id").alias("top")))  # one row
    feed = events_feed_with_faults(events).join(top)
    customers = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("event_id"))
    source = RelationalSource(kind="mysql", pk="id", stringify=True, databases="App_DB_.*")

    def start(part: int):
        write_feed(feed.filter((F.col("event_id") * 2 < F.col("top")) if part == 0 else (F.col("event_id") * 2 >= F.col("top"))),
                   f"{run}/feed/part={part}")
        q = start_initial_job(
            spark, lambda e: relational_job(e, source, PER_DB), snapshot_events(customers, "App_DB_all", "customer"),
            read_feed(spark, f"{run}/feed/*"), read_feed(spark, f"{run}/feed/*", streaming=True),
            f"event_accounting_{part}_{uuid.uuid4().hex[:8]}", f"{run}/out", f"{run}/rejects", f"{run}/checkpoint",
            fmt="parquet", available_now=True)
        q.awaitTermination()

    start(0)
    start(1)
    event_id = F.regexp_extract("value", r'event_id\\?":([0-9]+)', 1).cast("bigint").alias("event_id")
    out = spark.read.parquet(f"{run}/out").select(F.when(F.col("op") == "r", "snapshot").otherwise("output").alias("outcome"), event_id)
    rejects = spark.read.parquet(f"{run}/rejects").select(F.col("reject_reason").alias("outcome"), event_id)
    return out.unionByName(rejects)


def ordered_across_batches(spark, sf_dir):
    """Events that come a batch too late: two thirds of the feed in the first run of a job, the
    rest, with lower and higher positions of the same keys, when it starts again."""
    run = _folder(spark, "ordered_across_batches")
    feed = events_change_feed(_t(spark, sf_dir, "events"))
    first = F.get_json_object("value", "$.source.pos").cast("bigint") % 3 != 1
    for part, some in (("first", first), ("second", ~first)):
        write_feed(feed.filter(some), f"{run}/feed/part={part}")
        routed = flag_late(relational_job(read_feed(spark, f"{run}/feed/*", streaming=True), MYSQL, PER_DB))
        q = start_file_job(routed, f"ordered_across_batches_{part}_{uuid.uuid4().hex[:8]}", f"{run}/out", f"{run}/rejects",
                           f"{run}/checkpoint", available_now=True, fmt="parquet")
        q.awaitTermination()
    return spark.read.parquet(f"{run}/out").select("partition_key", "pos", "late")


def repeats_removed(spark, sf_dir):
    """A log whose writer failed and wrote the last two thirds of its records again, read as a
    stream by their event ids, the repetition after a restart of the reader."""
    run = _folder(spark, "repeats_removed")
    routed = _events_routed(spark, sf_dir)
    records = sink_frame(routed, with_event_id=True).withColumn("_at", F.get_json_object(F.decode("value", "UTF-8"), "$.source.pos").cast("bigint"))
    log = lambda late: F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("_at") + late)
    again = F.col("_at") % 3 != 0
    for part, written in (("first", records.withColumn("timestamp", log(0))), ("again", records.filter(again).withColumn("timestamp", log(60_000)))):
        written.drop("_at").write.parquet(f"{run}/log/part={part}")
        schema = spark.read.parquet(f"{run}/log/part={part}").schema
        stream = spark.readStream.schema(schema).parquet(f"{run}/log/*").withColumn("event_id", event_id_header(F.col("headers")))
        q = (drop_repeats(stream).writeStream.option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True)
             .format("parquet").option("path", f"{run}/out").start())
        q.awaitTermination()
    return spark.read.parquet(f"{run}/out").select("topic", F.decode("key", "UTF-8").alias("partition_key"), "partition",
                                                     F.get_json_object(F.decode("value", "UTF-8"), "$.source.pos").cast("bigint").alias("pos"))


def batch_accounting(spark, sf_dir):
    """The accounts of a job's batches, by a listener: a feed with faults in three parts, each
    the batch of another run."""
    run = _folder(spark, "batch_accounting")
    feed = events_feed_with_faults(_t(spark, sf_dir, "events"))
    source = RelationalSource(kind="mysql", pk="id", stringify=True, databases="App_DB_.*")
    accounts = BatchAccounts(spark, f"{run}/accounts")
    spark.streams.addListener(accounts)
    try:
        for part in range(3):
            write_feed(feed.filter(F.col("event_id") % 3 == part), f"{run}/feed/part={part}")
            routed = relational_job(read_feed(spark, f"{run}/feed/*", streaming=True), source, PER_DB)
            q = start_file_job(routed, f"batch_accounting_{uuid.uuid4().hex[:8]}", f"{run}/out", f"{run}/rejects", f"{run}/checkpoint",
                               available_now=True, fmt="parquet")
            q.awaitTermination()
            accounts.wait_for(q.id, part)
    finally:
        spark.streams.removeListener(accounts)
    return accounts.table().select("batch_id", "n_read", "n_routed", "n_rejected", "n_excluded")


def job_startup_modes(spark, sf_dir):
    """``start_job`` in each startup mode: all orders as the snapshot, their creates in
    the feed when the job starts, an update of each when it restarts."""
    run = _folder(spark, "job_startup_modes")
    orders = _t(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    history = snapshot_events(orders, ORDERS_DB, ORDERS_TABLE, position=key, op="c")
    tail = snapshot_events(orders, ORDERS_DB, ORDERS_TABLE, position=key + TAIL_POSITION_BASE, op="u")
    write_feed(history, f"{run}/log/history")
    write_feed(tail, f"{run}/log/tail")

    def events(mode: str) -> DataFrame:
        groups = {"MySQLSrcCDC": {"db": ORDERS_DB, "tables": r"tpch\.orders", "pk": "o_orderkey", "startupMode": mode, "stringifyData": "false"},
                  "MSKTargetCDC": {"topic": "orders", "partitions": "7", "deliveryGuarantee": "at-least-once"}}
        out = f"{run}/{mode}"
        for seen in ("{history}", "{history,tail}"):  # a glob: what is there at the start, and after
            q = start_job(spark, "mysql", groups, read_feed(spark, f"{run}/log/{seen}", streaming=True), f"{out}/checkpoint",
                          f"{out}/rejects", f"{out}/out", [SnapshotTable(orders, ORDERS_DB, ORDERS_TABLE)],
                          fmt="parquet", available_now=True)
            if q is not None:
                q.awaitTermination()
        return spark.read.parquet(f"{out}/out").select(
            F.lit(mode).alias("mode"), "op", "pos", "partition_key",
            F.when(F.col("op") == "r", F.get_json_object("value", "$.after.o_orderdate")).cast("bigint").alias("snapshot_date_us"))

    return functools.reduce(DataFrame.unionByName, map(events, MODES))


LOAD_RANGES, LOAD_WAVES = 8, 4


def chunked_initial(spark, sf_dir):
    """A load of orders that are created, updated and deleted while it runs, in four waves,
    merged with their log; then the stream, stopped and started again. Each key is loaded
    once, as it was at its wave's end, and each event behind that comes once."""
    run = _folder(spark, "chunked_initial")
    orders = _t(spark, sf_dir, "orders")
    log = orders_race_log(orders)
    early = F.col("pos") <= RACE_BASE + RACE_SPAN
    ends = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    points = [(ends.low + (ends.high - ends.low) * i // LOAD_RANGES,) for i in range(1, LOAD_RANGES)]
    clock = {"now": RACE_BASE}  # the database's log end; it moves while a wave is read

    def read(conditions: list[str]) -> DataFrame:
        clock["now"] += RACE_SPAN // LOAD_WAVES // 2
        rows = orders_as_of(orders, clock["now"]).where(" OR ".join(f"({c})" for c in conditions))
        clock["now"] += RACE_SPAN // LOAD_WAVES // 2
        return rows

    source = RelationalSource(kind="mysql", pk="o_orderkey", databases=ORDERS_DB)
    for part, some in (("early", early), ("late", ~early)):
        write_feed(log.filter(some), f"{run}/feed/part={part}")
        q = start_chunked_job(
            spark, ordered_file_writer(f"{run}/out", f"{run}/rejects", "parquet"), lambda e: relational_job(e, source, FIXED),
            lambda rows: snapshot_records(rows, ORDERS_DB, ORDERS_TABLE, "o_orderkey"), read, ORDERS_DB, ORDERS_TABLE, "o_orderkey", T.LongType(),
            points, LOAD_WAVES, lambda: clock["now"], lambda low, high: read_feed(spark, f"{run}/feed/*"), read_feed(spark, f"{run}/feed/*", streaming=True),
            f"chunked_initial_{part}_{uuid.uuid4().hex[:8]}", f"{run}/checkpoint", route_load=lambda r: route(r, FIXED), at_end=False, quote="`",
            available_now=True)
        q.awaitTermination()
    status = F.coalesce(F.get_json_object("value", "$.after.o_orderstatus"), F.get_json_object("value", "$.before.o_orderstatus"))
    return spark.read.parquet(f"{run}/out").select("op", "pos", "partition_key", status.alias("status"))


SPLITS = 16


def split_ranges(spark, sf_dir):
    """Sixteen ranges of lineitem by keys of several kinds, all skewed and some NULL: rows, rows
    in exactly one range, and whether the largest range has at most twice the median's rows."""
    # The table is read a few times for each kind of key: the columns of the keys are spread once.
    path = f"{_folder(spark, 'split_ranges')}/lineitem"
    columns = _t(spark, sf_dir, "lineitem", spread=False).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    rebalance(columns, _cores(spark)).write.parquet(path)
    li = spark.read.schema(columns.schema).parquet(path)
    last = F.col("l_linenumber") == 7
    square = F.col("l_orderkey") * F.col("l_orderkey")
    name = F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.lit("'"), F.col("l_orderkey").cast("string"))
    kinds = {
        "integer": [F.when(~last, square)],
        "text": [F.when(~last, name)],
        "decimal": [F.when(~last, (square * F.lit(1.25).cast("decimal(3,2)")).cast("decimal(30,2)"))],
        "date": [F.when(~last, F.date_add(F.lit("1970-01-01").cast("date"), F.sqrt("l_orderkey").cast("int")))],
        "composite": [F.when(~last, F.col("l_returnflag")), F.col("l_orderkey"), F.col("l_linenumber")],
    }

    def report(kind: str, key: list) -> DataFrame:
        names = [f"k{i}" for i in range(len(key))]
        keys = li.select(*(c.alias(n) for c, n in zip(key, names)))
        points = split_points(keys, names, SPLITS)
        inside = [F.expr(f"coalesce({p}, false)").cast("int") for p in split_predicates(names, points, quote="`")]
        number = F.coalesce(split_of([F.col(n) for n in names], [f.dataType for f in keys.schema], points), F.lit(len(points) + 1))
        rows = keys.select(number.alias("split"), functools.reduce(Column.__add__, inside).alias("ranges"),
                           F.get(F.array(*inside), number).alias("same"))
        per = rows.groupBy("split").agg(F.count("*").alias("n"), F.sum(((F.col("ranges") == 1) & (F.col("same") == 1)).cast("long")).alias("once"))
        known = F.when(F.col("split") <= len(points), F.col("n"))
        return per.agg(F.lit(kind).alias("kind"), F.sum("n").alias("n_rows"), F.sum("once").alias("n_once"),
                       F.sum(F.when(F.col("split") > len(points), F.col("n"))).alias("n_null"), F.count(known).alias("n_ranges"),
                       (F.max(known) <= F.median(known) * 2).alias("balanced"))

    return functools.reduce(DataFrame.unionByName, (report(kind, key) for kind, key in kinds.items()))


def ordered_per_key(spark, sf_dir):
    routed = _events_routed(spark, sf_dir)
    return ordering_report(order_by_key(routed, 8))


def ordered_hot_key(spark, sf_dir):
    """A third of all events on one key; range ordering splits that key over
    tasks and the order still holds across them."""
    routed = _events_routed(spark, sf_dir, hot_key=True)
    return ordering_report(order_by_key(routed, 8, strategy="range")).select("partition_key", "n_events", "inversions")


# --- registry ------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "relational_feed": relational_feed,
    "document_feed": document_feed,
    "snapshot_full_load": snapshot_full_load,
    "snapshot_time_zone": snapshot_time_zone,
    "startup_initial": startup_initial,
    "startup_earliest": startup_earliest,
    "startup_latest": startup_latest,
    "startup_snapshot": startup_snapshot,
    "snapshot_diff": snapshot_diff_query,
    "schema_events": schema_events,
    "unknown_root_fields": unknown_root_fields_query,
    "rejected_events": rejected_events,
    "include_lists": include_lists,
    "key_by_operation": key_by_operation,
    "stringified_images": stringified_images,
    "topic_fixed": topic_fixed,
    "topic_per_database": topic_per_database,
    "key_hash_partition": key_hash_partition,
    "sink_record": sink_record,
    "kinesis_record": kinesis_record,
    "stream_routed_files": stream_routed_files,
    "key_spelling": key_spelling,
    "exact_envelope": exact_envelope,
    "include_schemas": include_schemas,
    "envelope_fields": envelope_fields,
    "ordered_files": ordered_files,
    "ordered_across_batches": ordered_across_batches,
    "repeats_removed": repeats_removed,
    "batch_accounting": batch_accounting,
    "schema_version_of_event": schema_version_of_event,
    "snapshot_diff_by_range": snapshot_diff_by_range_query,
    "event_accounting": event_accounting,
    "job_startup_modes": job_startup_modes,
    "chunked_initial": chunked_initial,
    "split_ranges": split_ranges,
    "ordered_per_key": ordered_per_key,
    "ordered_hot_key": ordered_hot_key,
}


# --- SQL oracles ----------------------------------------------------------------

_EV_OP = ("CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_id % 10 IN (1, 2) THEN 'u' "
          "WHEN event_id % 10 = 3 THEN 'r' ELSE 'c' END")
_EV_DB = "('App_DB_' || event_type)"
_EV_KEY = "('App_DB_' || event_type || '.events.' || CAST(user_id AS VARCHAR))"
_EV_TOPIC = "('cdc-' || replace(lower('App_DB_' || event_type), '_', '-'))"


def _java_hash_sql(s: str) -> str:
    """Java String.hashCode in DuckDB (characters below U+10000)."""
    u = (f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), "
         f"lambda c: unicode(c)::BIGINT)), lambda a, b: (a * 31 + b) % 4294967296)")
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def _partition_sql(key: str, n: str) -> str:
    return f"CAST(abs({_java_hash_sql(key)} % ({n})) AS INTEGER)"


_ORDERS_OLD = "(SELECT * FROM orders WHERE o_orderkey % 7 <> 0)"
_ORDERS_NEW = ("(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus "
               "FROM orders WHERE o_orderkey % 5 <> 0)")
_ORDERS_DIFF = f"""(
  SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
         CASE WHEN o.o_orderkey IS NULL THEN 'c' WHEN n.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op,
         o.o_orderstatus AS before_status, n.o_orderstatus AS after_status
  FROM {_ORDERS_OLD} o FULL OUTER JOIN {_ORDERS_NEW} n ON o.o_orderkey = n.o_orderkey
  WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus)"""
_DIFF_EVENTS = (f"SELECT op, {TAIL_POSITION_BASE} + o_orderkey AS pos, 'tpch.orders.' || CAST(o_orderkey AS VARCHAR) "
                f"AS partition_key FROM {_ORDERS_DIFF}")
_SNAPSHOT_EVENTS = ("SELECT 'r' AS op, CAST(NULL AS BIGINT) AS pos, 'tpch.orders.' || CAST(o_orderkey AS VARCHAR) "
                    "AS partition_key FROM orders")
_HISTORY_EVENTS = ("SELECT 'c' AS op, o_orderkey AS pos, 'tpch.orders.' || CAST(o_orderkey AS VARCHAR) "
                   f"AS partition_key FROM {_ORDERS_OLD}")

_RELATIONAL_ROWS = (f"SELECT {_EV_DB} AS db, 'events' AS \"table\", {_EV_OP} AS op, event_id AS pos, "
                    f"{_EV_KEY} AS partition_key FROM events")

_CONV_KEY = ("'chat.conversations.' || CASE conv_id % 4 WHEN 0 THEN CAST(conv_id AS VARCHAR) "
             "WHEN 1 THEN '\"c' || CAST(conv_id AS VARCHAR) || '\"' "
             "WHEN 2 THEN '{\"$oid\":\"' || lower(lpad(hex(conv_id), 24, '0')) || '\"}' ELSE 'no_pk' END")

_SIZED_N = "CASE {t} WHEN 'cdc-app-db-signup' THEN 3 WHEN 'cdc-app-db-purchase' THEN 5 ELSE 7 END"

ORACLE_SQL: dict[str, str] = {
    "relational_feed": _RELATIONAL_ROWS,
    "document_feed": (f"SELECT 'chat' AS db, 'conversations' AS \"table\", {_CONV_KEY} AS partition_key, "
                      "conv_id * 100000 + turn AS pos FROM conversations"),
    "snapshot_full_load": (
        "SELECT 'tpch' AS db, 'orders' AS \"table\", 'r' AS op, o_orderkey AS pos, "
        "'tpch.orders.' || CAST(o_orderkey AS VARCHAR) AS partition_key, "
        "CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, o_orderstatus, "
        "epoch_us(o_orderdate) AS o_orderdate_us FROM orders"),
    "snapshot_time_zone": (
        "SELECT 'tpch.orders.' || CAST(o_orderkey AS VARCHAR) AS partition_key, "
        f"epoch_us(o_orderdate AT TIME ZONE '{TIME_ZONE}') AS o_orderdate_utc_us FROM orders"),
    "startup_initial": f"{_SNAPSHOT_EVENTS} UNION ALL {_DIFF_EVENTS}",
    "startup_earliest": f"{_HISTORY_EVENTS} UNION ALL {_DIFF_EVENTS}",
    "startup_latest": _DIFF_EVENTS,
    "startup_snapshot": _SNAPSHOT_EVENTS,
    "snapshot_diff": f"SELECT op, o_orderkey, before_status, after_status FROM {_ORDERS_DIFF}",
    "schema_events": (
        f"SELECT 'row' AS event_kind, {_EV_DB} AS db, {_EV_OP} AS op, {_EV_KEY} AS partition_key FROM events "
        f"UNION ALL SELECT 'schema', {_EV_DB}, CAST(NULL AS VARCHAR), {_EV_DB} || '.events.no_pk' "
        "FROM (SELECT DISTINCT event_type FROM events) "
        f"UNION ALL SELECT 'schema', {_EV_DB}, CAST(NULL AS VARCHAR), {_EV_DB} || '.no_table.no_pk' "
        "FROM (SELECT DISTINCT event_type FROM events)"),
    "unknown_root_fields": (
        f"SELECT 'row' AS event_kind, {_EV_KEY} AS partition_key, 0 AS n_unknown_fields, '' AS unknown_fields "
        "FROM events "
        f"UNION ALL SELECT 'schema', {_EV_DB} || '.events.no_pk', 1, 'ddl' FROM (SELECT DISTINCT event_type FROM events) "
        f"UNION ALL SELECT 'schema', {_EV_DB} || '.no_table.no_pk', 1, 'ddl' "
        "FROM (SELECT DISTINCT event_type FROM events)"),
    "rejected_events": (
        f"SELECT CASE WHEN event_id % 8 <> 0 THEN {_EV_DB} END AS db, "
        "CASE WHEN event_id % 8 <> 0 THEN 'c' END AS op, "
        f"CASE WHEN event_id % 8 >= 4 THEN {_EV_KEY} END AS partition_key, "
        "CASE event_id % 8 WHEN 0 THEN 'not_json' WHEN 1 THEN 'key_null' WHEN 2 THEN 'key_not_scalar' "
        "WHEN 3 THEN 'key_missing' END AS reject_reason FROM events"),
    "include_lists": f"{_RELATIONAL_ROWS} WHERE event_type IN ('signup', 'purchase')",
    "key_by_operation": (
        f"SELECT {_EV_OP} AS op, event_id AS pos, {_EV_DB} || '.events.' || CAST(user_id + "
        f"CASE WHEN event_id % 10 = 0 THEN {BEFORE_SHIFT} ELSE 0 END AS VARCHAR) AS partition_key FROM events"),
    "key_spelling": (
        "SELECT event_id AS pos, CASE event_id % 6 WHEN 0 THEN 'd.t.' || CAST(user_id AS VARCHAR) WHEN 1 THEN 'd.t.1.50' WHEN 2 THEN 'd.t.1.50' "
        "WHEN 3 THEN 'd.t.1e3' WHEN 4 THEN 'd.t.7e1' WHEN 5 THEN 'd.t.true' END AS partition_key, "
        "CAST(NULL AS VARCHAR) AS reject_reason FROM events"),
    "exact_envelope": (
        "WITH e AS (SELECT *, CAST(event_id AS VARCHAR) AS i, " f"{_EV_OP} AS op, event_id % 7 AS rule, "
        "CASE event_id % 7 WHEN 0 THEN '1.50' WHEN 1 THEN '1e3' WHEN 2 THEN '1E400' WHEN 3 THEN '-0' WHEN 4 THEN repeat('1234567890', 5) "
        "WHEN 5 THEN '\"' || props || '\"' ELSE 'null' END AS n FROM (SELECT * REPLACE (replace(replace(props, '\\', '\\\\'), '\"', '\\\"') AS props) FROM events)), "
        "k AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN CAST(user_id AS VARCHAR) || '.50' ELSE CAST(user_id AS VARCHAR) END AS k FROM e), "
        "m AS (SELECT *, '{\"id\":' || k || ',\"v\": ' || n || ' ,\"l\":[' || n || ',{\"w\":[]}]}' AS image FROM k), "
        "q AS (SELECT *, '\"' || replace(replace(image, '\\', '\\\\'), '\"', '\\\"') || '\"' AS quoted FROM m) "
        "SELECT event_id AS pos, op, 'd.t.' || k AS partition_key, CAST(NULL AS VARCHAR) AS reject_reason, "
        "'{ \"x\":' || n || ', \"before\" : ' || CASE WHEN op IN ('u', 'd') THEN quoted ELSE 'null' END || ',\"x\":\"two\",\"after\":' || "
        "CASE WHEN op <> 'd' THEN quoted ELSE 'null' END || ' ,\"source\":{\"db\":\"d\", \"table\":\"t\",\"pos\":' || i || '},\"op\":\"' || op || '\"} ' AS value FROM q"),
    "include_schemas": (
        "WITH e AS (SELECT 'app' AS db, 'events' AS \"table\", event_id AS pos, 'app.events.' || CAST(user_id AS VARCHAR) AS partition_key, "
        "'cdc-app' AS topic, event_type FROM events) "
        "SELECT db, \"table\", 'c' AS op, pos, partition_key, topic, 's_' || event_type AS schema FROM e WHERE event_type IN ('view', 'click') "
        "UNION ALL SELECT db, \"table\", 'r', CAST(NULL AS BIGINT), partition_key, topic, 's_click' FROM e"),
    "envelope_fields": (
        "WITH e AS (SELECT *, event_id AS pos, CAST(event_id AS VARCHAR) AS i, '{\"id\":' || CAST(user_id AS VARCHAR) || '}' AS image, "
        f"{_EV_OP} AS op FROM events) "
        "SELECT pos, 'zone' AS field, 'string' AS kind, 'z' || i AS text FROM e "
        "UNION ALL SELECT pos, 'before', CASE WHEN op IN ('u', 'd') THEN 'string' ELSE 'null' END, CASE WHEN op IN ('u', 'd') THEN image END FROM e "
        "UNION ALL SELECT pos, 'after', CASE WHEN op <> 'd' THEN 'string' ELSE 'null' END, CASE WHEN op <> 'd' THEN image END FROM e "
        "UNION ALL SELECT pos, 'source', 'object', '{\"db\":\"app\",\"table\":\"events\",\"pos\":' || i || '}' FROM e "
        "UNION ALL SELECT pos, 'op', 'string', op FROM e "
        "UNION ALL SELECT pos, 'ts_ms', 'number', i || '0' FROM e WHERE event_id % 3 <> 0 "
        "UNION ALL SELECT pos, 'transaction', 'string', 'tx' || i FROM e "
        "UNION ALL SELECT pos, 'tag', 'object', '{\"b\":[' || i || ',null]}' FROM e "
        "UNION ALL SELECT pos, 'flag', 'boolean', 'true' FROM e"),
    "ordered_files": (
        "SELECT 'App_DB_' || event_type || '.events.' || CAST(CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END "
        "AS VARCHAR) AS partition_key, count(*) AS n_events, CAST(0 AS BIGINT) AS inversions FROM events GROUP BY 1"),
    "event_accounting": (
        "WITH e AS (SELECT event_id, event_id % 12 AS rule, event_id * 2 < (SELECT max(event_id) FROM events) AS early FROM events) "
        "SELECT 'snapshot' AS outcome, c_custkey AS event_id FROM customer "
        "UNION ALL SELECT CASE rule WHEN 0 THEN 'not_json' WHEN 3 THEN 'position_invalid' ELSE 'output' END, event_id FROM e "
        "WHERE rule < 4 OR (rule > 4 AND NOT early)"),
    "ordered_across_batches": (
        f"SELECT {_EV_KEY} AS partition_key, event_id AS pos, event_id % 3 = 1 AND event_id < coalesce("
        "max(event_id) FILTER (event_id % 3 <> 1) OVER (PARTITION BY event_type, user_id), event_id) AS late FROM events"),
    "repeats_removed": (
        f"SELECT {_EV_TOPIC} AS topic, {_EV_KEY} AS partition_key, {_partition_sql(_EV_KEY, '7')} AS partition, "
        "event_id AS pos FROM events"),
    "batch_accounting": (
        "SELECT event_id % 3 AS batch_id, count(*) AS n_read, count(*) FILTER (event_id % 12 NOT IN (0, 3, 4)) AS n_routed, "
        "count(*) FILTER (event_id % 12 IN (0, 3)) AS n_rejected, count(*) FILTER (event_id % 12 = 4) AS n_excluded FROM events GROUP BY 1"),
    "schema_version_of_event": (
        "WITH e AS (SELECT *, max(event_id) FILTER (event_id % 40 = 0) OVER (PARTITION BY event_type ORDER BY event_id) AS s FROM events) "
        f"SELECT {_EV_KEY} AS partition_key, event_id AS pos, s AS schema_pos, 'ALTER TABLE events ADD COLUMN c_' || s AS ddl FROM e"),
    "snapshot_diff_by_range": (
        "WITH o AS (SELECT * FROM orders WHERE o_orderkey % 211 <> 0), n AS (SELECT o_orderkey, "
        "CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 193 <> 0) "
        "SELECT CASE WHEN o.o_orderkey IS NULL THEN 'c' WHEN n.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op, "
        "coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderstatus AS before_status, n.o_orderstatus AS after_status "
        "FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey "
        "WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus <> n.o_orderstatus"),
    "job_startup_modes": (
        "WITH s AS (SELECT 'r' AS op, CAST(NULL AS BIGINT) AS pos, o_orderkey AS k, "
        f"epoch_us(o_orderdate AT TIME ZONE '{TIME_ZONE}') AS snapshot_date_us FROM orders), "
        "h AS (SELECT 'c', o_orderkey, o_orderkey, CAST(NULL AS BIGINT) FROM orders), "
        f"t AS (SELECT 'u', {TAIL_POSITION_BASE} + o_orderkey, o_orderkey, CAST(NULL AS BIGINT) FROM orders), "
        "m AS (SELECT 'initial' AS mode, * FROM (FROM s UNION ALL FROM t) UNION ALL "
        "SELECT 'earliest-offset', * FROM (FROM h UNION ALL FROM t) UNION ALL SELECT 'latest-offset', * FROM t "
        "UNION ALL SELECT 'snapshot', * FROM s) "
        "SELECT mode, op, pos, 'tpch.orders.' || CAST(k AS VARCHAR) AS partition_key, snapshot_date_us FROM m"),
    "chunked_initial": (
        f"WITH o AS (SELECT *, {RACE_BASE} + o_orderkey * 7919 % {RACE_SPAN} AS spot, (SELECT min(o_orderkey) FROM orders) AS low, "
        "(SELECT max(o_orderkey) FROM orders) AS top FROM orders), "
        f"p AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN spot ELSE o_orderkey END AS c, CASE WHEN o_orderkey % 3 = 0 THEN spot + {RACE_SPAN // 8} END AS u, "
        f"CASE WHEN o_orderkey % 5 = 0 THEN spot + {RACE_SPAN // 4} END AS d, "
        + " + ".join(f"(o_orderkey >= low + (top - low) * {i} // {LOAD_RANGES})::INT" for i in range(1, LOAD_RANGES)) + " AS split FROM o), "
        f"w AS (SELECT *, {RACE_BASE} + (split // {LOAD_RANGES // LOAD_WAVES} + 1) * {RACE_SPAN // LOAD_WAVES} AS high, "
        "'tpch.orders.' || CAST(o_orderkey AS VARCHAR) AS partition_key FROM p) "
        "SELECT 'r' AS op, high AS pos, partition_key, CASE WHEN u <= high THEN 'X' ELSE o_orderstatus END AS status FROM w "
        "WHERE c <= high AND (d IS NULL OR d > high) "
        "UNION ALL SELECT 'c', c, partition_key, o_orderstatus FROM w WHERE c > high UNION ALL SELECT 'u', u, partition_key, 'X' FROM w WHERE u > high "
        "UNION ALL SELECT 'd', d, partition_key, CASE WHEN u IS NULL THEN o_orderstatus ELSE 'X' END FROM w WHERE d > high"),
    "split_ranges": (
        "SELECT kind, count(*) AS n_rows, count(*) AS n_once, count(*) FILTER (l_linenumber = 7) AS n_null, "
        f"CAST({SPLITS} AS BIGINT) AS n_ranges, true AS balanced "
        "FROM lineitem, (SELECT unnest(['integer', 'text', 'decimal', 'date', 'composite']) AS kind) GROUP BY kind"),
    "stringified_images": (
        f"SELECT event_id AS pos, {_EV_OP} AS op, "
        "CASE WHEN event_id % 10 <> 0 THEN CAST(value AS DECIMAL(12,2)) END AS after_value, "
        "CASE WHEN event_id % 10 <> 0 THEN props END AS after_props, "
        "CASE WHEN event_id % 10 IN (0, 1, 2) THEN event_type END AS before_event_type, "
        "CASE WHEN event_id % 10 <> 0 THEN true END AS after_is_string FROM events"),
    "topic_fixed": f"SELECT event_id AS pos, 'cdc-all' AS topic, {_EV_KEY} AS partition_key FROM events",
    "topic_per_database": f"SELECT event_id AS pos, {_EV_TOPIC} AS topic, {_EV_KEY} AS partition_key FROM events",
    "key_hash_partition": (
        f"SELECT topic, partition_key, {_partition_sql('partition_key', _SIZED_N.format(t='topic'))} AS partition "
        f"FROM (SELECT {_EV_TOPIC} AS topic, {_EV_KEY} AS partition_key FROM events UNION ALL "
        "SELECT 'cdc-tpch', 'tpch.lineitem.' || CAST(l_orderkey AS VARCHAR) FROM lineitem)"),
    "sink_record": (
        f"SELECT {_EV_TOPIC} AS topic, {_EV_KEY} AS key, {_partition_sql(_EV_KEY, '7')} AS partition, "
        f"{_EV_OP} AS op, event_id AS pos FROM events"),
    "kinesis_record": (
        f"SELECT '{KINESIS_STREAM}' AS stream_name, {_CONV_KEY} AS partition_key, conv_id, turn FROM conversations"),
    "stream_routed_files": (
        f"SELECT {_EV_TOPIC} AS topic, {_EV_KEY} AS partition_key, {_partition_sql(_EV_KEY, '7')} AS partition, "
        "event_id AS pos FROM events"),
    "ordered_hot_key": (
        "SELECT 'App_DB_' || event_type || '.events.' || CAST(CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END "
        "AS VARCHAR) AS partition_key, count(*) AS n_events, CAST(0 AS BIGINT) AS inversions FROM events GROUP BY 1"),
    "ordered_per_key": (
        f"SELECT {_EV_KEY} AS partition_key, count(*) AS n_events, CAST(0 AS BIGINT) AS inversions, "
        "CAST(1 AS BIGINT) AS n_tasks FROM events GROUP BY 1"),
}
