import pytest
from pyspark.sql import functions as F

from lograft.config import DocumentSource, KafkaTarget, KinesisTarget, RelationalSource
from lograft.operators import include
from lograft.plans.jobs import jobs_from_properties
from lograft.sinks import check_delivery, make_sink


def test_relational_defaults():
    m = RelationalSource.from_properties("mysql", {"db": "app"})
    assert (m.pk, m.stringify, m.startup_mode, m.time_zone) == ("id", True, "initial", "Asia/Shanghai")
    o = RelationalSource.from_properties("oracle", {})
    assert (o.pk, o.stringify) == ("ID", False)
    p = RelationalSource.from_properties("postgres", {"stringifyData": "false"})
    assert p.stringify is True
    with pytest.raises(ValueError):
        RelationalSource.from_properties("oracle", {"startupMode": "snapshot"})
    with pytest.raises(ValueError):
        RelationalSource.from_properties("mysql", {"startupMode": "newest"})


def test_secrets_masked():
    m = RelationalSource.from_properties("mysql", {"dbPwd": "hunter2"})
    assert "hunter2" not in repr(m)
    d = DocumentSource.from_properties({"password": "pw1"})
    assert "pw1" not in repr(d)


def test_kafka_target_modes():
    fixed = KafkaTarget.from_properties({"kafkaBrokers": "b:9092", "topic": "t", "partitions": "6"})
    assert not fixed.per_db_topics and fixed.delivery_guarantee == "exactly-once"
    per_db = KafkaTarget.from_properties({"perDBTopicPrefix": "", "partitions": "6", "deliveryGuarantee": "at-least-once"})
    assert per_db.per_db_topics and per_db.topic_prefix == "cdc-"
    sized = KafkaTarget.from_properties({"topic": "t", "partitions": "4", "topicPartitions": "a:2, b:3"})
    assert sized.partitions == 4 and dict(sized.topic_partitions) == {"a": 2, "b": 3}
    with pytest.raises(ValueError):
        check_delivery(fixed)
    check_delivery(per_db)
    check_delivery(KafkaTarget(topic="t", partitions=1, allow_duplicates=True))


def test_sink_choice():
    with pytest.raises(ValueError):
        DocumentSource.from_properties({"sinkTarget": "s3"})
    with pytest.raises(ValueError):
        make_sink("s3")
    assert callable(make_sink("kds", kinesis=KinesisTarget("s"), reject_path="r"))
    src, tgt = jobs_from_properties("mongo", {"MongoSrcCDC": {"sinkTarget": "kds"},
                                               "KDSTargetCDC": {"streamName": "s", "region": "r"}})
    assert isinstance(tgt, KinesisTarget) and src.startup_mode == "initial"


def test_include_lists(spark):
    df = spark.createDataFrame(
        [("app", "orders"), ("app", "users"), ("app2", "orders"), ("x", "y"), ("app", None), ("x", None), (None, None)],
        "db string, table string")
    got = include(df, databases="app", tables=r"app\.ord.*")
    # A name that is not there excludes nothing; an excluded database does, rejects too.
    assert [(r.db, r.table) for r in got.collect()] == [("app", "orders"), ("app", None), (None, None)]
    # Entries are split on ',' without trimming.
    assert include(df, databases="app, app2", keep_unknown=False).count() == 3
    assert include(df, databases="app,app2", keep_unknown=False).count() == 4
    assert include(df).count() == 7


@pytest.mark.parametrize("kind", ["postgres", "oracle"])
def test_schema_lists(spark, kind):
    """``schema.table`` entries match the schema, not the database."""
    from lograft.plans.jobs import relational_job

    def env(db, schema, table, key="id"):
        return ('{"before":null,"after":{"%s":1},"source":{"db":"%s","schema":"%s","table":"%s"},"op":"c"}' % (key, db, schema, table),)

    rows = [env("app", "public", "orders"), env("app", "public", "users"), env("app", "audit", "orders"), env("other", "public", "orders"),
            env("other", "public", "orders", "no_key"), env("app", "public", "orders", "no_key"), ("{bad",)]
    src = RelationalSource(kind=kind, databases="app", schemas="public", tables=r"public\.orders")
    tgt = KafkaTarget(topic="t", partitions=2, delivery_guarantee="at-least-once")
    out = relational_job(spark.createDataFrame(rows, "value string"), src, tgt).collect()
    assert [(r.db, r.table, r.reject_reason) for r in out] == [
        ("app", "orders", None), ("app", "orders", "key_missing"), (None, None, "not_json")]


@pytest.mark.parametrize("kind", ["postgres", "oracle"])
def test_schema_lists_hold_for_snapshots(spark, kind):
    """A table that a feed's lists leave out is not loaded either, and not read."""
    from lograft.plans.jobs import SnapshotTable, snapshot_job

    tgt = KafkaTarget(topic="t", partitions=2, delivery_guarantee="at-least-once")
    rows = spark.createDataFrame([(1, "x")], "id int, schema string")  # a column named like what is matched
    unread = rows.withColumn("boom", F.raise_error(F.lit("read")).cast("string"))
    src = RelationalSource(kind=kind, databases="app", schemas="public", tables=r"public\.orders")
    tables = [SnapshotTable(rows, "app", "orders", "public"), SnapshotTable(unread, "app", "secrets", "public"),
              SnapshotTable(unread, "app", "orders", "audit"), SnapshotTable(unread, "other", "orders", "public")]
    out = snapshot_job(tables, src, tgt).select("db", "table", "value").collect()
    assert [(r.db, r.table) for r in out] == [("app", "orders")] and '"schema":"public","table":"orders"' in out[0].value
    with pytest.raises(ValueError, match="app.orders"):
        snapshot_job([SnapshotTable(rows, "app", "orders")], src, tgt)
    assert snapshot_job([SnapshotTable(rows, "app", "orders")], RelationalSource(kind=kind, databases="app"), tgt).count() == 1


def test_partitions_are_required():
    with pytest.raises(ValueError, match="partitions"):
        KafkaTarget(topic="t")
    with pytest.raises(ValueError, match="partitions"):
        KafkaTarget.from_properties({"topic": "t"})


def test_kafka_options_in_both_topic_modes():
    from lograft.sinks import kafka_options

    for props in ({"topic": "t"}, {"perDBTopicPrefix": "x-"}):
        t = KafkaTarget.from_properties({"kafkaBrokers": "b1:9092,b2:9092", "partitions": "3", **props})
        assert kafka_options(t) == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "kafka.acks": "all"}
    with pytest.raises(ValueError):
        kafka_options(KafkaTarget(topic="t", partitions=1))


def test_booleans_read_like_java():
    assert RelationalSource.from_properties("oracle", {"stringifyData": "TRUE"}).stringify is True
    assert RelationalSource.from_properties("oracle", {"stringifyData": " true"}).stringify is False


def test_jdbc_snapshot_options():
    from lograft.sources import read_jdbc_snapshot

    class Reader:
        def jdbc(self, url, table, **kw):
            return url, table, kw

    class Session:
        read = Reader()

    assert read_jdbc_snapshot(Session(), "jdbc:x", "t", "id", 1, 100, 8, {"user": "u"}) == (
        "jdbc:x", "t", {"column": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 8, "properties": {"user": "u"}})


def test_relational_flavours_route_events(spark):
    from lograft.plans.jobs import relational_job
    from lograft.sources.tables import events_change_feed
    from tests.conftest import SF001

    feed = events_change_feed(spark.read.parquet(f"{SF001}/events.parquet"))
    tgt = {"MSKTargetCDC": {"perDBTopicPrefix": "", "deliveryGuarantee": "at-least-once", "partitions": "5"}}
    for kind, group in (("mysql", "MySQLSrcCDC"), ("postgres", "PgSrcCDC"), ("oracle", "OracleSrcCDC")):
        props = {"db": "App_DB_(view|click)"}
        if kind == "oracle":
            props["pk"] = "id"  # the feed's key column is lower case
        src, kafka = jobs_from_properties(kind, {group: props, **tgt})
        out = relational_job(feed, src, kafka)
        assert out.filter("reject_reason IS NOT NULL").count() == 0
        assert {r.topic for r in out.select("topic").distinct().collect()} == {"cdc-app-db-view", "cdc-app-db-click"}
        stringified = out.filter("op = 'c'").select(F.get_json_object("value", "$.after").alias("a")).first().a
        assert stringified.startswith("{")
        is_string = out.filter("op = 'c'").selectExpr("schema_of_variant(parse_json(value):after) AS t").first().t
        assert (is_string == "STRING") == src.stringify
    # Oracle's default key column is upper case: a lower-case feed is rejected, not dropped.
    src, kafka = jobs_from_properties("oracle", {"OracleSrcCDC": {}, **tgt})
    out = relational_job(feed, src, kafka)
    assert out.filter("reject_reason = 'key_missing'").count() == out.count() == 1000


def test_top_level_api():
    import lograft

    for name in lograft.__all__:
        assert callable(getattr(lograft, name)), name
