import pytest
from pyspark.sql import functions as F

from lograft.operators import parse_relational, snapshot_diff
from lograft.sources import highest_position, image_columns, snapshot_events, startup
from lograft.sources.tables import orders_change_log, orders_snapshots
from tests.conftest import SF01


def test_diff_counts_and_replay(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    old, new = orders_snapshots(orders)
    d = snapshot_diff(old, new, "o_orderkey", "tpch", "orders")
    counts = {r.op: r["count"] for r in d.groupBy("op").count().collect()}
    assert counts == {"c": 1714, "d": 2571, "u": 3428}
    # Replaying the changes onto the old snapshot gives the new one (compared
    # as row images: timestamps travel as epoch microseconds).
    old_i, new_i = old.select(*image_columns(old)), new.select(*image_columns(new))
    after = F.from_json(F.get_json_object("value", "$.after"), new_i.schema)
    upserts = d.filter(F.col("op") != "d").select(after.alias("a")).select("a.*")
    kept = old_i.join(d.select("o_orderkey"), "o_orderkey", "left_anti")
    replayed = kept.unionByName(upserts.select(*old_i.columns))
    new = new_i
    assert replayed.exceptAll(new).count() == 0 and new.exceptAll(replayed).count() == 0


def test_diff_of_odd_keys(spark):
    cols = "k long, v string"
    old = spark.createDataFrame([(1, "a"), (None, "x"), (None, "y")], cols)
    new = spark.createDataFrame([(1, "b"), (None, "x"), (2, "c")], cols)
    d = snapshot_diff(old, new, "k", "d", "t")
    assert sorted((r.op, r.k or 0) for r in d.collect()) == [("c", 0), ("c", 2), ("d", 0), ("d", 0), ("u", 1)]
    rejects = parse_relational(d, "k").filter("reject_reason IS NOT NULL")
    assert [r.reject_reason for r in rejects.collect()] == ["key_null"] * 3
    with pytest.raises(Exception, match="more than once: 1"):
        snapshot_diff(old.union(old), new, "k", "d", "t").collect()


def test_startup_modes(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    old, _ = orders_snapshots(orders)
    history, tail = orders_change_log(orders)
    log = history.unionByName(tail).select("value", "op", "pos")
    snap = snapshot_events(old, "tpch", "orders")
    hand_off = highest_position(history)
    n_old, n_hist, n_tail = old.count(), history.count(), tail.count()
    assert startup("snapshot", snapshot=snap).count() == n_old
    assert startup("earliest-offset", changes=log).count() == n_hist + n_tail
    assert startup("latest-offset", changes=log, start_position=hand_off).count() == n_tail
    init = startup("initial", snapshot=snap, changes=log, start_position=hand_off)
    assert init.count() == n_old + n_tail
    assert parse_relational(init, "o_orderkey").filter("reject_reason IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        startup("bogus", snapshot=snap)
    with pytest.raises(ValueError):
        startup("latest-offset", changes=log)


def test_time_zone_conversion(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1995-01-01 08:00:00' AS t, 1 AS id")
    v = snapshot_events(df, "d", "x", time_zone="Asia/Shanghai").first().value
    assert '"t":788918400000000' in v  # 1995-01-01T00:00:00Z
    v = snapshot_events(df, "d", "x").first().value
    assert '"t":788947200000000' in v


def test_kafka_starting_offsets():
    from lograft.sources import kafka_starting_offsets

    assert kafka_starting_offsets("earliest-offset") == "earliest"
    assert kafka_starting_offsets("latest-offset") == "latest"
    assert kafka_starting_offsets("snapshot") is None
    assert kafka_starting_offsets("initial", '{"t":{"0":5}}') == '{"t":{"0":5}}'
    with pytest.raises(ValueError):
        kafka_starting_offsets("newest")
    with pytest.raises(ValueError, match="offsets"):
        kafka_starting_offsets("initial")


def test_events_without_position_pass_a_hand_off(spark):
    from lograft.sources import after_position

    df = spark.createDataFrame([(1,), (5,), (None,)], "pos bigint")
    assert [r.pos for r in after_position(df, 3).collect()] == [5, None]
    assert after_position(df, F.lit(None).cast("bigint")).count() == 3


@pytest.mark.parametrize("stringify", [False, True])
def test_snapshot_records_equal_parsed_events(spark, stringify):
    """The typed path gives the records that parsing the events would give."""
    from lograft.sources import snapshot_records

    df = spark.sql("""SELECT * FROM VALUES
        (1L, 'a"b', true, 1.5D, DECIMAL('7'), TIMESTAMP_NTZ'1995-01-01 08:00:00', NAMED_STRUCT('x', 1)),
        (NULL, NULL, NULL, NULL, NULL, NULL, NULL) AS t(i, s, b, d, n, ts, o)""")
    for pk in ("i", "s", "b", "n", "o"):
        want = parse_relational(snapshot_events(df, "d", "t", "Asia/Shanghai", F.lit(7)), pk, stringify=stringify)
        got = snapshot_records(df, "d", "t", pk, stringify, "Asia/Shanghai", F.lit(7))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect())), pk
    # Fractions are keys, as JSON spells them, on either path.
    kinds = spark.sql("SELECT 1.5D AS d, 1e10D AS e, DECIMAL('1.50') AS m, CAST('1E-10' AS DECIMAL(20, 12)) AS t, CAST(0.1 AS FLOAT) AS f, -0.0D AS z")
    for pk in kinds.columns:
        want = parse_relational(snapshot_events(kinds, "d", "t"), pk, stringify=stringify).first()
        assert want.reject_reason is None and snapshot_records(kinds, "d", "t", pk, stringify).first().partition_key == want.partition_key
