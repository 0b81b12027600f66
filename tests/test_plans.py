"""Plan-shape checks: the properties the design relies on at scale."""

from lograft.config import KafkaTarget, RelationalSource
from lograft.operators import parse_relational, snapshot_diff
from lograft.plans.jobs import relational_job
from lograft.sources.tables import events_change_feed, orders_snapshots
from tests.conftest import SF001

SRC = RelationalSource(kind="mysql", pk="id", stringify=False, databases="App_DB_(view|click)")
TGT = KafkaTarget(per_db_topics=True, partitions=7, delivery_guarantee="at-least-once")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _split_feed(spark):
    # A feed already spread over more partitions than the session's
    # parallelism, as any large scan is.
    n = spark.sparkContext.defaultParallelism * 2
    feed = events_change_feed(spark.read.parquet(f"{SF001}/events.parquet")).repartition(n).cache()
    feed.count()
    return feed


def test_routing_path_is_narrow_on_a_split_input(spark):
    plan = _plan(relational_job(_split_feed(spark), SRC, TGT))
    above_scan = plan.split("InMemoryTableScan")[0]
    assert "Exchange" not in above_scan
    assert "Broadcast" not in plan and "Join" not in above_scan


def test_filtered_job_parses_each_event_once(spark):
    plan = _plan(relational_job(_split_feed(spark), SRC, TGT).filter("reject_reason IS NULL"))
    assert plan.split("InMemoryTableScan")[0].count("from_json(") == 1
    assert plan.count("CollectMetrics") == 2


def test_excluded_events_are_dropped_before_key_and_text_work(spark):
    src = RelationalSource(kind="postgres", pk="id", stringify=True, databases="app", schemas="s_view", tables=r"s_view\.events")
    lines = _plan(relational_job(_split_feed(spark), src, TGT)).split("InMemoryTableScan")[0].split("\n")
    row = {what: next(i for i, line in enumerate(lines) if what in line) for what in ("Filter", "AS __raw", "AS __f#", "AS __e")}
    # A plan is read from the bottom up.
    assert row["AS __f#"] < row["AS __raw"] < row["Filter"] < row["AS __e"]


def test_rewritten_events_are_parsed_once(spark):
    src = RelationalSource(kind="mysql", pk="id", stringify=True)
    plan = _plan(relational_job(_split_feed(spark), src, TGT).filter("reject_reason IS NULL")).split("InMemoryTableScan")[0]
    assert plan.count("from_json(") == 1 and "parse_json" not in plan


def test_snapshot_records_parse_nothing(spark):
    from lograft.sources import snapshot_records

    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(snapshot_records(orders, "d", "t", "o_orderkey", stringify=True))
    assert "from_json" not in plan and "Exchange" not in plan


def test_rebalance_only_when_asked(spark):
    from lograft.operators import rebalance

    df = spark.range(10)
    assert rebalance(df) is df
    assert "Exchange" in _plan(rebalance(df, 3))


def test_parse_after_observe_stays_small(spark):
    df = spark.createDataFrame([('{"before":null,"after":{"id":1},"source":{"db":"d","table":"t"},"op":"c"}',)],
                               "value string")
    p = parse_relational(df, "id").filter("reject_reason IS NOT NULL")
    assert len(p._jdf.queryExecution().optimizedPlan().toString()) < 30000


def test_snapshot_diff_is_one_key_join(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    old, new = orders_snapshots(orders)
    plan = _plan(snapshot_diff(old, new, "o_orderkey", "tpch", "orders"))
    assert plan.count("SortMergeJoin") == 1 and "FullOuter" in plan
    assert plan.count("Exchange hashpartitioning(__k") == 2
    assert "Broadcast" not in plan
