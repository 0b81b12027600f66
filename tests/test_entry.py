import decimal

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["topic", "key", "partition", "op", "pos"]


def test_every_query_has_oracle():
    assert set(E.QUERIES) == set(E.ORACLE_SQL)
    assert set(E.queries()) >= set(E.oracle_sql()) >= set(E.QUERIES)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_building_a_query_starts_no_scan(spark, name):
    """A Parquet schema needs no job here; jobs that do run belong to streams and hand-offs,
    or bring a bounded number of key bounds and split points."""
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        E.QUERIES[name](spark, SF001)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        tasks = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    streams = {"stream_routed_files", "ordered_files", "event_accounting", "job_startup_modes", "ordered_across_batches",
               "repeats_removed", "batch_accounting", "chunked_initial"}
    bounds = {"split_ranges", "snapshot_diff_by_range"}
    if name not in streams | bounds:  # schema inference reads a footer: one task each
        assert all(t is None or (t.numTasks == 1 and t.name.startswith("parquet")) for t in tasks), [t and t.name for t in tasks]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    order = sorted(df.columns)
    s_rows = sorted(tuple(repr(_norm(r[c])) for c in order) for r in df.collect())
    idx = [d_cols.index(c) for c in order]
    d_rows = sorted(tuple(repr(_norm(r[i])) for i in idx) for r in res.fetchall())
    assert s_rows == d_rows
