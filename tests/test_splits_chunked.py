import bisect
import datetime
import decimal
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.config import KafkaTarget, RelationalSource
from lograft.plans.jobs import SnapshotTable, relational_job, start_job
from lograft.operators.route import route
from lograft.sources import read_feed, read_in_waves, snapshot_records, split_of, split_points, split_predicates, write_feed
from lograft.plans.queries import QUERIES
from lograft.sources.chunked import Wave, _position, after_waves
from lograft.streaming import ordered_file_writer, skip_to_end, start_chunked_job

TGT = KafkaTarget(topic="t", partitions=3, delivery_guarantee="at-least-once")


def keys_of(kind, n=3000):
    draw = random.Random(kind)
    text = lambda: "".join(draw.choice("ab'é\U0001F600Z") for _ in range(draw.randrange(5)))
    make = {
        "bigint": lambda: (int(draw.random() ** 6 * 10**12),),
        "double": lambda: (draw.gauss(0, 1) ** 5,),
        "string": lambda: (text(),),
        "decimal(30,3)": lambda: (decimal.Decimal(draw.randrange(10**20)).scaleb(-3),),
        "date": lambda: (datetime.date(1990, 1, 1) + datetime.timedelta(days=int(draw.random() ** 3 * 9000)),),
        "timestamp_ntz": lambda: (datetime.datetime(1990, 1, 1) + datetime.timedelta(microseconds=int(draw.random() ** 3 * 10**15)),),
        "string, int": lambda: (text(), draw.randrange(9)),
    }[kind]
    nothing = tuple(None for _ in make())
    return [nothing if draw.random() < 0.05 else make() for _ in range(n)]


KINDS = ["bigint", "double", "string", "decimal(30,3)", "date", "timestamp_ntz", "string, int"]


@pytest.mark.parametrize("kind", KINDS)
def test_each_row_is_in_one_range(spark, kind):
    rows = keys_of(kind)
    names = [f"k{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kind.split(", ") if ", " in kind else [kind])))
    points = split_points(df, names, 12)
    assert points == sorted(points, key=lambda p: [x.encode() if isinstance(x, str) else x for x in p]) and 5 <= len(points) <= 11
    # In Spark by search and by conditions, and in another database by the conditions it would be sent.
    inside = F.array(*(F.expr(f"coalesce({p}, false)") for p in split_predicates(names, points, "`")))
    number = F.coalesce(split_of([F.col(n) for n in names], [f.dataType for f in df.schema], points), F.lit(len(points) + 1))
    got = df.select(number.alias("n"), inside.alias("i")).collect()
    assert all(r.i.count(True) == 1 and r.i.index(True) == r.n for r in got)
    sizes = [sum(r.n == i for r in got) for i in range(len(points) + 1)]
    if kind not in ("string", "string, int"):  # these have few values, some of them more than a range's rows
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    con = duckdb.connect()
    con.register("t", df.toArrow())
    for i, p in enumerate(split_predicates(names, points)):
        assert con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] == sum(r.n == i for r in got)


def test_binary_search_equals_bisect(spark):
    draw = random.Random(1)
    for n in (0, 1, 2, 3, 16, 17, 100):
        points = sorted(draw.sample(range(1000), n))
        df = spark.range(-5, 1005)
        got = df.select("id", split_of([F.col("id")], [T.LongType()], [(p,) for p in points]).alias("s")).collect()
        assert all(r.s == bisect.bisect_right(points, r.id) for r in got)


def test_hot_keys_empty_tables_and_limits(spark):
    hot = spark.range(1000).select(F.when(F.col("id") < 900, F.lit("h")).otherwise(F.col("id").cast("string")).alias("k"))
    points = split_points(hot, "k", 10)
    assert len(points) == len(set(points)) < 9 and ("h",) in points
    assert split_points(hot.limit(0), "k", 10) == [] and split_points(hot, "k", 1) == []
    assert split_points(spark.range(0), "id", 10) == []
    assert split_predicates("k", []) == ['"k" IS NOT NULL', '"k" IS NULL']
    with pytest.raises(ValueError):
        split_points(hot, "k", 0)


def test_sampled_points_of_a_larger_table(spark):
    df = spark.range(200_000).select(F.concat(F.lit("k"), F.lpad(F.pow(F.col("id") / 1000, 3).cast("bigint").cast("string"), 12, "0")).alias("k"))
    points = split_points(df, "k", 20)
    sizes = [r["count"] for r in df.groupBy(split_of([F.col("k")], [T.StringType()], points)).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2 * sorted(sizes)[10]


def test_jdbc_splits(spark):
    from lograft.sources import read_jdbc_splits

    class Reader:
        def jdbc(self, url, table, **kw):
            return url, table, kw

    class Session:
        read = Reader()

    url, table, kw = read_jdbc_splits(Session(), "jdbc:x", "t", ["a", "b"], [("x'", 2)], "`", {"user": "u"})
    assert (url, table, kw["properties"]) == ("jdbc:x", "t", {"user": "u"})
    assert kw["predicates"] == ["`a` IS NOT NULL AND `b` IS NOT NULL AND ((`a` < 'x''' OR (`a` = 'x''' AND `b` < 2)))",
                                "`a` IS NOT NULL AND `b` IS NOT NULL AND NOT ((`a` < 'x''' OR (`a` = 'x''' AND `b` < 2)))", "`a` IS NULL OR `b` IS NULL"]


class Database:
    """A table under change: at every read some events happen before and after the rows are taken."""

    def __init__(self, seed):
        self.draw, self.rows, self.log, self.reads = random.Random(seed), {}, [], 0
        for k in range(60):
            self.write(f"k{k:02}")

    def write(self, key):
        old = self.rows.get(key)
        new = None if old is not None and self.draw.random() < 0.3 else f"v{len(self.log)}"
        self.log.append((len(self.log) + 1, key, old, new))
        if new is None:
            del self.rows[key]
        else:
            self.rows[key] = new

    def some(self):
        for _ in range(self.draw.randrange(25)):
            self.write(f"k{self.draw.randrange(90):02}")

    def now(self):
        return len(self.log)

    def read(self, spark, conditions):
        self.some()
        rows = spark.createDataFrame([(k, v) for k, v in self.rows.items()], "id string, v string").where(" OR ".join(f"({c})" for c in conditions))
        self.some()
        self.reads += 1
        return rows

    def envelopes(self, spark, after=0):
        def image(key, v):
            return "null" if v is None else '{"id":"%s","v":"%s"}' % (key, v)

        rows = [('{"before":%s,"after":%s,"source":{"db":"d","table":"t","pos":%d},"op":"%s"}'
                 % (image(k, old), image(k, new), pos, "c" if old is None else "d" if new is None else "u"),) for pos, k, old, new in self.log if pos > after]
        return spark.createDataFrame(rows, "value string")


@pytest.mark.parametrize("seed", [1, 2])
def test_a_load_under_change_gives_each_key_once(spark, scratch, seed):
    db = Database(seed)
    source = RelationalSource(kind="mysql", pk="id", stringify=bool(seed % 2))
    write_feed(db.envelopes(spark), f"{scratch}/feed/0")
    sent = [db.now()]
    fail = [True]

    def read(conditions):
        if db.reads == 2 and fail.pop():
            raise ConnectionError("database gone")
        return db.read(spark, conditions)

    def feed_between(low, high):
        write_feed(db.envelopes(spark, sent[-1]), f"{scratch}/feed/{len(sent)}")
        sent.append(db.now())
        return read_feed(spark, f"{scratch}/feed/*")

    def start():
        q = start_chunked_job(
            spark, ordered_file_writer(f"{scratch}/out", f"{scratch}/rej", "parquet"), lambda e: relational_job(e, source, TGT),
            lambda rows: snapshot_records(rows, "d", "t", "id", source.stringify), read, "d", "t", "id", T.StringType(), [("k15",), ("k30",), ("k70",)], 4,
            db.now, feed_between, read_feed(spark, f"{scratch}/feed/*", streaming=True), f"chunked{seed}{len(sent)}", f"{scratch}/chk",
            route_load=lambda r: route(r, TGT), quote="`", available_now=True)
        q.awaitTermination()

    with pytest.raises(ConnectionError):
        start()
    fail.append(False)
    start()
    assert db.reads == 4  # the two waves that were done are not read again
    for _ in range(2):
        db.some()
        write_feed(db.envelopes(spark, sent[-1]), f"{scratch}/feed/{len(sent)}")
        sent.append(db.now())
        start()
    assert db.reads == 4
    value = F.get_json_object("value", "$.after")
    out = spark.read.parquet(f"{scratch}/out").select("op", "pos", "partition_key", F.get_json_object(value, "$.v").alias("v"),
                                                      F.get_json_object("value", "$.op").alias("o"), F.get_json_object("value", "$.before").alias("b")).collect()
    load = {r.partition_key: r for r in out if r.op == "r"}
    assert len(load) == sum(r.op == "r" for r in out) and all(r.o == "r" and r.b is None for r in load.values())
    highs = {}  # a loaded key is as the log left it at its position
    for r in load.values():
        state = [new for pos, k, _, new in db.log if k == r.partition_key[4:] and pos <= r.pos]
        assert state[-1] == r.v
        highs[bisect.bisect_right(["k15", "k30", "k70"], r.partition_key[4:])] = r.pos
    want = [(pos, f"d.t.{k}") for pos, k, _, _ in db.log if pos > highs[bisect.bisect_right(["k15", "k30", "k70"], k)]]
    assert sorted((r.pos, r.partition_key) for r in out if r.op != "r") == want


def test_a_load_parses_the_feed_once(spark, scratch):
    """Both passes that write a load, and both sides of its merge, use the events that raced it as they were found once."""
    db = Database(3)
    parsed = spark.sparkContext.accumulator(0)

    def feed_between(low, high):
        write_feed(db.envelopes(spark), f"{scratch}/feed/0")
        return read_feed(spark, f"{scratch}/feed/*").withColumn("value", counted("value"))

    @F.udf("string")
    def counted(value):
        parsed.add(1)
        return value

    source = RelationalSource(kind="mysql", pk="id", stringify=False)
    write_feed(db.envelopes(spark), f"{scratch}/feed/0")
    q = start_chunked_job(
        spark, ordered_file_writer(f"{scratch}/out", f"{scratch}/rej", "parquet"), lambda e: relational_job(e, source, TGT),
        lambda rows: snapshot_records(rows, "d", "t", "id"), lambda c: db.read(spark, c), "d", "t", "id", T.StringType(), [("k15",), ("k30",)], 3,
        db.now, feed_between, read_feed(spark, f"{scratch}/feed/*", streaming=True), "parsed_once", f"{scratch}/chk",
        route_load=lambda r: route(r, TGT), quote="`", available_now=True)
    q.awaitTermination()
    assert parsed.value == db.now()


@pytest.mark.parametrize("kind, points, keys", [
    (T.LongType(), [(-5,), (10,), (20,), (30,)], ["-6", "-5", "9", "10", "19", "20", "30", "10000000000", "x", "1.5"]),
    (T.StringType(), [("b",), ("é",), ("\U0001F600",)], ["", "a", "b", "ba", "z", "é", "\uffff", "\U0001F600", "\U0001F601"]),
    (T.DoubleType(), [(-0.0,), (1.5,)], ["-1", "0", "-0.0", "1.4", "1.5", "NaN", "Infinity", "y"])])
def test_positions_of_waves(spark, kind, points, keys):
    """A key's wave by the points at the ends of waves is that of its range, found by search; no search per event."""
    n = len(points) + 1
    for cuts in ([n], [1, n], [2, n], list(range(1, n + 1))):
        waves = [Wave(i, low, high, 100 * i, 100 * i + 50) for i, (low, high) in enumerate(zip([0, *cuts], cuts))]
        rows = spark.createDataFrame([(f"d.t.{k}", k) for k in keys], "partition_key string, k string")
        split = split_of([F.col("k").try_cast(kind)], [kind], points)
        at = rows.select(split.alias("split"), _position("d", "t", kind, points, waves, "low").alias("low"), _position("d", "t", kind, points, waves, "high").alias("high"))
        for r in at.collect():
            want = waves[-1] if r.split is None else next(w for w in waves if r.split < w.last)
            assert (r.low, r.high) == (want.low, want.high)
        events = rows.select(F.lit("d").alias("db"), F.lit("t").alias("table"), F.lit("row").alias("event_kind"), "partition_key", F.lit(1).alias("pos"))
        assert "aggregate(" not in after_waves(events, "d", "t", kind, points, waves)._jdf.queryExecution().toString()


def test_a_sample_is_sorted_in_one_pass(spark):
    """Points of a text key: the table is read for the rows' number and for the sample, not again for the sort."""
    read = spark.sparkContext.accumulator(0)

    def count(value):
        read.add(1)
        return value

    counted = F.udf(count, "string").asNondeterministic()  # once for each row of a pass
    df = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    points = split_points(df.select(counted("k").alias("k")), "k", 4, sampled=50)
    assert len(points) == 3 and points == sorted(points)
    assert read.value <= 2 * 4000


def test_split_ranges_spreads_the_keys_alone(spark):
    """The table is spread once, with the columns of its keys, and not for each report."""
    report = QUERIES["split_ranges"](spark, "/root/testdata/sf0.001")
    plan = report._jdf.queryExecution().toString()
    assert "REPARTITION_BY" not in plan and "l_extendedprice" not in plan
    assert {r.kind: (r.n_rows, r.n_once) for r in report.collect()} == {k: (report_rows(spark), report_rows(spark)) for k in ("integer", "text", "decimal", "date", "composite")}


def report_rows(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_waves_hold_all_ranges(spark, scratch):
    """More waves than ranges, one range, and rows without a key, which are in the last wave."""
    df = spark.createDataFrame([(None,), (1,), (5,), (9,)], "id int")
    for points, waves, n in (([], 3, 1), ([(5,)], 5, 2), ([(2,), (5,), (7,)], 2, 2)):
        path = f"{scratch}/{len(points)}"
        done = read_in_waves(spark, lambda c: df.where(" OR ".join(f"({x})" for x in c)), "id", points, waves, lambda: 1, path, "`")
        assert len(done) == n and (done[0].first, done[-1].last) == (0, len(points) + 1)
        assert sorted(spark.read.parquet(f"{path}/rows").select("id").toPandas().id.fillna(-1)) == [-1, 1, 5, 9]


def event(i, pos=True):
    return ('{"before":null,"after":{"id":%d},"source":{"db":"d","table":"t"%s},"op":"c"}' % (i, f',"pos":{i}' if pos else ""),)


def test_skipping_runs_no_job_and_reads_nothing(spark, scratch):
    write_feed(spark.createDataFrame([event(i) for i in range(10)], "value string"), f"{scratch}/feed/a")
    stream = relational_job(read_feed(spark, f"{scratch}/feed/*", streaming=True), RelationalSource(kind="mysql"), TGT)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    skip_to_end(stream, f"{scratch}/chk")
    assert jobs() == before
    write_feed(spark.createDataFrame([event(77)], "value string"), f"{scratch}/feed/b")
    seen = []
    q = stream.writeStream.option("checkpointLocation", f"{scratch}/chk").trigger(availableNow=True).foreachBatch(
        lambda b, i: seen.extend(r.pos for r in b.collect())).start()
    q.awaitTermination()
    assert seen == [77]


@pytest.mark.parametrize("mode", ["latest-offset", "initial"])
def test_file_feeds_start_behind_what_they_hold(spark, scratch, mode):
    groups = {"MySQLSrcCDC": {"db": "d", "startupMode": mode}, "MSKTargetCDC": {"topic": "t", "partitions": "2", "deliveryGuarantee": "at-least-once"}}
    rows = spark.createDataFrame([(1,)], "id int")

    def start(name):
        q = start_job(spark, "mysql", groups, read_feed(spark, f"{scratch}/feed/*", streaming=True), f"{scratch}/chk", f"{scratch}/rej", f"{scratch}/out",
                      [SnapshotTable(rows, "d", "t")], fmt="parquet", available_now=True)
        q.awaitTermination()

    write_feed(spark.createDataFrame([event(1), event(2, pos=False), ("{bad",)], "value string"), f"{scratch}/feed/a")
    start("a")
    write_feed(spark.createDataFrame([event(0), event(3, pos=False), ("{worse",)], "value string"), f"{scratch}/feed/b")
    start("b")
    start("c")
    got = sorted((r.op, r.partition_key) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [("c", "d.t.0"), ("c", "d.t.3")] + ([("r", "d.t.1")] if mode == "initial" else [])
    assert [r.value for r in spark.read.parquet(f"{scratch}/rej").collect()] == ["{worse"]
