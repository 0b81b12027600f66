"""Session helpers shared by the operators: scratch folders, importable workers
and a fixed-size semi-join filter."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: 64-bit words of the semi-join filter: 2**17 words are 2**23 bits, 2 MB as rows.
SIEVE_WORDS = 1 << 17


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where that is unset
    (tests) a folder of this machine, which is then set for the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="lograft-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the scratch folder. Cuts the lineage, and
    unlike a checkpoint lets Spark plan what follows by the table's real size."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``settle(df)``, and its number of rows, which are counted as they are written."""
    rows = Observation()
    return settle(df.observe(rows, F.count(F.lit(1)).alias("n"))), rows.get["n"]


#: Narrow rows (a few numbers) of one task.
TASK_ROWS = 1 << 18


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many narrow rows, in a task for each ``TASK_ROWS`` of them, and
    as many as the cluster runs at once at least, where a shuffle would give more. The
    driver's memory goes with the tasks and files, however little they hold."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df.settled_at)
        path.getFileSystem(conf).delete(path, True)


#: Workers that live on after a task give large arrays back to the system.
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Rows and bytes that a Python worker is handed at once, where the session sets nothing else:
#: texts are long.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2500", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def ready_workers(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, get texts in batches
    of bounded size, and do not hold on to memory."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    for key, value in WORKER_ENV.items():
        env.setdefault(key, value)
    for key, value in ARROW_BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def sieve_cells(wanted: DataFrame, *keys: str) -> DataFrame:
    """A Bloom filter of the keys, with one hash, as a table of at most
    ``SIEVE_WORDS`` rows: its size does not depend on the data."""
    h = F.xxhash64(*keys)
    bits = (wanted.select(F.pmod(F.shiftrightunsigned(h, 6), F.lit(SIEVE_WORDS)).alias("_cell"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int")).alias("_bit"))
            .groupBy("_cell").agg(F.bit_or("_bit").alias("_bits")))
    return in_few_tasks(bits, SIEVE_WORDS)


def sieve_test(df: DataFrame, cells: DataFrame, *keys: str) -> DataFrame:
    """``df`` with a column ``in_sieve``: false only where the keys are not among the
    wanted ones. True for some others too, so an exact step has to follow. The
    table of cells has a fixed size and is broadcast."""
    h = F.xxhash64(*keys)
    return (df.withColumn("_cell", F.pmod(F.shiftrightunsigned(h, 6), F.lit(SIEVE_WORDS)))
            .join(F.broadcast(cells), "_cell", "left")
            .withColumn("in_sieve", F.coalesce(F.getbit("_bits", h.bitwiseAND(63).cast("int")) == 1, F.lit(False)))
            .drop("_cell", "_bits"))


def join_hot(many: DataFrame, one: DataFrame, keys: list[str], hot: str, salts: int = 64) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has a row per key, where a key may hold a
    large part of all rows. Rows of keys for which the condition ``hot`` is true in
    ``one`` are dealt by a salt, and those rows of ``one`` are there once per salt; the
    others are joined as ever. Which keys are hot reaches ``many`` as a filter of
    fixed size; a key it lets through by chance is salted on both sides alike."""
    cells = sieve_cells(one.filter(hot), *keys)
    spread = F.when(F.col("in_sieve"), F.pmod(F.xxhash64(*many.columns), F.lit(salts))).otherwise(0).cast("int")
    copies = F.when(F.col("in_sieve"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = sieve_test(many, cells, *keys).withColumn("_salt", spread).drop("in_sieve")
    right = sieve_test(one, cells, *keys).withColumn("_salt", F.explode(copies)).drop("in_sieve")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


#: Numbers that one row is exploded to at once.
RUN = 1024


def tell_apart(counted: DataFrame, count: str, number: str) -> DataFrame:
    """A row of ``counted`` as often as its column ``count`` says, numbered from 0. Rows that
    stand for very many are exploded in runs, which are dealt over tasks."""
    run = F.lit(RUN).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), (F.col(count) - 1).cast("long"), run)
    many = counted.filter(F.col(count) > RUN).withColumn(number, F.explode(starts)).repartition(F.xxhash64(*counted.columns, number))
    each = many.unionByName(counted.filter(F.col(count) <= RUN).withColumn(number, F.lit(0).cast("long")))
    return each.withColumn(number, F.explode(F.sequence(F.col(number), F.least(F.col(count), F.col(number) + run) - 1)))
