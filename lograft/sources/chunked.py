"""A full load of a table that changes meanwhile, merged with the log of its changes.

The table is read in waves of key ranges (``splits``). Around each wave the log's end is
noted: what was read is the table at some moment between the low and the high
position of its wave. Events of a key in between are merged into the load, so that
each key is loaded once, as it was at its wave's high position; the stream then
goes on, for each key, after that position. No event comes twice and none is lost.

The rows read stay where they are; only keys that were written while their own wave was
read take part in a join, and Spark broadcasts those where they are few.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.functions.jsonfn import raw_fields, raw_rest
from lograft.sources.splits import Point, split_predicates


class Wave(NamedTuple):
    """Ranges first .. last - 1 (the last wave has the NULL keys too), read between two log positions."""

    number: int
    first: int
    last: int
    low: int
    high: int


_WAVE = "number int, first int, last int, low bigint, high bigint"


def _done(spark: SparkSession, path: str) -> Wave | None:
    try:
        row = spark.read.schema(_WAVE).json(path).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return Wave(**row.asDict()) if row is not None else None


def read_in_waves(spark: SparkSession, read: Callable[[list[str]], DataFrame], key: str, points: Sequence[Point], waves: int,
                  position_now: Callable[[], int], path: str, quote: str = '"') -> list[Wave]:
    """Read a table range by range into ``path``, ``waves`` times some ranges.

    ``read`` gives the rows of a list of SQL conditions as they are now (as
    ``spark.read.jdbc(predicates=...)`` does, with a task each); ``position_now`` the
    log's end. A wave's positions are recorded when its rows are written: a load that starts
    again goes on with the wave that was cut off, at new positions.
    """
    conditions, n = split_predicates(key, points, quote), len(points) + 1
    waves = max(1, min(waves, n))
    out = []
    for i in range(waves):
        first, last = n * i // waves, n * (i + 1) // waves
        wave = _done(spark, f"{path}/marks/{i}")
        if wave is None:
            low = position_now()
            read(conditions[first:last] + (conditions[n:] if i == waves - 1 else [])).write.mode("overwrite").parquet(f"{path}/rows/wave={i}")
            wave = Wave(i, first, last, low, position_now())
            spark.createDataFrame([wave], _WAVE).coalesce(1).write.mode("overwrite").json(f"{path}/marks/{i}")
        out.append(wave)
    return out


def read_waves(spark: SparkSession, path: str, waves: Sequence[Wave], records: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``read_in_waves`` wrote as routed records (``records``), with their ``wave``."""
    parts = (records(spark.read.parquet(f"{path}/rows/wave={w.number}")).withColumn("wave", F.lit(w.number)) for w in waves)
    return functools.reduce(DataFrame.unionByName, parts)


def _position(db: str, table: str, kind: T.DataType, points: Sequence[Point], waves: Sequence[Wave], at: str) -> Column:
    """A position of the wave that a routed record's key, in its key string, was read in. Waves
    are runs of ranges, so the key is compared with the point at the end of each."""
    key = F.substr("partition_key", F.lit(len(f"{db}.{table}.") + 1)).try_cast(kind)
    out = F.when(key.isNull(), F.lit(getattr(waves[-1], at)))
    for w in waves[:-1]:
        out = out.when(key < F.lit(points[w.last - 1][0]).cast(kind), F.lit(getattr(w, at)))
    return out.otherwise(F.lit(getattr(waves[-1], at))).cast("bigint")


def of_table(db: str, table: str) -> Column:
    """Changes of rows of a table that can be placed: with a key and a position."""
    return ((F.col("db") == db) & (F.col("table") == table) & (F.col("event_kind") == "row") & F.col("partition_key").isNotNull()
            & F.col("pos").isNotNull())


def after_waves(routed: DataFrame, db: str, table: str, kind: T.DataType, points: Sequence[Point], waves: Sequence[Wave]) -> DataFrame:
    """Events that a load by ``waves`` has not taken in: those of the table's keys after the
    high position of their wave. Schema changes, other tables, rejects and events without a
    position pass. Narrow and without state, for batches and streams alike."""
    old = of_table(db, table) & (F.col("pos") <= _position(db, table, kind, points, waves, "high"))
    return routed.filter(~F.coalesce(old, F.lit(False)))


def _as_read(value: Column) -> Column:
    """An envelope as that of a read row: op ``r``, no ``before``, all else as it is written."""
    fields = raw_fields(value)
    head = r'(?s)^(\s*+[{,]\s*+"%s"\s*+:\s*+).*$'
    done = F.transform(fields, lambda f: F.regexp_replace(F.regexp_replace(f, head % "op", '$1"r"'), head % "before", "$1null"))
    return F.concat(F.array_join(done, ""), raw_rest(value, fields))


def raced_events(changes: DataFrame, db: str, table: str, kind: T.DataType, points: Sequence[Point], waves: Sequence[Wave]) -> DataFrame:
    """The last event of each key that was written while its wave was read: ``partition_key``,
    ``op``, ``value`` and, as ``pos``, the high position of the wave."""
    raced = (changes.filter(of_table(db, table))
             .withColumns({"__low": _position(db, table, kind, points, waves, "low"), "__high": _position(db, table, kind, points, waves, "high")})
             .filter((F.col("pos") > F.col("__low")) & (F.col("pos") <= F.col("__high"))))
    last = raced.groupBy("partition_key").agg(F.max(F.struct("pos", "op", "value", "__high")).alias("e"))
    return last.select("partition_key", "e.op", "e.value", F.col("e.__high").alias("pos"))


def merge_raced(loaded: DataFrame, last: DataFrame, db: str, table: str, waves: Sequence[Wave]) -> DataFrame:
    """``merge_waves`` with the ``raced_events`` at hand. They are read more than once."""
    high = F.lit(None).cast("bigint")
    for w in waves:
        high = F.when(F.col("wave") == w.number, F.lit(w.high)).otherwise(high)
    shape = [c for c in loaded.columns if c != "wave"]
    kept = loaded.withColumn("pos", high.cast("bigint")).join(last.select("partition_key"), "partition_key", "left_anti").select(*shape)
    columns = {"db": F.lit(db), "table": F.lit(table), "op": F.lit("r"), "pos": F.col("pos"), "event_kind": F.lit("row"),
               "partition_key": F.col("partition_key"), "value": _as_read(F.col("value")), "reject_reason": F.lit(None).cast("string")}
    merged = last.filter("op <> 'd'").select(*(c.alias(n) for n, c in columns.items()))
    return kept.select(*columns).unionByName(merged)


def merge_waves(loaded: DataFrame, changes: DataFrame, db: str, table: str, kind: T.DataType, points: Sequence[Point],
                waves: Sequence[Wave]) -> DataFrame:
    """The load: each key of the table once, as it was at the high position of its wave.

    ``loaded`` are the routed records of the rows read, with their ``wave``; ``changes``
    routed events that hold all from the first wave's low position to the last one's
    high. ``pos`` of a loaded record is that high position. A key that was written in
    its wave has its last event's image, or is gone if that is a delete. Rows read
    without a key pass as the rejects they are.
    """
    return merge_raced(loaded, raced_events(changes, db, table, kind, points, waves), db, table, waves)
