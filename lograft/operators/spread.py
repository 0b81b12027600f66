"""Redistribution before the per-record map, and rows kept behind it."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Spread rows over ``num_partitions`` tasks before CPU-heavy per-record work
    such as JSON parsing; without a number, the input's own splits are used.

    Give a number where one reader feeds the whole job (a single file or log
    partition), in a batch or a stream. A large scan is split already and needs
    none. The choice is the caller's: nothing is run to find out, and it does not
    depend on the size of the input.

    Rows are hash-partitioned on ``xxhash64`` of all columns: deterministic
    under task retries without the local sort a round-robin repartition
    needs. Only fully identical rows share a task.
    """
    return df.repartition(num_partitions, F.xxhash64(*df.columns)) if num_partitions else df


def hold_packed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Persist rows that several writes read: (what is to be unpersisted, the rows).

    Each row is held as one packed column. Of text columns the cache would collect every
    value in a dictionary first, to choose an encoding: for envelopes, no two of which are
    equal, that takes half as long as the parse and finds nothing.
    """
    held = df.select(F.struct("*").alias("row")).persist(StorageLevel.MEMORY_AND_DISK)
    return held, held.select("row.*")
