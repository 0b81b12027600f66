"""Uniform shuffle into shards of exact sizes, by a communication matrix.

Rows are dealt to blocks. How many rows each block sends to each shard is drawn
first, as one matrix: row sums are the block sizes, column sums the shard sizes,
and its law is that of a uniformly random assignment (multivariate
hypergeometric). Each block permutes its rows and cuts them by its row of the
matrix, the rows are exchanged, and each shard permutes what it got. All rows are
shuffled uniformly, and no shard is larger than another by more than a row.

Main path: DataFrame functions only. The driver sees one count per block and
draws the matrix: blocks times shards numbers, however many rows there are.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import settle, tell_apart

#: Blocks that rows are dealt to, and parts of a shard that permute on their own.
BLOCKS, PARTS = 1024, 256


def communication_matrix(block_sizes: Sequence[int], shard_sizes: Sequence[int], seed: int) -> np.ndarray:
    """A random matrix of counts with these row and column sums, distributed as
    the counts of a uniformly random assignment of rows to places in shards.

    Rows choose shards independently at first (a multinomial draw per block). Then
    shards that got too many give up a uniform choice of their rows, in random
    order, to those that got too few. Rows are exchangeable in both steps, so every
    assignment with these shard sizes is as likely as any other, at any size.
    """
    rng, pick = np.random.default_rng(seed), random.Random(seed)
    sizes = np.asarray(block_sizes, np.int64)
    wanted = np.asarray(shard_sizes, np.int64)
    if sizes.sum() != wanted.sum():
        raise ValueError("rows and places differ in number")
    total = max(1, int(wanted.sum()))
    matrix = np.array([rng.multinomial(n, wanted / total) for n in sizes], np.int64).reshape(len(sizes), len(wanted))
    over = matrix.sum(axis=0) - wanted
    moved: list[int] = []  # the block of each row given up
    for s in np.flatnonzero(over > 0):
        ends = np.cumsum(matrix[:, s])
        given = np.searchsorted(ends, pick.sample(range(int(ends[-1])), int(over[s])), "right")
        matrix[:, s] -= np.bincount(given, minlength=len(sizes))
        moved += given.tolist()
    pick.shuffle(moved)
    at = 0
    for s in np.flatnonzero(over < 0):
        got = moved[at: at - int(over[s])]
        at -= int(over[s])
        matrix[:, s] += np.bincount(got, minlength=len(sizes))
    return matrix


def shuffle_into_shards(rows: DataFrame, shards: int = 8, seed: int = 7, blocks: int = BLOCKS, parts: int = PARTS) -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and slot (0, 1, ... in each shard).

    Shard sizes differ by one row at most. The same rows and seed give the same
    result. A row's random numbers are hashes of all its columns, so it does not
    matter where it is read; rows equal in every column are interchangeable, and are
    counted and numbered first, so that they too go to all blocks.
    Nulls in any column are values like others; no rows give no rows. A column
    named shard or slot is replaced. Rows travel as they are: pass ids
    and what is needed of the content.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    cols = [F.col(f"`{c}`") for c in names]

    def draw(n: int):
        return F.xxhash64(F.lit(seed * 8 + n), *cols, "_nth")

    each = settle(tell_apart(rows.select(*cols).groupBy(*cols).agg(F.count("*").alias("_times")), "_times", "_nth"))
    dealt = each.select(*cols, F.pmod(draw(0), F.lit(blocks)).alias("_block"), draw(1).alias("_r1"), draw(2).alias("_r2"))
    counts = {r["_block"]: r["count"] for r in dealt.groupBy("_block").count().collect()}  # one count per block
    sizes = [counts.get(b, 0) for b in range(blocks)]
    total = sum(sizes)
    matrix = communication_matrix(sizes, [total // shards + (s < total % shards) for s in range(shards)], seed)
    ends = json.dumps(np.cumsum(matrix, axis=1).tolist())
    plan = (rows.sparkSession.range(1)
            .select(F.posexplode(F.from_json(F.lit(ends), "array<array<bigint>>")).alias("_block", "_ends"))
            .withColumn("_block", F.col("_block").cast("long")))

    place = F.row_number().over(Window.partitionBy("_block").orderBy("_r1", "_r2"))
    sent = (dealt.withColumn("_place", place).join(F.broadcast(plan), "_block")  # a row per block
            .withColumn("shard", F.expr("size(filter(_ends, e -> e < _place))"))
            .withColumn("_part", F.pmod(F.col("_r2"), F.lit(parts)))
            .drop("_block", "_place", "_ends", "_r1"))
    sent = settle(sent)
    before = sent.groupBy("shard", "_part").agg(F.count("*").alias("n"))
    line = Window.partitionBy("shard").orderBy("_part")  # at most ``parts`` rows a shard
    before = before.select("shard", "_part", (F.sum("n").over(line) - F.col("n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_r2"))
    return (sent.withColumn("_place", inside).join(F.broadcast(before), ["shard", "_part"])  # shards x parts rows
            .withColumn("slot", F.col("_before") + F.col("_place") - 1)
            .drop("_part", "_r2", "_before", "_place"))
