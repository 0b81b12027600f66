"""Mixing sources to target weights by systematic sampling.

Each source gets a target size by weight. Its documents stand in a line, every
one with the same expected number of copies (target / size of the source); the
running sum of these, plus one random offset, crosses integers, and a document is
emitted once for each integer crossed. The line goes by size class, so
every stretch of it, and thus the sample, has documents of all sizes in proportion.

The running sum needs no global sort: documents are dealt to cells of a source
(size class and a salt), the cells of a source are counted and summed up, and a
document adds its place within its cell. A document's salt and place follow from a hash
of its id, text and whatever else is kept of it, so they are the same in every run and
partitioning. Rows equal in all of that are counted before they are placed, and take
places side by side: one cell row stands for any number of them. A cell of a hot source
or of thousands of equal texts holds a small part of them. Decisions are made on narrow
rows; what is kept joins them at the end, by the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import settle, sieve_cells, sieve_test, tell_apart

#: Cells of one size class.
SALTS = 256
#: Expected copies and offsets are whole multiples of 1 / GRID: sums are exact at any length.
GRID = 1 << 24


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and 09-0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(docs: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, size) rows -> source_size and target per source.

    Sources by code point, null last, weigh ``weights``, repeating. They share
    ``share`` times all sizes by weight, but no target exceeds ``most`` times its
    source's size; what is over goes to the others by weight. That is a water
    level: target = min(cap, level * weight). The level follows from sums over the
    sources in the order in which they reach their caps.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*(F.lit(float(w)) for w in weights))
    sizes = sizes.withColumn("weight", F.element_at(pattern, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    sizes = sizes.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sizes = (sizes.withColumn("left", F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             .withColumn("rest", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # The first source, in that order, that stays below its cap sets the level; without one all are at their caps.
    level = F.min(F.when(F.col("cap") * F.col("rest") > F.col("left") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("left") / F.col("rest")))).over(all_rows)
    sizes = sizes.withColumn("level", level.getField("col2"))
    return sizes.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                keep: Sequence[str] = ()) -> DataFrame:
    """How often the mix takes each document.

    A document's size is its number of words (null: 0). Returns a row per row of
    ``docs``: doc_id, source, size, source_size, target, copies, and the columns
    ``keep`` names (those whose names are taken are left out). Copies are 0, 1 or 2 at most for the
    default ``most``: never more than that times the document. The same rows and seed give the same result in any
    partitioning. Sources of size 0 take nothing. A null source is a source. Null ids
    and repeated rows are documents of their own; rows equal in id, source, text and
    everything kept cannot be told apart, and some of them are taken. No rows give no rows.
    """
    taken = ("source", "size", "source_size", "target", "copies")
    kept = {f"_keep_{k}": k for k in keep if k not in taken}
    name, text = F.col(source_col).cast("string"), F.col(text_col).cast("string")
    none = F.lit("null")
    draw = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col(id_col).cast("long").cast("string"), none), F.coalesce(F.md5(F.encode(text, "UTF-8")), none)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), name.alias("source"), word_count(text).alias("size"), draw.alias("_draw"),
                       *(F.col(f"`{k}`").alias(c) for c, k in kept.items()))
    # Null and other names as one key that joins.
    rows = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    rows = rows.withColumn("_rest", F.xxhash64(*kept) if kept else F.lit(0).cast("long"))
    same = ["_key", "_draw", "_rest", "source", "size", "doc_id"]
    # Sizes are counted once; texts that are kept are read again, not stored.
    alike = settle(rows.groupBy(*same).agg(F.count("*").alias("n")))
    plan = _planned(alike, targets(alike.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, most), seed)
    out = ["doc_id", "source", "size", "source_size", "target"]
    if not kept:
        return _with_copies(tell_apart(plan, "n", "_i"), F.col("_i")).select(*out, "copies")
    plan = settle(plan)
    by = ["_key", "_draw", "_rest"]
    held = rows.select(*by, *kept)
    several = plan.filter("n > 1")
    alone = _with_copies(plan.filter("n = 1"), F.lit(0)).join(held, by)
    once = sieve_test(held, sieve_cells(several, *by), *by).filter("in_sieve").dropDuplicates(by).drop("in_sieve")
    cols = [*out, "copies", *(F.col(c).alias(k) for c, k in kept.items())]
    return alone.select(*cols).unionByName(_with_copies(tell_apart(several.join(once, by), "n", "_i"), F.col("_i")).select(*cols))


def _planned(alike: DataFrame, goals: DataFrame, seed: str) -> DataFrame:
    """``alike`` with source_size, target, rate, and ``at``: where the line is before its first row."""
    # The length of the size in bits and its six leading bits: 32 classes for each power of two.
    digits = F.length(F.conv(F.col("size").cast("string"), 10, 2))
    coarse = F.call_function("shiftright", F.col("size"), F.greatest(digits - 6, F.lit(0)))
    placed = (alike.withColumn("_class", digits * 64 + coarse)
              .withColumn("_salt", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int") % SALTS))
    cell = ["_key", "_class", "_salt"]
    counts = placed.groupBy(*cell).agg(F.sum("n").alias("m"))
    line = Window.partitionBy("_key").orderBy("_class", "_salt")  # rows: the cells of a source
    counts = counts.withColumn("before", F.sum("m").over(line) - F.col("m")).drop("m")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * GRID + 0.5)).otherwise(0).cast("long")
    offset = F.md5(F.concat_ws("/", F.lit(seed), F.lit("offset"), F.coalesce(F.col("source"), F.lit(""))))
    goals = (goals.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
             .withColumn("rate", rate).withColumn("start", F.conv(F.substring(offset, 1, 6), 16, 10).cast("long")).drop("source"))
    inside = F.sum("n").over(Window.partitionBy(*cell).orderBy("size", "_draw", "_rest")) - F.col("n")
    return (placed.withColumn("_inside", inside).join(counts.join(goals, "_key"), cell)
            .withColumn("at", F.col("start") + F.col("rate") * (F.col("before") + F.col("_inside")))
            .select("_key", "_draw", "_rest", "doc_id", "source", "size", "n", "source_size", "target", "rate", "at"))


def _with_copies(plan: DataFrame, nth) -> DataFrame:
    """``plan`` with the copies of the ``nth`` (from 0) of each row's equal documents."""
    at = F.col("at") + F.col("rate") * nth
    copies = F.call_function("shiftright", at + F.col("rate"), F.lit(24)) - F.call_function("shiftright", at, F.lit(24))
    return plan.withColumn("copies", copies.cast("long"))
