"""Exact deduplication by progressive refinement.

Texts are told apart by ever more of their content: by length in bytes, then by
a hash of their first bytes, then by a hash of the whole. A text goes on to the
next step only if another text agreed with it so far, so whole texts are hashed
only where a copy is likely. Each step groups short keys and never moves texts;
what survives a step reaches the next scan as a filter of fixed size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import join_hot, settle, sieve_cells, sieve_test

#: Bytes of a text that the second step hashes.
PREFIX_BYTES = 256
#: Copies of a text beyond which they are dealt over several tasks.
HOT_GROUP = 1000


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None,
                     prefix_bytes: int = PREFIX_BYTES, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Group rows of identical text; of each group the row with the largest id stays.

    ``normalise`` maps the text column to the text to compare (default: no
    change). ``carry`` names further expressions over ``docs`` to return. Returns a
    row per row of ``docs``: doc_id, keep_id, group_size, kept, and what is carried.

    A null text counts as empty, and empty texts are copies of each other. Null
    ids are smaller than any other (keep_id is null only where a whole group has
    none). Rows that repeat id and text are one document: all are kept or none.
    Other columns are not read; no rows give no rows. Texts count as identical
    if their lengths and SHA-256 hashes are.
    """
    carry = dict(carry or {})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.encode(normalise(text) if normalise else text, "UTF-8").alias("_body"),
                       *(c.alias(n) for n, c in carry.items())).withColumn("_size", F.length("_body").cast("long"))
    prefix = F.xxhash64(F.substring("_body", 1, prefix_bytes))

    sizes = rows.groupBy("_size").count().filter("count > 1")
    rows = sieve_test(rows, sieve_cells(sizes, "_size"), "_size").withColumn("_prefix", F.when(F.col("in_sieve"), prefix)).drop("in_sieve")
    starts = rows.filter("_prefix is not null").groupBy("_size", "_prefix").count().filter("count > 1")
    rows = sieve_test(rows, sieve_cells(starts, "_size", "_prefix"), "_size", "_prefix")
    whole = F.when(F.col("in_sieve") & F.col("_prefix").isNotNull(), F.unhex(F.sha2("_body", 256)))
    keyed = settle(rows.select("doc_id", "_size", whole.alias("_whole"), *carry))

    again = keyed.filter("_whole is not null")
    groups = (again.groupBy("_size", "_whole").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    found = (join_hot(again, groups, ["_size", "_whole"], f"group_size > {HOT_GROUP}")
             .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), *carry))
    alone = keyed.filter("_whole is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *carry)
    return found.unionByName(alone)
