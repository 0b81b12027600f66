"""The schema change in force for each row event of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions of one block.
SPAN = 1 << 20


def schema_in_force(events: DataFrame, span: int = SPAN, position: str = "pos") -> DataFrame:
    """The row events of a parsed feed with ``schema_pos`` and ``schema_value``: position and
    text of the last schema change of their table at or before their position, else NULL.

    An as-of join by blocks of ``span`` positions. The schema changes of a block are one
    row, in order; a window over the *blocks* of a table, not over its events, brings
    each block the last change before it. An event meets the one row of its table and block,
    so a table with a large part of all events is dealt over as many tasks as it has
    blocks. Schema changes without a table or a position are in force nowhere; row events
    without them pass with NULLs. Of changes at one position, the greatest text counts.
    """
    at, where = F.col(position), ["db", "table", "_block"]
    blocked = events.withColumn("_block", F.floor(at / F.lit(span)).cast("bigint"))
    rows = blocked.filter("event_kind <> 'schema'")
    change = F.when(F.col("event_kind") == "schema", F.struct(at.alias("p"), F.col("value").alias("v")))
    # One pass for the blocks there are and the changes in them; most blocks have none.
    blocks = (blocked.filter("db is not null and `table` is not null and _block is not null").groupBy(*where)
              .agg(F.array_sort(F.collect_list(change)).alias("_changes")))
    earlier = Window.partitionBy("db", "table").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    started = blocks.withColumn("_start", F.last(F.try_element_at("_changes", F.lit(-1)), ignorenulls=True).over(earlier))
    last = F.coalesce(F.try_element_at(F.filter("_changes", lambda c: c["p"] <= at), F.lit(-1)), F.col("_start"))
    return (rows.join(started, where, "left").withColumn("_last", last)
            .select(*events.columns, F.col("_last.p").alias("schema_pos"), F.col("_last.v").alias("schema_value")))
