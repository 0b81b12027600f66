"""Per-key ordering before a sink, and a check that it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = ("hash", "range")


def order_by_key(
    df: DataFrame,
    num_partitions: int | None = None,
    key: str = "partition_key",
    position: str = "pos",
    strategy: str = "hash",
    within: tuple[str, ...] = (),
) -> DataFrame:
    """Put each key's events in source-position order before a sink.

    ``hash``: hash-partition on the key string, sort within partitions. Each
    key has one task, so one writer per key: the layout a message log needs.
    A hot key stays in one task; the sort is external and spills rather than
    failing. Events without a position have no order to keep (documents without a
    key, schema changes): those are spread by their text, not piled up on a key.

    ``range``: range-partition on (key, position), sort within partitions. A
    hot key is split into consecutive position ranges over several tasks, and
    part files in task order keep the order. Use it for file sinks when one key
    may hold a large share of the rows. The range bounds come from a sample
    (one extra pass over the input).

    ``within``: columns sorted by before the key, as the folder columns of a
    file sink: a writer that is handed rows in another order sorts them again and
    loses the key's. ``num_partitions`` is the job's choice, by its volume; without
    it the width is left to Spark, which may merge small partitions.

    Works on a micro-batch inside ``foreachBatch``: sorting a streaming
    DataFrame directly is not allowed.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown ordering strategy {strategy!r}; expected one of {STRATEGIES}")
    width = (num_partitions,) if num_partitions else ()
    if strategy == "range":
        spread = df.repartitionByRange(*width, *within, F.col(key), F.col(position))
    else:
        salt = F.when(F.col(position).isNull(), F.xxhash64(*df.columns)) if position in df.columns else F.lit(None)
        spread = df.repartition(*width, F.col(key), salt)
    return spread.sortWithinPartitions(*within, key, position)


def ordering_report(df: DataFrame, key: str = "partition_key", position: str = "pos") -> DataFrame:
    """Per key: events, position inversions, and number of tasks holding it.

    Inversions count a position lower than the one before it, inside a task or
    across consecutive tasks of the same key (a key split by ``range`` must
    continue where the previous task stopped). Evaluate on the output of
    ``order_by_key``: task id and the in-task row sequence are taken before any
    further exchange.
    """
    tagged = df.select(
        key, position,
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    w = Window.partitionBy("_task", key).orderBy("_seq")
    per_task = (
        tagged.withColumn("_prev", F.lag(position).over(w))
        .groupBy(key, "_task")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.when(F.col(position) < F.col("_prev"), 1).otherwise(0)).alias("_inv"),
            F.min(position).alias("_lo"),
            F.max(position).alias("_hi"),
        )
    )
    across = Window.partitionBy(key).orderBy("_task")
    stepped = per_task.withColumn("_prev_hi", F.lag("_hi").over(across))
    return stepped.groupBy(key).agg(
        F.sum("_n").alias("n_events"),
        (F.sum("_inv") + F.sum(F.when(F.col("_lo") < F.col("_prev_hi"), 1).otherwise(0))).alias("inversions"),
        F.count(F.lit(1)).alias("n_tasks"),
    )


def written_order_report(files: DataFrame, key: str = "partition_key", position: str = "pos",
                         batch: str = "batch_id") -> DataFrame:
    """Per key: events and position inversions in written files (Parquet), and batches
    that hold a position lower than one of an earlier batch (``batch_inversions``).

    Rows go by batch, file name and row in the file, which is how a reader of the
    files meets them. Files of one batch are named in task order. The batch of a
    snapshot, which has no number, comes first.
    """
    tagged = files.select(key, position, F.col(batch).cast("string").alias("_batch"), F.col("_metadata.file_name").alias("_file"),
                          F.col("_metadata.row_index").alias("_row"))
    per_file = (
        tagged.withColumn("_prev", F.lag(position).over(Window.partitionBy(key, "_batch", "_file").orderBy("_row")))
        .groupBy(key, "_batch", "_file")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col(position) < F.col("_prev"), 1).otherwise(0)).alias("_inv"),
             F.min(position).alias("_lo"), F.max(position).alias("_hi"))
    )
    stepped = per_file.withColumn("_prev_hi", F.lag("_hi").over(Window.partitionBy(key, "_batch").orderBy("_file")))
    per_batch = stepped.groupBy(key, "_batch").agg(
        F.sum("_n").alias("_n"), (F.sum("_inv") + F.sum(F.when(F.col("_lo") < F.col("_prev_hi"), 1).otherwise(0))).alias("_inv"),
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    number = F.coalesce(F.col("_batch").try_cast("bigint"), F.lit(-1))
    earlier = Window.partitionBy(key).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return (per_batch.withColumn("_before", F.max("_hi").over(earlier)).groupBy(key)
            .agg(F.sum("_n").alias("n_events"), F.sum("_inv").alias("inversions"),
                 F.sum(F.when(F.col("_lo") < F.col("_before"), 1).otherwise(0)).alias("batch_inversions")))
