"""Streams with a memory: order per key across micro-batches, and repeated records."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups that keys, and events without a key or position, are dealt to.
GROUPS = 4096


def flag_late(routed: DataFrame, key: str = "partition_key", position: str = "pos", reject: bool = False, groups: int = GROUPS) -> DataFrame:
    """``routed`` with ``late``: whether an earlier micro-batch held a higher position of the same key.

    Inside a batch a sink orders each key's events itself (``order_by_key``); an event
    that comes a batch too late cannot be put in order any more. The highest position of
    each key is kept in Spark's state store (across restarts). With
    ``reject``, late events get the reject reason ``late`` and go to the reject table, so
    what a sink writes is in order per key over all batches. Events without a key or
    position have no order to keep and are never late; they take no state.

    Keys are dealt to ``groups`` by a hash, and a group's positions are one state: a call of
    Python costs milliseconds, however few events it is for, so its number must not grow
    with that of the keys. A batch writes the states of the groups it meets. ``groups`` is
    fixed for the life of a checkpoint; give more for many millions of keys.
    """
    numbers = {f.name: f.dataType.simpleString() for f in routed.schema if isinstance(f.dataType, T.IntegralType)}
    # Integers travel as text: data frames of the workers would make NULLs of them to floats.
    texts = routed.select(*(F.col(f"`{c}`").cast("string").alias(c) if c in numbers else F.col(f"`{c}`") for c in routed.columns))
    ordered = F.col(key).isNotNull() & F.col(position).isNotNull()
    deal = F.when(ordered, F.xxhash64(key)).otherwise(F.xxhash64(*routed.columns))
    grouped = (texts.withColumns({"_key": F.when(ordered, F.col(key).cast("string")), "_group": F.pmod(deal, F.lit(groups))})
               .groupBy("_group"))

    def mark(_: tuple, frames: Iterator, state: GroupState) -> Iterator:
        before = json.loads(state.get[0]) if state.exists else {}
        high: dict[str, int] = {}
        for frame in frames:
            late = []
            for k, p in zip(frame["_key"], frame[position]):
                if not isinstance(k, str):  # no order (NULL may come as NaN)
                    late.append(False)
                    continue
                at = int(p)
                late.append(k in before and at < before[k])
                if k not in high or at > high[k]:
                    high[k] = at
            frame["late"] = late
            yield frame.drop(columns=["_key", "_group"])
        risen = {k: at for k, at in high.items() if k not in before or at > before[k]}
        if risen:
            state.update((json.dumps(before | risen),))

    out = T.StructType([*texts.schema.fields, T.StructField("late", T.BooleanType())])
    marked = grouped.applyInPandasWithState(mark, out, "highs string", "append", GroupStateTimeout.NoTimeout)
    cols = [F.col(f"`{c}`").cast(numbers[c]).alias(c) if c in numbers else F.col(f"`{c}`") for c in routed.columns]
    if reject:
        reason = F.when(F.col("late") & F.col("reject_reason").isNull(), F.lit("late")).otherwise(F.col("reject_reason"))
        cols = [reason.alias(c) if c == "reject_reason" else x for c, x in zip(routed.columns, cols)]
    return marked.select(*cols, "late")


def drop_repeats(records: DataFrame, time: str = "timestamp", horizon: str = "1 hour", event_id: str = "event_id") -> DataFrame:
    """Records read from a log, each ``event_id`` once: what an at-least-once writer wrote again
    after a failure is dropped.

    Ids are kept in Spark's state store until the log's time (``time``, when a record was
    appended) is ``horizon`` past them, so the state is bounded by what is written in that
    time. ``horizon`` has to exceed the delay between a write and its repetition, and
    between the log's partitions: a record older than that is dropped unseen.
    """
    return records.withWatermark(time, horizon).dropDuplicatesWithinWatermark([event_id])
