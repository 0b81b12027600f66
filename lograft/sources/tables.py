"""Change feeds derived from the benchmark tables.

The test tables are plain snapshots; these Spark jobs turn them into the
envelope text a change-data-capture source would deliver, so every query
exercises the full JSON path and its work grows with the tables. Rules:

* relational changes from ``events``: ``op`` by ``event_id % 10`` (0 ``d``,
  1-2 ``u``, 3 ``r``, else ``c``), ``db = 'App_DB_' || event_type``,
  ``table = 'events'``, key ``id = user_id``, position ``event_id``;
* document changes from ``conversations``: ``ns = (chat, conversations)``,
  ``_id`` by ``conv_id % 4`` (0 number, 1 string ``'c' || conv_id``,
  2 ``{"$oid": 24 hex digits}``, 3 no ``documentKey``);
* two snapshots of ``orders``: old drops ``o_orderkey % 7 = 0``, new drops
  ``o_orderkey % 5 = 0`` and sets ``o_orderstatus = 'X'`` where
  ``o_orderkey % 3 = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.functions.jsonfn import json_quote
from lograft.operators.diff import snapshot_diff
from lograft.operators.spread import rebalance
from lograft.sources.snapshot import epoch_micros, image_columns, snapshot_events

# Fixed values of the derived feeds.
EVENTS_DB_PREFIX = "App_DB_"
EVENTS_TABLE = "events"
DOC_DB = "chat"
DOC_COLL = "conversations"
ORDERS_DB = "tpch"
ORDERS_TABLE = "orders"
TAIL_POSITION_BASE = 10**12  # positions of changes made after the first snapshot


def events_op(event_id: Column) -> Column:
    r = event_id % 10
    return F.when(r == 0, "d").when(r.isin(1, 2), "u").when(r == 3, "r").otherwise("c")


HOT_USER = -1  # key of the skewed feed's hot user


def hot_user_id(events_event_id: Column, user_id: Column) -> Column:
    """Skewed keys: every third event (``event_id % 3 = 0``) goes to one user."""
    return F.when(events_event_id % 3 == 0, F.lit(HOT_USER).cast("bigint")).otherwise(user_id)


def events_change_feed(events: DataFrame, pk_as_string: bool = False, hot_key: bool = False,
                       before_shift: int = 0) -> DataFrame:
    """Relational change envelopes (``value``) from ``events``.

    ``hot_key``: a third of all events share one key (see ``hot_user_id``).
    ``before_shift``: the key in ``before`` is that much larger than in ``after``.
    """
    op = events_op(F.col("event_id"))
    user = hot_user_id(F.col("event_id"), F.col("user_id")) if hot_key else F.col("user_id")

    def image(shift: int) -> Column:
        pk = user + shift if shift else user
        return F.struct(
            (pk.cast("string") if pk_as_string else pk).alias("id"),
            F.col("event_id"),
            F.col("event_type"),
            F.col("value").cast(T.DecimalType(12, 2)).alias("value"),
            epoch_micros(F.col("ts"), T.TimestampNTZType()).alias("ts_us"),
            F.col("props"),
        )

    envelope = F.struct(
        F.when(op.isin("u", "d"), image(before_shift)).alias("before"),
        F.when(op != "d", image(0)).alias("after"),
        F.struct(
            F.concat(F.lit(EVENTS_DB_PREFIX), F.col("event_type")).alias("db"),
            F.lit(EVENTS_TABLE).alias("table"),
            F.col("event_id").alias("pos"),
        ).alias("source"),
        op.alias("op"),
        F.floor(epoch_micros(F.col("ts"), T.TimestampNTZType()) / 1000).alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    )
    return events.select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def _json_text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))


def events_feed_with_faults(events: DataFrame) -> DataFrame:
    """Envelopes (``value``) of ``events``, by ``event_id % 12``: 0 is cut short, 1 is a
    schema change, 2 has no position, 3 has a position that is no integer, 4 is of
    another database, the others are creates with position ``event_id``."""
    rule, eid = F.col("event_id") % 12, F.col("event_id")
    db = F.when(rule == 4, F.lit("Other")).otherwise(F.concat(F.lit(EVENTS_DB_PREFIX), F.col("event_type")))
    pos = (F.when(rule == 2, F.lit("")).when(rule == 3, F.lit(',"pos":"0/16B3748"'))
           .otherwise(_json_text(',"pos":', eid)))
    row = _json_text('{"before":null,"after":{"id":', F.col("user_id"), ',"event_id":', eid, '},"source":{"db":"', db,
                     '","table":"events"', pos, '},"op":"c"}')
    ddl = _json_text('{"source":{"db":"', db, '","table":"events"},"ddl":"ALTER TABLE events","event_id":', eid, "}")
    value = F.when(rule == 0, row.substr(F.lit(1), F.length(row) - 1)).when(rule == 1, ddl).otherwise(row)
    return events.select(value.alias("value"), eid.alias("event_id"))


def events_schema_feed(events: DataFrame) -> DataFrame:
    """Envelopes (``value``) of ``events`` in one database with a schema per event type."""
    return events.select(_json_text(
        '{"before":null,"after":{"id":', F.col("user_id"), '},"source":{"db":"app","schema":"s_', F.col("event_type"),
        '","table":"events","pos":', F.col("event_id"), '},"op":"c"}').alias("value"))


def events_feed_with_more_fields(events: DataFrame) -> DataFrame:
    """Envelopes (``value``) of ``events`` with root fields of other kinds: text
    ``transaction``, no ``ts_ms`` where ``event_id % 3 = 0``, and two unknown ones."""
    eid, op = F.col("event_id"), events_op(F.col("event_id"))
    image = _json_text('{"id":', F.col("user_id"), "}")
    null = F.lit("null")
    return events.select(_json_text(
        '{"zone":"z', eid, '","before":', F.when(op.isin("u", "d"), image).otherwise(null),
        ',"after":', F.when(op != "d", image).otherwise(null), ',"source":{"db":"app","table":"events","pos":', eid, '},"op":"', op, '"',
        F.when(eid % 3 == 0, F.lit("")).otherwise(_json_text(',"ts_ms":', eid * 10)),
        ',"transaction":"tx', eid, '","tag":{"b":[', eid, ',null]},"flag":true}').alias("value"))


def events_feed_spelled(events: DataFrame) -> DataFrame:
    """Envelopes (``value``) of ``events`` spelled in many ways: numbers by ``event_id % 7``,
    every fifth key with a fraction, a root field that is there twice, spaces."""
    eid, op, rule = F.col("event_id"), events_op(F.col("event_id")), F.col("event_id") % 7
    n = (F.when(rule == 0, "1.50").when(rule == 1, "1e3").when(rule == 2, "1E400").when(rule == 3, "-0").when(rule == 4, "1234567890" * 5)
         .when(rule == 5, json_quote(F.col("props"))).otherwise("null"))
    key = F.when(eid % 5 == 0, _json_text(F.col("user_id"), ".50")).otherwise(F.col("user_id").cast("string"))
    image = _json_text('{"id":', key, ',"v": ', n, ' ,"l":[', n, ',{"w":[]}]}')
    null = F.lit("null")
    return events.select(_json_text(
        '{ "x":', n, ', "before" : ', F.when(op.isin("u", "d"), image).otherwise(null), ',"x":"two","after":', F.when(op != "d", image).otherwise(null),
        ' ,"source":{"db":"d", "table":"t","pos":', eid, '},"op":"', op, '"} ').alias("value"))


def conversation_change_feed(conversations: DataFrame) -> DataFrame:
    """Document change envelopes (``value``) from ``conversations``."""
    cid = F.col("conv_id")
    m = cid % 4
    oid = F.lower(F.lpad(F.hex(cid), 24, "0"))
    dk = (
        F.when(m == 0, F.to_json(F.struct(cid.alias("_id"))))
        .when(m == 1, F.to_json(F.struct(F.concat(F.lit("c"), cid.cast("string")).alias("_id"))))
        .when(m == 2, F.to_json(F.struct(F.struct(oid.alias("$oid")).alias("_id"))))
    )
    envelope = F.struct(
        F.struct(F.concat_ws(":", cid.cast("string"), F.col("turn").cast("string")).alias("_data")).alias("_id"),
        F.lit("insert").alias("operationType"),
        F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("fullDocument"),
        F.struct(F.lit(DOC_DB).alias("db"), F.lit(DOC_COLL).alias("coll")).alias("ns"),
        dk.alias("documentKey"),  # NULL is dropped: the field is absent
        (cid * 100000 + F.col("turn")).alias("pos"),
    )
    return conversations.select(F.to_json(envelope).alias("value"))


def orders_snapshots(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, new) snapshots of ``orders``."""
    k = F.col("o_orderkey")
    old = orders.filter(k % 7 != 0)
    new = orders.filter(k % 5 != 0).withColumn(
        "o_orderstatus", F.when(k % 3 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    )
    return old, new


def orders_change_log(orders: DataFrame, spread_history: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(history, tail) of a change log for ``orders``.

    history: creates that built the old snapshot, position ``o_orderkey``;
    tail: the net changes from old to new, position ``10^12 + o_orderkey``.
    ``spread_history`` spreads the history's rows over so many tasks (it has no
    shuffle of its own); the tail is spread by its join.
    """
    old, new = orders_snapshots(orders)
    src = rebalance(old, spread_history)
    history = snapshot_events(src, ORDERS_DB, ORDERS_TABLE, position=F.col("o_orderkey"), op="c")
    tail = snapshot_diff(old, new, "o_orderkey", ORDERS_DB, ORDERS_TABLE,
                         position=F.col("__k") + F.lit(TAIL_POSITION_BASE))
    return history, tail.select("value", "op", "pos")


# Fixed values of the table that changes while it is loaded.
RACE_BASE = 10**12
RACE_SPAN = 400_000


def racing_orders(orders: DataFrame) -> DataFrame:
    """``orders`` with the log positions of their events: ``c_pos`` (during the load where
    ``o_orderkey % 7 = 0``, else long before), ``u_pos`` (``% 3``, sets status X), ``d_pos`` (``% 5``)."""
    k = F.col("o_orderkey")
    at = F.lit(RACE_BASE) + k * 7919 % RACE_SPAN
    return orders.withColumns({"c_pos": F.when(k % 7 == 0, at).otherwise(k), "u_pos": F.when(k % 3 == 0, at + RACE_SPAN // 8),
                               "d_pos": F.when(k % 5 == 0, at + RACE_SPAN // 4)})


_POSITIONS = ("c_pos", "u_pos", "d_pos")


def orders_as_of(orders: DataFrame, position: int) -> DataFrame:
    """The table of ``racing_orders`` as it was at a log position."""
    there = (F.col("c_pos") <= position) & ~F.coalesce(F.col("d_pos") <= position, F.lit(False))
    status = F.when(F.col("u_pos") <= position, F.lit("X")).otherwise(F.col("o_orderstatus"))
    return racing_orders(orders).filter(there).withColumn("o_orderstatus", status).drop(*_POSITIONS)


def orders_race_log(orders: DataFrame) -> DataFrame:
    """The log of ``racing_orders``: (value, pos)."""
    rows = racing_orders(orders)
    fields = image_columns(orders)
    old = F.struct(*fields)
    new = F.struct(*(F.lit("X").alias("o_orderstatus") if c == "o_orderstatus" else f for c, f in zip(orders.columns, fields)))
    none = F.lit(None).cast(rows.select(old.alias("r")).schema["r"].dataType)

    def events(op: str, before: Column, after: Column) -> DataFrame:
        pos = F.col(f"{op}_pos")
        source = F.struct(F.lit(ORDERS_DB).alias("db"), F.lit(ORDERS_TABLE).alias("table"), pos.alias("pos"))
        value = F.to_json(F.struct(before.alias("before"), after.alias("after"), source.alias("source"), F.lit(op).alias("op")), {"ignoreNullFields": "false"})
        return rows.filter(pos.isNotNull()).select(value.alias("value"), pos.alias("pos"))

    last = F.when(F.col("u_pos").isNotNull(), new).otherwise(old)
    return events("c", none, old).unionByName(events("u", old, new)).unionByName(events("d", last, none))


def events_feed_with_changes(events: DataFrame, every: int = 40) -> DataFrame:
    """The change feed of ``events``, and a schema change of its table at the position of every
    event whose ``event_id`` is divisible by ``every``."""
    eid = F.col("event_id")
    ddl = events.filter(eid % every == 0).select(_json_text(
        '{"source":{"db":"', EVENTS_DB_PREFIX, F.col("event_type"), '","table":"events","pos":', eid, '},"ddl":"ALTER TABLE events ADD COLUMN c_', eid, '"}').alias("value"))
    return events_change_feed(events).unionByName(ddl)


def orders_little_changed(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two snapshots that differ in some two per cent of all orders: by ``o_orderkey``, 1 in 97
    has another status in the new one, 1 in 193 is gone from it, 1 in 211 is only there."""
    key = F.col("o_orderkey")
    new = orders.filter(key % 193 != 0).withColumn("o_orderstatus", F.when(key % 97 == 0, "X").otherwise(F.col("o_orderstatus")))
    return orders.filter(key % 211 != 0), new
