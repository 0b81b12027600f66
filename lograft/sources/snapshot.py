"""Full-load snapshots as change events (``op='r'``)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.functions.keys import KEY_NOT_SCALAR, KEY_NULL, key_string

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(c: Column, dtype: T.DataType, time_zone: str | None = None) -> Column:
    """Microseconds since the epoch for a timestamp column.

    A ``timestamp_ntz`` holds a wall-clock time of the source server; with
    ``time_zone`` it is read in that zone (``convert_timezone`` to UTC), else
    as UTC. A ``timestamp`` is already an instant. Independent of the session
    time zone.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    wall = F.convert_timezone(F.lit(time_zone), F.lit("UTC"), c) if time_zone else c
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), wall)


def image_columns(df: DataFrame, time_zone: str | None = None) -> list[Column]:
    """Row-image columns: timestamps as epoch microseconds, the rest unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = epoch_micros(c, f.dataType, time_zone)
        out.append(c.alias(f.name))
    return out


def snapshot_events(
    df: DataFrame,
    db: str | Column,
    table: str | Column,
    time_zone: str | None = None,
    position: Column | None = None,
    ts_ms: Column | None = None,
    op: str = "r",
) -> DataFrame:
    """Every row of a table as a read event (``op='r'``, ``before`` null).

    ``op='c'`` gives create events instead, e.g. to replay a table into a log.

    Narrow transformation only: the scan's partitioning (file splits, or JDBC
    ranges from ``read_jdbc_snapshot``) carries straight through.
    Output: ``value`` (JSON envelope) and typed ``op``/``pos``.
    """
    dbc = db if isinstance(db, Column) else F.lit(db)
    tc = table if isinstance(table, Column) else F.lit(table)
    pos = (position if position is not None else F.lit(None)).cast("bigint")
    after = F.struct(*image_columns(df, time_zone))
    envelope = F.struct(
        F.lit(None).cast("string").alias("before"),
        after.alias("after"),
        F.struct(dbc.alias("db"), tc.alias("table"), pos.alias("pos")).alias("source"),
        F.lit(op).alias("op"),
        (ts_ms if ts_ms is not None else F.lit(None).cast("bigint")).alias("ts_ms"),
    )
    return df.select(
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"),
        F.lit(op).alias("op"),
        pos.alias("pos"),
    )


def _typed_key(df: DataFrame, pk: str) -> tuple[Column, Column]:
    """A key column's text, as its JSON text would be, and a reject reason."""
    kind = {f.name: f.dataType for f in df.schema.fields}[pk]
    c = F.col(f"`{pk}`")
    reason = F.when(c.isNull(), F.lit(KEY_NULL))
    if isinstance(kind, (T.StringType, T.IntegralType, T.BooleanType)):
        return c.cast("string"), reason
    if isinstance(kind, T.NumericType):
        written = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), '^\\{"v":"?(.*?)"?\\}$', 1)
        return F.when(c.isNotNull(), written), reason
    return F.lit(None).cast("string"), reason.otherwise(F.lit(KEY_NOT_SCALAR))


def snapshot_records(
    df: DataFrame,
    db: str,
    table: str,
    pk: str,
    stringify: bool = False,
    time_zone: str | None = None,
    position: Column | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Every row of a table as a routed read event, straight from its typed columns.

    The same records as ``parse_relational(snapshot_events(...))``, without writing
    each row as JSON and reading it again: names and position are known, the key
    is a column, and JSON is only written, for ``value``. Narrow. ``schema``: named in the
    envelope's source, as the feeds of databases with schemas do.
    """
    pos = (position if position is not None else F.lit(None)).cast("bigint")
    key, reason = _typed_key(df, pk)
    image = F.struct(*image_columns(df, time_zone))
    names = [F.lit(db).alias("db"), *([F.lit(schema).alias("schema")] if schema is not None else []), F.lit(table).alias("table")]

    def envelope(after: Column) -> Column:
        return F.to_json(F.struct(
            F.lit(None).cast("string").alias("before"), after.alias("after"),
            F.struct(*names, pos.alias("pos")).alias("source"),
            F.lit("r").alias("op"), F.lit(None).cast("bigint").alias("ts_ms")), {"ignoreNullFields": "false"})

    as_is = envelope(image)
    text = F.when(reason.isNull(), envelope(F.to_json(image, {"ignoreNullFields": "false"}))).otherwise(as_is) if stringify else as_is
    return df.select(
        F.lit(db).alias("db"), F.lit(table).alias("table"), F.lit("r").alias("op"), pos.alias("pos"), F.lit("row").alias("event_kind"),
        F.when(reason.isNull(), key_string(F.lit(db), F.lit(table), key)).alias("partition_key"),
        text.alias("value"), reason.alias("reject_reason"))


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Snapshot scan split into ``num_partitions`` range reads on a numeric
    column; each task reads one key range, so the scan scales with executors
    rather than one connection. Size ranges so one fits a task's memory; tiny
    chunks only add round trips.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=dict(properties or {}),
    )
