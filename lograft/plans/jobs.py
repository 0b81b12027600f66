"""The job shapes: relational (MySQL / PostgreSQL / Oracle flavours) and
document (MongoDB flavour). Each is one DataFrame -> DataFrame chain, so
Catalyst sees a single plan, and the same chain serves batch and stream.
"""

from __future__ import annotations

import functools
from typing import Mapping, NamedTuple, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft import config as C
from lograft.operators.envelope import parse_document, parse_relational
from lograft.operators.filters import include_condition
from lograft.operators.route import route
from lograft.operators.spread import rebalance
from lograft.sources.snapshot import snapshot_records


class SnapshotTable(NamedTuple):
    """A table to load in full before its changes: typed rows and their names. Tables of
    sources whose include lists name schemas (PostgreSQL, Oracle) need theirs."""

    rows: DataFrame
    db: str
    table: str
    schema: str | None = None


def _included(source: C.RelationalSource, db="db", schema="schema", table="table"):
    """The condition of a source's include lists over names, the same for its feed and its snapshots."""
    by_schema = source.table_qualifier == "schema"
    return include_condition(source.databases, source.tables, source.schemas if by_schema else None, source.table_qualifier,
                             db_col=db, schema_col=schema, table_col=table)


def relational_job(
    feed: DataFrame,
    source: C.RelationalSource,
    target: C.KafkaTarget,
    value_col: str = "value",
    hash_method: str = "reflect",
    num_partitions: int | None = None,
) -> DataFrame:
    """Envelope text -> routed records with ``topic`` and ``partition``.

    ``num_partitions`` spreads a feed that one reader delivers (a single file or
    log partition) before the per-event work, in a batch or a stream."""
    only = _included(source)
    parsed = parse_relational(
        rebalance(feed, num_partitions), pk=source.pk, stringify=source.stringify, value_col=value_col,
        position_field=source.position_field, position_col=source.position_col, only=only,
    )
    return route(parsed, target, hash_method)


def document_job(
    feed: DataFrame,
    source: C.DocumentSource,
    target: C.KafkaTarget | None = None,
    value_col: str = "value",
    hash_method: str = "reflect",
    num_partitions: int | None = None,
) -> DataFrame:
    """Document envelope text -> routed records (``topic``/``partition`` only
    for a Kafka target; Kinesis routes by ``partition_key`` alone). Collection
    entries are ``db.collection`` names, matched like table entries."""
    only = include_condition(source.databases, source.collections)
    parsed = parse_document(rebalance(feed, num_partitions), value_col=value_col, position_field=source.position_field,
                            position_col=source.position_col, only=only)
    return route(parsed, target, hash_method) if target is not None else parsed


def snapshot_job(tables: Sequence[SnapshotTable], source: C.RelationalSource, target: C.KafkaTarget,
                 hash_method: str = "reflect") -> DataFrame:
    """Included tables as routed read events, from their typed columns; wall-clock
    times are read in the source's time zone. A table's names are constants, so one that
    is not included is not read: Spark folds its filter to an empty relation."""
    if source.table_qualifier == "schema" and (source.schemas is not None or source.tables is not None):
        nameless = [f"{t.db}.{t.table}" for t in tables if t.schema is None]
        if nameless:
            raise ValueError(f"include lists of {source.kind} name schemas; snapshot tables without one: {nameless}")

    def part(t: SnapshotTable) -> DataFrame:
        only = _included(source, F.lit(t.db), F.lit(t.schema).cast("string"), F.lit(t.table))
        return snapshot_records(t.rows if only is None else t.rows.filter(only), t.db, t.table, source.pk, source.stringify, source.time_zone,
                                schema=t.schema)

    return route(functools.reduce(DataFrame.unionByName, map(part, tables)), target, hash_method)


_RELATIONAL_GROUPS = {"mysql": C.GROUP_MYSQL, "oracle": C.GROUP_ORACLE, "postgres": C.GROUP_POSTGRES}


def jobs_from_properties(kind: str, groups: Mapping[str, Mapping[str, str]]):
    """(source config, sink config) for a job kind from named property groups."""
    if kind in _RELATIONAL_GROUPS:
        return (
            C.RelationalSource.from_properties(kind, groups[_RELATIONAL_GROUPS[kind]]),
            C.KafkaTarget.from_properties(groups[C.GROUP_KAFKA]),
        )
    if kind == "mongo":
        src = C.DocumentSource.from_properties(groups[C.GROUP_MONGO])
        if src.sink_target == "msk":
            return src, C.KafkaTarget.from_properties(groups[C.GROUP_KAFKA])
        return src, C.KinesisTarget.from_properties(groups[C.GROUP_KINESIS])
    raise ValueError(f"unknown job kind {kind!r}")


def start_job(
    spark,
    kind: str,
    groups: Mapping[str, Mapping[str, str]],
    feed: DataFrame,
    checkpoint_location: str,
    reject_path: str,
    output_path: str | None = None,
    snapshot: DataFrame | Sequence[SnapshotTable] | None = None,
    feed_now: DataFrame | None = None,
    num_partitions: int | None = None,
    kinesis_client_factory=None,
    fmt: str = "json",
    **trigger,
):
    """One call per job, like a job's ``main``: property groups in, running stream out.

    ``kind`` is ``mysql``, ``postgres``, ``oracle`` or ``mongo``; ``feed`` is a
    streaming DataFrame of envelope text (``read_feed`` / ``read_kafka_feed``).
    The sink follows the configuration: Kafka for relational jobs, Kafka or
    Kinesis for document jobs (``sinkTarget``). ``output_path`` writes ordered
    files instead of a message log. Events that cannot be routed are kept under
    ``reject_path``. ``trigger``: ``available_now=True`` or
    ``processing_time="10 seconds"``.

    The startup mode (``startupMode``, or ``copyExisting`` for documents) is obeyed:
    ``initial`` and ``snapshot`` load ``snapshot`` first: tables (``SnapshotTable``, read
    in the source's ``timeZone``) or a DataFrame of read-event envelopes. For
    ``initial`` and ``latest-offset``, a feed of files starts behind the files that it has
    at the first start, none of which is read; a message log is opened at the right
    offsets instead (``kafka_starting_offsets``). ``feed_now``, the same feed as a batch, asks
    for a hand-off by position: the feed is read for its highest one, and later
    files too start after it. ``snapshot`` mode returns None: the job is done when the load is. ``num_partitions`` spreads a feed that
    one reader delivers.
    """
    from lograft.sinks.select import make_sink
    from lograft.streaming.job import highest_routed, ordered_file_writer, sink_writer, start_after

    source, target = jobs_from_properties(kind, groups)
    kafka = target if isinstance(target, C.KafkaTarget) else None
    if kind == "mongo":
        def job(events: DataFrame) -> DataFrame:
            return document_job(events, source, kafka, num_partitions=num_partitions)
    else:
        def job(events: DataFrame) -> DataFrame:
            return relational_job(events, source, target, num_partitions=num_partitions)
    if output_path is not None:
        emit = ordered_file_writer(output_path, reject_path, fmt)
    else:
        emit = sink_writer(make_sink(
            source.sink_target if kind == "mongo" else "msk", kafka=kafka, kinesis=None if kafka else target,
            kinesis_client_factory=kinesis_client_factory, reject_path=f"{reject_path}/sink"), reject_path)
    loaded = None
    if snapshot is not None and source.startup_mode in ("initial", "snapshot"):
        loaded = job(snapshot) if isinstance(snapshot, DataFrame) else snapshot_job(snapshot, source, target)
    hand_off = None if feed_now is None else lambda: highest_routed(job, feed_now, position_col=source.position_col)
    return start_after(spark, source.startup_mode, emit, job, feed, f"lograft-{kind}", checkpoint_location, loaded, hand_off,
                       at_end=feed_now is None and "log_offset" not in feed.columns, **trigger)
