"""Continuous jobs: stream in, transform, write ordered per key.

The transform chain is stateless (no watermark, append only); per-key order
and exactly-once file output are handled per micro-batch in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lograft.operators.envelope import split_rejects, unheld_rejects
from lograft.operators.order import order_by_key
from lograft.operators.spread import hold_packed
from lograft.sinks.files import require_reject_path, write_batch_files
from lograft.sources.chunked import after_waves, merge_raced, raced_events, read_in_waves, read_waves
from lograft.sources.splits import Point
from lograft.sources.startup import MODES, after_position

SNAPSHOT_BATCH = "snapshot"
CHECKPOINT_CONF = "spark.checkpoint.dir"


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            root = None
    return root


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    root = configured_checkpoint_dir(spark)
    if not root:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; jobs need a shared checkpoint folder")
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when unset (tests)."""
    root = configured_checkpoint_dir(spark)
    if not root:
        spark.conf.set(CHECKPOINT_CONF, fallback)
        try:
            spark.sparkContext.setCheckpointDir(fallback)
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            pass
        root = fallback
    return root.rstrip("/")


Emit = Callable[[DataFrame, "int | str"], None]


def ordered_file_writer(
    output_path: str,
    reject_path: str,
    fmt: str = "json",
    num_partitions: int | None = None,
) -> Emit:
    """Writes a batch as files, ordered per key; the batch ``snapshot`` as it comes
    (it has each key once)."""
    require_reject_path(reject_path)

    def write(batch: DataFrame, batch_id: int | str) -> None:
        write_batch_files(batch, output_path, reject_path, batch_id, fmt, num_partitions,
                          strategy=None if batch_id == SNAPSHOT_BATCH else "range")

    return write


def sink_writer(writer: Emit, reject_path: str, num_partitions: int | None = None) -> Emit:
    """Hands a batch to ``writer`` (``make_sink``), ordered per key, and writes rejects."""
    require_reject_path(reject_path)

    def write(batch: DataFrame, batch_id: int | str) -> None:
        alone = batch_id == SNAPSHOT_BATCH
        held, kept = (None, batch) if alone else hold_packed(batch)
        try:
            good, bad = split_rejects(kept)
            if held is None:
                bad = unheld_rejects(kept)
            writer(good if alone else order_by_key(good, num_partitions, strategy="hash"), batch_id)
            bad.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
        finally:
            if held is not None:
                held.unpersist()

    return write


def _start(routed_stream: DataFrame, name: str, emit: Emit, checkpoint_location: str,
           available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start a routed stream. ``checkpoint_location`` holds source offsets and the last
    committed batch, so a restarted job resumes without gaps."""
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required")
    w = routed_stream.writeStream.queryName(name).option("checkpointLocation", checkpoint_location).foreachBatch(emit)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def start_file_job(
    routed_stream: DataFrame,
    name: str,
    output_path: str,
    reject_path: str,
    checkpoint_location: str,
    available_now: bool = False,
    processing_time: str | None = None,
    num_partitions: int | None = None,
    fmt: str = "json",
) -> StreamingQuery:
    """Start a routed stream into ordered, idempotent file output."""
    emit = ordered_file_writer(output_path, reject_path, fmt, num_partitions)
    return _start(routed_stream, name, emit, checkpoint_location, available_now, processing_time)


def start_sink_job(
    routed_stream: DataFrame,
    name: str,
    writer: Emit,
    checkpoint_location: str,
    reject_path: str,
    available_now: bool = False,
    processing_time: str | None = None,
    num_partitions: int | None = None,
) -> StreamingQuery:
    """Start a routed stream into a message-log writer (``make_sink``).

    Each micro-batch is ordered per key (``hash``: one writer task per key)
    and handed to ``writer`` with its id; rejects go to ``reject_path``. Delivery is
    at-least-once: a batch replayed after a failure is written again. Bound
    micro-batches on the source (``maxFilesPerTrigger`` /
    ``maxOffsetsPerTrigger``) so a hot key's share of one task stays bounded.
    """
    return _start(routed_stream, name, sink_writer(writer, reject_path, num_partitions), checkpoint_location,
                  available_now, processing_time)


def _marker(spark: SparkSession, path: str) -> tuple[bool, int | None]:
    """Whether the start was recorded before, and the position noted then."""
    try:
        row = spark.read.schema("hand_off bigint").json(path).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False, None
    return row is not None, row.hand_off if row is not None else None


def _mark(spark: SparkSession, path: str, at: int | None) -> None:
    row = spark.range(1).select(F.lit(at).cast("bigint").alias("hand_off"))
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def skip_to_end(feed_stream: DataFrame, checkpoint_location: str) -> None:
    """Commit all that a feed holds now to a stream's checkpoint, without reading it: a
    stream that starts from there begins behind it.

    The source lists its files (or asks for its end offsets) and writes them to its offset
    log; the batches themselves are never run, so no file is opened and no event parsed.
    """
    q = (feed_stream.writeStream.option("checkpointLocation", checkpoint_location).trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: None).start())
    q.awaitTermination()


def start_after(
    spark: SparkSession,
    mode: str,
    emit: Emit,
    job: Callable[[DataFrame], DataFrame],
    feed_stream: DataFrame,
    name: str,
    checkpoint_location: str,
    snapshot: DataFrame | None = None,
    hand_off: Callable[[], int | None] | None = None,
    position: str = "pos",
    at_end: bool = False,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery | None:
    """Start a stream by startup mode. ``snapshot`` holds routed records.

    ``earliest-offset``  the whole feed
    ``latest-offset``    events after the position ``hand_off()`` gives at the first start
    ``snapshot``         the snapshot only; no stream, the result is None
    ``initial``          notes ``hand_off()`` *before* the snapshot scan, writes the
                         snapshot, then streams what comes after the hand-off

    ``at_end`` takes the feed's own offsets instead of a position: what the feed holds at the
    first start is passed over in the stream's checkpoint (``skip_to_end``), before the
    snapshot is read and without reading an event. ``hand_off=None`` without it says
    that the feed begins at the right place itself (a message log opened at offsets
    recorded before the scan). Events that race the scan arrive twice,
    never not at all; so do events without a position (``after_position``). The start
    is recorded next to the stream checkpoint: a restarted job resumes the stream
    and neither writes the snapshot again nor moves the hand-off.
    """
    if mode not in MODES:
        raise ValueError(f"unknown startup mode {mode!r}; expected one of {MODES}")
    if mode in ("initial", "snapshot") and snapshot is None:
        raise ValueError(f"startup mode {mode!r} needs a snapshot")
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required")
    routed = job(feed_stream)
    if mode != "earliest-offset":
        marker = f"{checkpoint_location.rstrip('/')}_hand_off"
        known, at = _marker(spark, marker)
        if not known:
            at = hand_off() if hand_off is not None and mode != "snapshot" else None
            if at_end and mode != "snapshot":
                skip_to_end(feed_stream, checkpoint_location)
            if mode != "latest-offset":
                emit(snapshot, SNAPSHOT_BATCH)
            _mark(spark, marker, at)
        if mode == "snapshot":
            return None
        if hand_off is not None:
            routed = after_position(routed, F.lit(at).cast("bigint"), position)
    return _start(routed, name, emit, checkpoint_location, available_now, processing_time)


def highest_routed(job: Callable[[DataFrame], DataFrame], feed_now: DataFrame, position: str = "pos",
                   position_col: str | None = None) -> int | None:
    """The highest position of a feed: one number. Read from the log's own column where
    there is one, without parsing an event."""
    rows = feed_now.select(F.col(position_col).cast("bigint").alias(position)) if position_col else job(feed_now)
    return rows.agg(F.max(position).alias("m")).first().m


def start_initial_job(
    spark: SparkSession,
    job: Callable[[DataFrame], DataFrame],
    snapshot: DataFrame,
    feed_now: DataFrame,
    feed_stream: DataFrame,
    name: str,
    output_path: str,
    reject_path: str,
    checkpoint_location: str,
    position: str = "pos",
    fmt: str = "json",
    num_partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Startup mode ``initial`` into files: ``snapshot`` (envelopes) through ``job``,
    then the changes of ``feed_stream`` after the highest position of ``feed_now``."""
    emit = ordered_file_writer(output_path, reject_path, fmt, num_partitions)
    return start_after(spark, "initial", emit, job, feed_stream, name, checkpoint_location, job(snapshot),
                       lambda: highest_routed(job, feed_now, position), position, **trigger)


def start_chunked_job(
    spark: SparkSession,
    emit: Emit,
    job: Callable[[DataFrame], DataFrame],
    records: Callable[[DataFrame], DataFrame],
    read: Callable[[list[str]], DataFrame],
    db: str,
    table: str,
    key: str,
    kind: T.DataType,
    points: Sequence[Point],
    waves: int,
    position_now: Callable[[], int],
    feed_between: Callable[[int, int], DataFrame],
    feed_stream: DataFrame,
    name: str,
    checkpoint_location: str,
    route_load: Callable[[DataFrame], DataFrame] = lambda records: records,
    at_end: bool = True,
    quote: str = '"',
    **trigger,
) -> StreamingQuery:
    """Startup mode ``initial`` for a table that changes while it is loaded: the load gives
    each key once, and the stream goes on behind it with no event twice (``sources.chunked``).

    ``read`` and ``position_now`` as in ``read_in_waves``; ``records`` makes routed records of
    the rows read (``snapshot_records``) and ``route_load`` routes the load (``route``);
    ``feed_between(low, high)`` is the feed as a batch, with at least the events after
    ``low`` up to ``high``. ``at_end`` passes over, unread, what
    the feed stream holds before the first wave (``skip_to_end``): it is in the rows read.
    Waves, load and hand-off are recorded next to the checkpoint: a restart repeats none that
    is done, and then resumes the stream.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required")
    base = f"{checkpoint_location.rstrip('/')}_load"
    begun, _ = _marker(spark, f"{base}/begun")
    if not begun:
        if at_end:
            skip_to_end(feed_stream, checkpoint_location)
        _mark(spark, f"{base}/begun", None)
    done = read_in_waves(spark, read, key, points, waves, position_now, f"{base}/waves", quote)
    loaded, _ = _marker(spark, f"{base}/done")
    if not loaded:
        rows = read_waves(spark, f"{base}/waves", done, records)
        # The feed is parsed once: the load is written in two passes, and each reads what raced it twice.
        raced = raced_events(job(feed_between(done[0].low, done[-1].high)), db, table, kind, points, done)
        raced.write.mode("overwrite").parquet(f"{base}/raced")
        last = spark.read.schema(raced.schema).parquet(f"{base}/raced")
        emit(route_load(merge_raced(rows, last, db, table, done)), SNAPSHOT_BATCH)
        _mark(spark, f"{base}/done", done[-1].high)
    return _start(after_waves(job(feed_stream), db, table, kind, points, done), name, emit, checkpoint_location, **trigger)
