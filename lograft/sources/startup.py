"""Startup modes: where reading begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("initial", "earliest-offset", "latest-offset", "snapshot")


def highest_position(changes: DataFrame, position: str = "pos") -> Column:
    """Highest position in a (batch) feed, as a scalar subquery column.

    Take it *before* scanning the snapshot: events racing the scan are then
    delivered twice (harmless for keyed upserts) rather than lost.
    """
    return changes.select(F.max(position)).scalar()


def after_position(df: DataFrame, start: Column | int, position: str = "pos") -> DataFrame:
    """Events after a position. Those without one (unreadable text, schema changes)
    cannot be placed: they pass, to the output or the rejects, and may arrive
    twice but never get lost."""
    start = start if isinstance(start, Column) else F.lit(start)
    at = F.col(position)
    return df.filter(at.isNull() | start.isNull() | (at > start))


def startup(
    mode: str,
    snapshot: DataFrame | None = None,
    changes: DataFrame | None = None,
    start_position: Column | int | None = None,
    position: str = "pos",
) -> DataFrame:
    """Events a job emits for a startup mode.

    ``initial``          snapshot read events, then changes after the hand-off position
    ``earliest-offset``  every change in the feed, no snapshot
    ``latest-offset``    only changes after the position at start
    ``snapshot``         snapshot read events only

    ``snapshot`` and ``changes`` carry the same columns (``value``, ``op``,
    ``pos``, ...). For Kafka feeds ``earliest``/``latest`` map to the
    ``startingOffsets`` option of ``read_kafka_feed`` instead.
    """
    if mode not in MODES:
        raise ValueError(f"unknown startup mode {mode!r}; expected one of {MODES}")

    def need(df, what):
        if df is None:
            raise ValueError(f"startup mode {mode!r} needs {what}")
        return df

    def after_start(df: DataFrame) -> DataFrame:
        if start_position is None:
            raise ValueError(f"startup mode {mode!r} needs start_position")
        sp = start_position if isinstance(start_position, Column) else F.lit(start_position)
        return after_position(df, sp, position)

    if mode == "snapshot":
        return need(snapshot, "a snapshot")
    if mode == "earliest-offset":
        return need(changes, "a change feed")
    if mode == "latest-offset":
        return after_start(need(changes, "a change feed"))
    return need(snapshot, "a snapshot").unionByName(after_start(need(changes, "a change feed")))


def kafka_starting_offsets(mode: str, hand_off_offsets: str | None = None) -> str | None:
    """``startingOffsets`` for ``read_kafka_feed`` under a startup mode.

    ``earliest-offset`` reads the whole log, ``latest-offset`` only what
    arrives after start, ``snapshot`` reads no log at all (``None``).
    ``initial`` streams from the end offsets recorded *before* the snapshot
    scan (a JSON map ``{"topic": {"0": 42, ...}}``), so changes that race the
    scan arrive twice rather than never. They are required: starting at
    ``latest`` instead would lose such changes.
    """
    if mode not in MODES:
        raise ValueError(f"unknown startup mode {mode!r}; expected one of {MODES}")
    if mode == "initial" and not hand_off_offsets:
        raise ValueError("startup mode 'initial' needs the offsets recorded before the snapshot scan")
    return {
        "earliest-offset": "earliest",
        "latest-offset": "latest",
        "snapshot": None,
        "initial": hand_off_offsets,
    }[mode]
