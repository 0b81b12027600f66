"""Recommended session settings for routing jobs."""

from __future__ import annotations


#: Shuffled bytes that one task sorts in memory.
TASK_BYTES = 128 << 20


def recommended_conf(cores: int | None = None, shuffle_bytes: int | None = None) -> dict[str, str]:
    """Settings the jobs are tuned for; apply with ``builder.config(k, v)``.

    * AQE re-plans joins at run time and splits skewed join partitions.
    * ``dataFrameDebugging`` off: no Python call-site capture per column
      function, which speeds up building the parse plan noticeably.
    * ``shuffle.partitions``: by the volume of the largest shuffle, ``TASK_BYTES`` a
      task, and at least one per core. The number of cores alone says nothing about
      the size of a task; AQE merges partitions that turn out small.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if cores or shuffle_bytes:
        conf["spark.sql.shuffle.partitions"] = str(max(cores or 1, -(-(shuffle_bytes or 0) // TASK_BYTES)))
    return conf
