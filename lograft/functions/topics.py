"""Topic names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lograft.config import DEFAULT_TOPIC_PREFIX


def topic_for_database(db: Column, prefix: str | None = None) -> Column:
    """Per-database topic: prefix + lower-cased name with '_' turned into '-'.

    An empty or missing prefix means the default ``cdc-``.
    """
    return F.concat(F.lit(prefix or DEFAULT_TOPIC_PREFIX), F.translate(F.lower(db), "_", "-"))


def fixed_topic(topic: str) -> Column:
    return F.lit(topic)
