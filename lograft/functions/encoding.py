"""Text to bytes for sink records."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_bytes(col: Column) -> Column:
    """UTF-8 bytes of a string column (charset pinned, not the platform default)."""
    return F.encode(col, "UTF-8")
