"""Column expressions (no DataFrame in, no DataFrame out).

Everything here builds ``pyspark.sql.Column`` objects from built-in
functions so Catalyst can fold them into one projection.
"""

from lograft.functions.jsonfn import json_quote, variant_kind
from lograft.functions.keys import key_string, scalar_key_text
from lograft.functions.topics import fixed_topic, topic_for_database
from lograft.functions.hashing import java_string_hash, key_partition
from lograft.functions.encoding import to_bytes

__all__ = [
    "json_quote",
    "variant_kind",
    "key_string",
    "scalar_key_text",
    "fixed_topic",
    "topic_for_database",
    "java_string_hash",
    "key_partition",
    "to_bytes",
]
