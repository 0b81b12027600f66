"""Key derivation: relational key text, document key JSON, key strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lograft.config import NO_PK
from lograft.functions.jsonfn import json_quote, raw_compact, raw_text

# Reject reasons (stable strings, used as values of ``reject_reason``).
KEY_MISSING = "key_missing"
KEY_NULL = "key_null"
KEY_NOT_SCALAR = "key_not_scalar"
DOC_KEY_NOT_STRING = "document_key_not_string"
DOC_KEY_NOT_OBJECT = "document_key_not_object"

# Text that a JSON parser may have made of a number spelled otherwise (1.50, 1e3, -0, 1E400).
MAYBE_RESPELLED = '^-?[0-9]+[.eE]|^0$|^"?-?Infinity|^"?NaN'


def scalar_key_text(raw: Column, only: Column) -> tuple[Column, Column]:
    """Text of a scalar key given as raw JSON, plus a reject reason.

    Strings give their content, numbers and booleans their text as it is written:
    another spelling would be another key and partition. ``only`` is the raw scalar that is
    the only element of an array (``raw_only_element``), which counts like that scalar.
    Absent, null, object and other array values give a NULL key and a reason.
    """
    scalar = F.when(raw.rlike(r"^[\[{]"), F.when(only != "null", only)).otherwise(raw)
    reason = (
        F.when(raw.isNull(), F.lit(KEY_MISSING))
        .when(raw == "null", F.lit(KEY_NULL))
        .when(scalar.isNull(), F.lit(KEY_NOT_SCALAR))
    )
    return F.when(reason.isNull(), raw_text(scalar)), reason


def document_key_parts(dk_kind: Column, dk_parsed_kind: Column, raw_id: Column) -> tuple[Column, Column]:
    """Key text and reject reason of a document change from precomputed parts: the JSON
    type of ``documentKey``, the JSON type of its parsed text, and its raw ``_id``.

    Strings keep their quotes, numbers their spelling, objects and arrays the order and
    spelling of what they hold; only spaces between their parts go.
    """
    id_text = F.when(raw_id.startswith('"'), json_quote(raw_text(raw_id))).otherwise(raw_compact(raw_id))
    no_key = dk_kind.isNull() | (dk_kind == "null")
    reason = (
        F.when(no_key, F.lit(None).cast("string"))
        .when(dk_kind != "string", F.lit(DOC_KEY_NOT_STRING))
        .when(dk_parsed_kind.isNull() | (dk_parsed_kind != "object"), F.lit(DOC_KEY_NOT_OBJECT))
        .when(raw_id.isNull(), F.lit(KEY_MISSING))
    )
    key = F.when(no_key, F.lit(NO_PK)).otherwise(id_text)
    return F.when(reason.isNull(), key), reason


def key_string(db: Column, table: Column, pk: Column) -> Column:
    """``db.table.pk``; NULL when any part is NULL (never the text 'null')."""
    return F.concat(db, F.lit("."), table, F.lit("."), pk)
