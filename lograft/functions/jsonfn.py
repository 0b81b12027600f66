"""JSON helpers: string quoting, JSON-type detection of VARIANT values, and the raw
text of fields, which keeps the spelling of numbers that a parser would change."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Levels that objects and arrays may be nested in one another inside a field's value.
DEPTH = 100

# Possessive throughout: a match is linear in the text and does not recurse over its length.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_ATOM = r'[^\[\]{}",:\s]++'


def _nested(levels: int) -> str:
    """Balanced brackets, strings inside them skipped. Text that is valid JSON is assumed."""
    flat = rf'[^\[\]{{}}"]++|{_STRING}'
    out = rf"[\[{{](?:{flat})*+[\]}}]"
    for _ in range(levels - 1):
        out = rf"[\[{{](?:{flat}|{out})*+[\]}}]"
    return out


# A field with the bracket or comma before it, right after the field before.
_FIELD = rf"(?s)\G\s*+[{{,]\s*+{_STRING}\s*+:\s*+(?:{_STRING}|{_nested(DEPTH)}|{_ATOM})"


def raw_fields(text: Column) -> Column:
    """The fields of a JSON object as they are written: each with the ``{`` or ``,`` before it,
    its name and its value, and no space behind. Put together they are the text up to its
    closing bracket, byte for byte (see ``raw_rest``). Repeated names are fields of their own.

    The text has to be valid JSON. Of an object with a value nested deeper than ``DEPTH``
    levels only the fields before it are found."""
    return F.regexp_extract_all(text, F.lit(_FIELD), F.lit(0))


def raw_rest(text: Column, fields: Column) -> Column:
    """What follows the fields: the closing bracket and spaces, if all fields were found."""
    return F.substr(text, F.length(F.array_join(fields, "")) + 1)


def raw_value(fields: Column, name: str) -> Column:
    """The value of the last of ``raw_fields`` with this name (spelled without escapes that
    JSON does not ask for), as it is written; NULL if there is none."""
    spelled = json.dumps(name, ensure_ascii=False).replace("\\E", "\\E\\\\E\\Q")
    head = rf"^\s*+[{{,]\s*+\Q{spelled}\E\s*+:\s*+"
    last = F.try_element_at(F.filter(fields, lambda f: f.rlike(head)), F.lit(-1))
    return F.regexp_replace(last, head, "")


def raw_compact(value: Column) -> Column:
    """Raw JSON without the spaces between its parts."""
    return F.regexp_replace(value, rf"(?s)({_STRING})|\s++", "$1")


def raw_only_element(value: Column) -> Column:
    """The raw scalar that is the only element of a raw array; NULL for everything else."""
    inner = F.regexp_extract(value, rf"(?s)^\[\s*+({_STRING}|{_ATOM})\s*+\]$", 1)
    return F.when(inner != "", inner)


def raw_text(value: Column) -> Column:
    """The content of a raw string; other raw values as they are."""
    content = F.get_json_object(F.concat(F.lit("["), value, F.lit("]")), "$[0]")
    return F.when(value.startswith('"'), content).otherwise(value)


def json_quote(s: Column) -> Column:
    """Render a string column as a JSON string literal, quotes included.

    Uses ``to_json`` on a one-field struct so escaping is Spark's JSON writer,
    then cuts the ``{"v":`` prefix and ``}`` suffix. Line and paragraph
    separators (U+2028, U+2029) are escaped too, so the text is also a valid
    JavaScript string. NULL stays NULL.
    """
    wrapped = F.to_json(F.named_struct(F.lit("v"), s))
    inner = wrapped.substr(F.lit(6), F.length(wrapped) - F.lit(6))
    out = F.replace(F.replace(inner, F.lit("\u2028"), F.lit("\\u2028")), F.lit("\u2029"), F.lit("\\u2029"))
    return F.when(s.isNotNull(), out)


def json_quote_compact(s: Column) -> Column:
    """``json_quote`` made cheap for text a JSON writer produced (e.g. a row
    image read back as a string field): without raw control characters,
    escaping backslash and quote (and U+2028 / U+2029) gives the same text
    as ``to_json``. Text that does hold a control character (a value that was
    a decoded JSON string) takes the general ``json_quote`` path.
    """
    esc = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    esc = F.replace(F.replace(esc, F.lit("\u2028"), F.lit("\\u2028")), F.lit("\u2029"), F.lit("\\u2029"))
    return F.when(s.rlike("[\\x00-\\x1f]"), json_quote(s)).otherwise(F.concat(F.lit('"'), esc, F.lit('"')))


def variant_kind(v: Column) -> Column:
    """JSON type of a VARIANT value: string, number, boolean, object, array, null.

    SQL NULL (field absent) gives NULL; a JSON ``null`` gives ``'null'``.
    """
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(v), F.lit("null"))
        .when(t == "STRING", F.lit("string"))
        .when(t == "BOOLEAN", F.lit("boolean"))
        .when(t.startswith("OBJECT"), F.lit("object"))
        .when(t.startswith("ARRAY"), F.lit("array"))
        .otherwise(F.lit("number"))
    )
