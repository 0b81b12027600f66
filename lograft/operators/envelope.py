"""Parse change envelopes into routed records.

A routed record has ``db``, ``table``, ``partition_key`` and ``value`` (all
strings) plus ``op``, ``pos`` (source position, for ordering), ``event_kind``
(``row`` or ``schema``) and ``reject_reason`` (NULL for good rows). Rows that
cannot be keyed are never dropped and never fail the job: they carry a reason
and ``split_rejects`` sends them to a reject table.

Each event is parsed once with ``from_json`` and a fixed schema holding only
the fields the routing needs. Where the spelling of the text counts (images that go
out as JSON strings, keys that a parser may respell), the raw text of fields is cut out
of the event (``raw_fields``), so numbers, repeated names and spaces stay as they came.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.config import NO_PK, NO_TABLE
from lograft.functions.jsonfn import json_quote_compact, raw_fields, raw_only_element, raw_rest, raw_value, variant_kind
from lograft.functions.keys import MAYBE_RESPELLED, document_key_parts, key_string, scalar_key_text

# Reject reasons (stable strings).
NOT_JSON = "not_json"
DB_MISSING = "db_missing"
TABLE_MISSING = "table_missing"
IMAGE_MISSING = "image_missing"
POSITION_INVALID = "position_invalid"
TOO_DEEP = "too_deep"

_CORRUPT = "_corrupt_record"
# JSON and nothing looser: the raw text of fields is only looked for in JSON.
_PARSE_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

ROUTED_COLUMNS = ("db", "table", "op", "pos", "event_kind", "partition_key", "value", "reject_reason")

# Root fields of the relational envelope, in envelope order.
RELATIONAL_FIELDS = ("before", "after", "source", "op", "ts_ms", "transaction")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _source_struct(position_field: str) -> str:
    fields = "".join(f", {_q(f)}: string" for f in position_field.split(","))
    return f"struct<db: string, `schema`: string, `table`: string{fields}>"


#: Positions below this number fit in one log file when a position has two fields.
LOG_FILE_SPAN = 1 << 40


def _position_text(position_field: str, read) -> Column:
    """The position's text: one field, or ``file,offset`` (a log file name that ends
    in its number, and the offset in it) combined to one growing number."""
    fields = position_field.split(",")
    if len(fields) == 1:
        return read(fields[0])
    if len(fields) > 2:
        raise ValueError(f"a position has one or two fields, not {position_field!r}")
    number = F.try_to_number(F.regexp_extract(read(fields[0]), "([0-9]+)$", 1), F.lit("9" * 18)).cast("bigint")
    offset = read(fields[1]).try_cast("bigint")
    given = F.when(read(fields[0]).isNotNull() | read(fields[1]).isNotNull(), F.concat_ws(",", read(fields[0]), read(fields[1])))
    return F.coalesce((number * LOG_FILE_SPAN + offset).cast("string"), given)


def _counted(df: DataFrame, kind: str) -> DataFrame:
    """All events before a filter on their names. Also the planning boundary
    that keeps the filter above the parse (see ``_observed``)."""
    return df.observe(f"lograft_{kind}_read_{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("events"))


def _observed(df: DataFrame, kind: str) -> DataFrame:
    """End the parse with ``observe``: per-query counts of events and rejects
    (streaming progress reports them per micro-batch).

    It is also a planning boundary: the optimizer does not push filters
    through it, so a filter on parsed fields (include lists, rejects) stays
    above the parse instead of being rewritten in terms of ``from_json`` and
    parsing every event a second time.
    """
    return df.observe(
        f"lograft_{kind}_{uuid.uuid4().hex[:12]}",
        F.count(F.lit(1)).alias("events"),
        F.count(F.col("reject_reason")).alias("rejects"),
    )


def _key_text_stages(keep: list[str], pk: str) -> list[list[Column]]:
    """Stages adding ``__pk`` (key text) and ``__kr`` (key reject reason) from ``__raw``.

    ``__raw`` is the key read as a JSON *string* field: the right text for strings,
    integers and booleans in the one parse. Only when it is NULL, starts like an object or
    array (``{``, ``[``) or may be a number spelled otherwise is it ambiguous; for those
    rows alone the key's raw text is cut out of the event, step by step, and decides.
    """
    raw, v = F.col("__raw"), F.col("__v")
    kept = [F.col(c) for c in keep]
    amb = (raw.isNull() | raw.startswith("{") | raw.startswith("[") | raw.rlike(MAYBE_RESPELLED)).alias("__amb")
    a, text, only = F.col("__amb"), F.col("__kt"), F.col("__ko")
    fields = F.col("__kf")
    image = F.when(F.col("__op") == "d", raw_value(fields, "before")).otherwise(raw_value(fields, "after"))
    key_text, reason = scalar_key_text(text, only)
    return [
        [*kept, raw, amb],
        [*kept, raw, a, F.when(a, raw_fields(v)).alias("__kf")],
        [*kept, raw, a, F.when(a, image).alias("__ki")],
        [*kept, raw, a, F.when(a, raw_value(raw_fields(F.col("__ki")), pk)).alias("__kt")],
        [*kept, raw, a, text, F.when(a, raw_only_element(text)).alias("__ko")],
        [*kept, F.when(~a, raw).otherwise(key_text).alias("__pk"), F.when(a, reason).alias("__kr")],
    ]


def _gateway_id() -> int:
    from pyspark import SparkContext

    return id(SparkContext._gateway)


def parse_relational(
    df: DataFrame,
    pk: str = "id",
    stringify: bool = False,
    value_col: str = "value",
    position_field: str = "pos",
    position_col: str | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Relational (insert / update / delete) envelopes to routed records.

    * ``db``/``table`` from ``source.db``/``source.table``; ``op`` from ``op``.
    * Key: ``pk`` of ``before`` for deletes, of ``after`` for everything else,
      as text; key string ``db.table.pk``.
    * Events without ``op`` are schema changes: they pass with
      ``event_kind='schema'`` and key ``db.table.no_pk`` (``no_table`` when the
      table is absent).
    * ``pos`` from ``source.<position_field>`` (``file,offset`` for a log file name
      and an offset), or from the column ``position_col`` of ``df`` (the offset of a
      message log). A position that is no integer is a reject, not a failure.
    * ``stringify``: ``before``/``after`` objects become JSON strings that hold their
      raw text; all else of the event stays byte for byte. Otherwise, and for rejects
      and schema changes, ``value`` is the input. An event with a value nested deeper than
      ``DEPTH`` levels cannot be rewritten and is a reject (``too_deep``).
    * Keys are read as they are written: ``1.50`` and ``1.5`` are two keys. Of a field that
      is there twice, the last one counts.
    * ``only``: a condition over ``db``, ``schema`` and ``table`` (see
      ``include_condition``). Events it is false for are dropped right after their
      names are read, before any key or text work.

    Built as a few narrow projections, each expensive expression referenced
    once, so everything after ``from_json`` (a codegen-fallback expression)
    compiles into one whole-stage-codegen stage.
    """
    out = df
    stages, names_read = _relational_stages(_gateway_id(), pk, stringify, value_col, position_field, position_col)
    for i, cols in enumerate(stages):
        out = out.select(*cols)
        if i == names_read and only is not None:
            named = _counted(out, "relational").withColumns(
                {"db": F.col("__db"), "schema": F.col("__schema"), "table": F.col("__table")})
            out = named.filter(only).drop("db", "schema", "table")
    return _observed(out, "relational")


@functools.lru_cache(maxsize=64)
def _relational_stages(_gateway: int, pk: str, stringify: bool, value_col: str, position_field: str,
                       position_col: str | None) -> tuple[tuple[list[Column], ...], int]:
    """Column lists of the parse stages, and the stage after which the names are
    known. They refer to columns by name only, so they are built once per
    configuration (and JVM) and reused."""
    v = F.col(value_col)
    src_t = _source_struct(position_field)
    carried = F.lit(None).cast("string") if position_col is None else F.col(position_col).cast("string")
    first = [v.alias("__v"), carried.alias("__log_pos")]
    stages: list[list[Column]] = []
    names = [F.col(c) for c in ("__v", "__log_pos", "__db", "__schema", "__table", "__src_pos")]

    def source_columns(src: Column) -> list[Column]:
        return [src["db"].alias("__db"), src["schema"].alias("__schema"), src["table"].alias("__table"),
                _position_text(position_field, lambda f: src[f]).alias("__src_pos")]

    img = f"struct<{_q(pk)}: string>"
    schema = f"before {img}, after {img}, source {src_t}, op string, {_CORRUPT} string"
    stages.append([*first, F.from_json(v, schema, _PARSE_OPTS).alias("__e")])
    e = F.col("__e")
    stages.append([F.col("__v"), F.col("__log_pos"), e, *source_columns(e["source"])])
    names_read = len(stages) - 1
    is_delete = e["op"] == "d"
    stages.append([
        *names, e["op"].alias("__op"), (e.isNull() | e[_CORRUPT].isNotNull()).alias("__bad"),
        F.when(is_delete, e["before"].isNull()).otherwise(e["after"].isNull()).alias("__img_null"),
        F.when(is_delete, e["before"][pk]).otherwise(e["after"][pk]).alias("__raw"),
    ])

    # Key text and key-level reject reason.
    keep = ["__v", "__log_pos", "__db", "__schema", "__table", "__src_pos", "__op", "__bad", "__img_null"]
    stages.extend(_key_text_stages(keep, pk))

    db, table, op, bad = F.col("__db"), F.col("__table"), F.col("__op"), F.col("__bad")
    is_schema = op.isNull()
    pos_text = F.coalesce("__log_pos", "__src_pos")
    stages.append([F.col("*"), pos_text.try_cast("bigint").alias("__pos"), pos_text.isNotNull().alias("__has_pos")])
    stages.append([
        F.col("*"),
        (
            F.when(bad, F.lit(NOT_JSON))
            .when(db.isNull(), F.lit(DB_MISSING))
            .when(F.col("__has_pos") & F.col("__pos").isNull(), F.lit(POSITION_INVALID))
            .when(is_schema, F.lit(None).cast("string"))
            .when(table.isNull(), F.lit(TABLE_MISSING))
            .when(F.col("__img_null"), F.lit(IMAGE_MISSING))
            .otherwise(F.col("__kr"))
        ).alias("__reason"),
    ])
    reason = F.col("__reason")
    pkey = F.when(is_schema, key_string(db, F.coalesce(table, F.lit(NO_TABLE)), F.lit(NO_PK))).otherwise(
        key_string(db, table, F.col("__pk")))
    out_value = F.col("__v")
    if stringify:
        # Schema changes carry no row images, rejects stay as they came.
        fields, rest = F.col("__f"), F.col("__rest")
        stages.append([F.col("*"), F.when(~is_schema & reason.isNull(), raw_fields(F.col("__v"))).alias("__f")])
        stages.append([F.col("*"), raw_rest(F.col("__v"), fields).alias("__rest")])
        unread = F.when(fields.isNull() | rest.rlike(r"^\s*\}\s*$"), reason).when(rest.rlike(r"^\s*\}"), F.lit(NOT_JSON)).otherwise(F.lit(TOO_DEEP))
        others = [c for c in (*keep, "__pk", "__kr", "__pos", "__has_pos")]
        stages.append([*(F.col(c) for c in others), fields, rest, unread.alias("__reason")])
        out_value = F.when(fields.isNull() | reason.isNotNull(), out_value).otherwise(
            F.concat(F.array_join(F.transform(fields, _with_quoted_image), ""), rest))
    stages.append([
        db.alias("db"),
        table.alias("table"),
        op.alias("op"),
        F.col("__pos").alias("pos"),
        F.when(is_schema & ~bad, F.lit("schema")).otherwise(F.lit("row")).alias("event_kind"),
        F.when(reason.isNull(), pkey).alias("partition_key"),
        out_value.alias("value"),
        reason.alias("reject_reason"),
    ])
    return tuple(stages), names_read


def _with_quoted_image(field: Column) -> Column:
    """A raw field; if it is ``before`` or ``after`` and an object, as a JSON string of its text."""
    head = F.regexp_extract(field, r'(?s)^\s*+[{,]\s*+"(?:before|after)"\s*+:\s*+(?=\{)', 0)
    return F.when(head == "", field).otherwise(F.concat(head, json_quote_compact(F.substr(field, F.length(head) + 1))))


def parse_document(df: DataFrame, value_col: str = "value", position_field: str = "pos",
                   position_col: str | None = None, only: Column | None = None) -> DataFrame:
    """Document-store change events to routed records.

    ``db``/``table`` from ``ns.db``/``ns.coll``; key ``db.coll.<_id as JSON>``
    or ``db.coll.no_pk`` without a ``documentKey``. ``value`` is the input line.
    ``pos`` is the root field ``position_field``, or the column ``position_col`` of
    ``df`` (the offset of a message log). ``only``: as in ``parse_relational``, with
    the collection as ``table``.
    Staged like ``parse_relational``: the envelope, the inner ``documentKey``
    JSON and each JSON-type check are computed once, in their own projection.
    """
    out = df
    for i, cols in enumerate(_document_stages(_gateway_id(), value_col, position_field, position_col)):
        out = out.select(*cols)
        if i == 0 and only is not None:
            ns = F.col("__e")["ns"]
            named = _counted(out, "document").withColumns(
                {"db": ns["db"], "schema": F.lit(None).cast("string"), "table": ns["coll"]})
            out = named.filter(only).drop("db", "schema", "table")
    return _observed(out, "document")


@functools.lru_cache(maxsize=16)
def _document_stages(_gateway: int, value_col: str, position_field: str, position_col: str | None) -> tuple[list[Column], ...]:
    v = F.col(value_col)
    schema = f"ns struct<db: string, coll: string>, documentKey variant, {_q(position_field)} string, {_CORRUPT} string"
    e = F.col("__e")
    base = [F.col("__v"), F.col("__log_pos"), e]
    carried = F.lit(None).cast("string") if position_col is None else F.col(position_col).cast("string")
    c = F.col
    pk_text, key_reason = document_key_parts(c("__dkk"), c("__dkpk"), c("__id"))
    db, coll = e["ns"]["db"], e["ns"]["coll"]
    not_json = e.isNull() | e[_CORRUPT].isNotNull()
    reason = c("__reason")
    pos_text = F.coalesce(c("__log_pos"), e[position_field])
    return (
        [v.alias("__v"), carried.alias("__log_pos"), F.from_json(v, schema, _PARSE_OPTS).alias("__e")],
        [*base, variant_kind(e["documentKey"]).alias("__dkk"),
         F.try_variant_get(e["documentKey"], "$", "string").alias("__dkt")],
        [*base, c("__dkk"), c("__dkt"), F.try_parse_json(c("__dkt")).alias("__dkp")],
        [*base, c("__dkk"), c("__dkt"), variant_kind(c("__dkp")).alias("__dkpk")],
        [*base, c("__dkk"), c("__dkpk"), F.when(c("__dkpk") == "object", raw_value(raw_fields(c("__dkt")), "_id")).alias("__id")],
        [*base, pk_text.alias("__pk"), key_reason.alias("__kr")],
        [c("*"), pos_text.try_cast("bigint").alias("__pos"), pos_text.isNotNull().alias("__has_pos")],
        [c("*"), (
            F.when(not_json, F.lit(NOT_JSON))
            .when(db.isNull(), F.lit(DB_MISSING))
            .when(c("__has_pos") & c("__pos").isNull(), F.lit(POSITION_INVALID))
            .when(coll.isNull(), F.lit(TABLE_MISSING))
            .otherwise(c("__kr"))
        ).alias("__reason")],
        [
            db.alias("db"),
            coll.alias("table"),
            F.lit(None).cast("string").alias("op"),
            c("__pos").alias("pos"),
            F.lit("row").alias("event_kind"),
            F.when(reason.isNull(), key_string(db, coll, c("__pk"))).alias("partition_key"),
            c("__v").alias("value"),
            reason.alias("reject_reason"),
        ],
    )


def unknown_root_fields(df: DataFrame, value_col: str = "value",
                        known: tuple[str, ...] = RELATIONAL_FIELDS) -> DataFrame:
    """Add ``unknown_fields`` (root keys outside ``known``) and their count.

    They are carried in ``value`` like the others; this reports them. NULL for
    text that is not a JSON object.
    """
    keys = F.json_object_keys(F.col(value_col))
    unknown = F.filter(keys, lambda k: ~k.isin(*known))
    return df.withColumn("unknown_fields", unknown).withColumn(
        "n_unknown_fields", F.when(keys.isNotNull(), F.size(F.col("unknown_fields"))))


def split_rejects(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows). Persist ``routed`` first if both are written."""
    return (
        routed.filter(F.col("reject_reason").isNull()),
        routed.filter(F.col("reject_reason").isNotNull()),
    )


def unheld_rejects(routed: DataFrame) -> DataFrame:
    """Rejected rows of a load that is not persisted, without the work for its good rows.

    A reject has no key, hence no ``partition``. The key's hash is non-deterministic to Spark
    (``reflect``) and keeps a filter above it; without it the filter gets down to the load's scan,
    below exchanges and the JSON of each row.
    """
    if "partition" in routed.columns:
        routed = routed.withColumn("partition", F.lit(None).cast(routed.schema["partition"].dataType))
    return split_rejects(routed)[1]
