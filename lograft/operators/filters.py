"""Include lists for databases, tables and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entries(spec: str | list[str] | None) -> list[str] | None:
    if spec is None:
        return None
    if isinstance(spec, str):
        # Split on ',' without trimming: a space is part of the entry.
        return spec.split(",")
    return list(spec)


def _anchored(entries: list[str]) -> str:
    return "^(?:" + "|".join(f"(?:{e})" for e in entries) + ")$"


def include_condition(
    databases: str | list[str] | None = None,
    tables: str | list[str] | None = None,
    schemas: str | list[str] | None = None,
    qualifier: str = "db",
    db_col: str | Column = "db",
    table_col: str | Column = "table",
    schema_col: str | Column = "schema",
) -> Column | None:
    """Predicate for an event's names (columns, or constants); ``None`` when there is nothing to filter.

    ``tables`` entries are ``db.table`` (``qualifier='db'``) or ``schema.table``
    (``qualifier='schema'``). A name that an event does not have cannot exclude it:
    an unreadable event stays, to become a reject, and so does a schema change of
    an included database that names no table.
    """
    conds: list[Column] = []
    db_col, table_col, schema_col = (c if isinstance(c, Column) else F.col(c) for c in (db_col, table_col, schema_col))

    def add(name: Column, entries: list[str] | None) -> None:
        if entries is not None:
            conds.append(name.isNull() | name.rlike(_anchored(entries)))

    add(db_col, _entries(databases))
    if schemas is not None:
        add(schema_col, _entries(schemas))
    if tables is not None:
        prefix = schema_col if qualifier == "schema" else db_col
        add(F.concat(prefix, F.lit("."), table_col), _entries(tables))
    out: Column | None = None
    for c in conds:
        out = c if out is None else out & c
    return out


def include(
    df: DataFrame,
    databases: str | list[str] | None = None,
    tables: str | list[str] | None = None,
    db_col: str = "db",
    table_col: str = "table",
    keep_unknown: bool = True,
) -> DataFrame:
    """Keep rows whose database matches ``databases`` and whose ``db.table``
    matches ``tables`` (collections use the same form). Entries are regular
    expressions matched against the whole name; ``None`` means no filter.
    Rows without the name stay unless ``keep_unknown`` is off. Jobs filter inside the
    parse instead (``only``), before key work.
    """
    cond = include_condition(databases, tables, db_col=db_col, table_col=table_col)
    if cond is None:
        return df
    if not keep_unknown:
        known = F.col(db_col).isNotNull() & (F.col(table_col).isNotNull() if tables is not None else F.lit(True))
        cond = cond & known
    return df.filter(cond)
