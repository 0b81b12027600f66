"""Split points of a snapshot scan, taken from the data: ranges of any ordered key (numbers,
text, dates, several columns) that hold about as many rows each.

The points are quantiles. A single numeric or time key goes through Spark's quantile
sketch, in one pass; for all others a sample of bounded size is sorted. The ranges are
half open, the first and the last one have no end, and rows with a NULL key have a
range of their own, so each row, also one that is written later, is in exactly one.
"""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows sampled per range: the largest range is then a few tenths over the mean.
SAMPLED = 200
#: Ranges at most: points are constants of a plan.
MOST = 10_000

Point = tuple


def split_points(df: DataFrame, keys: str | Sequence[str], ranges: int, sampled: int = SAMPLED, seed: int = 7) -> list[Point]:
    """Up to ``ranges - 1`` points between ranges of ``keys``, ascending, each a tuple of key values.

    There are fewer where a key value holds more than a range's rows: it cannot be split.
    Rows with a NULL key are not counted. The driver receives the points, or a sample of
    about ``sampled`` rows per range.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not 1 <= ranges <= MOST:
        raise ValueError(f"ranges has to be 1 to {MOST}, not {ranges}")
    known = df.select(*keys).dropna()
    kind = known.schema[0].dataType
    if ranges == 1:
        return []
    if len(keys) == 1 and isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = [i / ranges for i in range(1, ranges)]
        found = known.agg(F.percentile_approx(keys[0], shares, max(10_000, 50 * ranges)).alias("p")).first().p or []
        points = [(v,) for v in found]
    else:
        rows = known.count()
        share = min(1.0, ranges * sampled / rows) if rows else 0.0
        sample = known.sample(share, seed) if share < 1 else known
        # A few rows per range, at most ``MOST`` ranges: one task sorts them, and the table is read once for it.
        values = [tuple(r) for r in sample.repartition(1).sortWithinPartitions(*keys).collect()] if rows else []
        points = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
    return list(dict.fromkeys(points))  # in order, each once


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def split_of(key_columns: Sequence[Column], kinds: Sequence[T.DataType], points: Sequence[Point]) -> Column:
    """The number of the range of a key: the number of points that are not above it, found
    by binary search. NULL for a key with a NULL."""
    if not points:
        whole: Column = F.lit(0)
    else:
        key = F.struct(*(c.cast(k).alias(f"k{i}") for i, (c, k) in enumerate(zip(key_columns, kinds))))
        table = F.array(*(F.struct(*(_literal(v, k).alias(f"k{i}") for i, (v, k) in enumerate(zip(p, kinds)))) for p in points))
        steps = F.sequence(F.lit(1), F.lit(math.ceil(math.log2(len(points) + 1))))

        def halve(s: Column, _: Column) -> Column:
            low, high = s["low"], s["high"]
            middle = F.call_function("shiftright", low + high, F.lit(1))
            below = F.get(table, middle) <= key
            return F.when(low >= high, s).otherwise(F.struct(F.when(below, middle + 1).otherwise(low).alias("low"),
                                                             F.when(below, high).otherwise(middle).alias("high")))

        start = F.struct(F.lit(0).alias("low"), F.lit(len(points)).alias("high"))
        whole = F.aggregate(steps, start, halve, lambda s: s["low"])
    known = key_columns[0].isNotNull()
    for c in key_columns[1:]:
        known = known & c.isNotNull()
    return F.when(known, whole)


def _sql(value) -> str:
    """A constant as SQL that databases share."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return repr(value)


def _below(names: Sequence[str], point: Point) -> str:
    """``names`` < ``point``, column by column."""
    out = ""
    for name, value in reversed(list(zip(names, point))):
        v = _sql(value)
        out = f"({name} < {v} OR ({name} = {v} AND {out}))" if out else f"{name} < {v}"
    return out


def split_predicates(keys: str | Sequence[str], points: Sequence[Point], quote: str = '"') -> list[str]:
    """SQL conditions of the ranges, in order, and last that of the rows with a NULL key.
    ``quote`` is the database's quote around names."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = [f"{quote}{k.replace(quote, quote * 2)}{quote}" for k in keys]
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    out = []
    for low, high in zip([None, *points], [*points, None]):
        parts = [known, *([f"NOT ({_below(names, low)})"] if low is not None else []), *([f"({_below(names, high)})"] if high is not None else [])]
        out.append(" AND ".join(parts))
    return [*out, " OR ".join(f"{n} IS NULL" for n in names)]


def read_jdbc_splits(spark: SparkSession, url: str, table: str, keys: str | Sequence[str], points: Sequence[Point], quote: str = '"',
                     properties: dict[str, str] | None = None) -> DataFrame:
    """Snapshot scan with a task per range of ``keys``, and one for NULL keys: any ordered key,
    and ranges by the table's own distribution. Each row is read once, whatever is written
    between the sampling of the points and the scan."""
    return spark.read.jdbc(url, table, predicates=split_predicates(keys, points, quote), properties=dict(properties or {}))
