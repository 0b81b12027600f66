"""Change capture from two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograft.sources.snapshot import image_columns


def _once(side: DataFrame, image: str) -> DataFrame:
    """Rows with a key, each key once; the window shares the join's exchange and sort."""
    times = F.count(F.lit(1)).over(Window.partitionBy("__k"))
    seen = side.filter("__k IS NOT NULL").withColumn("__n", times)
    again = F.raise_error(F.concat(F.lit("snapshot_diff: key occurs more than once: "), F.col("__k").cast("string")))
    return seen.select("__k", F.when(F.col("__n") > 1, again.cast(side.schema[image].dataType)).otherwise(F.col(image)).alias(image))


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    pk: str,
    db: str,
    table: str,
    position: Column | None = None,
    time_zone: str | None = None,
) -> DataFrame:
    """Insert / update / delete envelopes that turn ``old`` into ``new``.

    One full outer join on the primary key (a key appears at most once per
    side, so no key can skew the join); ``u`` when the rows differ under
    null-safe comparison, unchanged rows emit nothing. Output: ``value`` (the
    JSON envelope) and the typed ``op``/``pos``. Intermediate changes between
    the two snapshots are not visible, only the net change per key.

    Rows without a key cannot be matched: they pass beside the join, old ones as
    deletes and new ones as creates, and a parse rejects them as ``key_null``. A key
    that occurs more than once on a side is an error of the input and fails the job.

    ``position`` is an expression over the key column ``__k`` (default NULL).
    """
    o = old.select(F.col(pk).alias("__k"), F.struct(*image_columns(old, time_zone)).alias("o"))
    n = new.select(F.col(pk).alias("__k"), F.struct(*image_columns(new, time_zone)).alias("n"))
    j = _once(o, "o").join(_once(n, "n"), "__k", "full_outer")
    for df in (o, n):
        j = j.unionByName(df.filter("__k IS NULL"), allowMissingColumns=True)
    op = (
        F.when(F.col("o").isNull(), F.lit("c"))
        .when(F.col("n").isNull(), F.lit("d"))
        .when(~F.col("o").eqNullSafe(F.col("n")), F.lit("u"))
    )
    pos = (position if position is not None else F.lit(None)).cast("bigint")
    changes = j.withColumn("op", op).filter(F.col("op").isNotNull()).withColumn("pos", pos)
    envelope = F.to_json(
        F.struct(
            F.col("o").alias("before"),
            F.col("n").alias("after"),
            F.struct(F.lit(db).alias("db"), F.lit(table).alias("table"), F.col("pos").alias("pos")).alias("source"),
            F.col("op"),
        ),
        {"ignoreNullFields": "false"},
    )
    return changes.select(envelope.alias("value"), "op", "pos", F.col("__k").alias(pk))


#: Key ranges of the first level, and of the second in each of them.
TOPS, LEAVES = 4096, 1024


def _checksums(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per range: rows and two sums of their hashes; no order, and no repeated row, is lost in them."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"__h{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in (1, 2)))


def _differing(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """The ranges whose checksums are not the same on both sides."""
    sums = ["n", "s1", "s2"]
    side = lambda rows, name: _checksums(rows, by).select(*by, F.struct(*sums).alias(name))
    both = side(old, "a").join(side(new, "b"), by, "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(*by)


def changed_ranges(old: DataFrame, new: DataFrame, pk: str, time_zone: str | None = None, tops: int = TOPS,
                   leaves: int = LEAVES) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots in key ranges that are not the same in both, and rows without a key.

    Two levels of checksums (counts and two 64-bit hash sums per range), so that only ranges of
    rows, not rows, are shuffled: of the ``tops`` ranges first, then of the ``leaves`` ranges in
    those that differ. Integer keys are cut into ranges of equal width between the smallest
    and the greatest, which suits files in key order; keys of other types by a hash. What is
    broadcast is bounded by ``tops`` rows and by ``tops * leaves / 64`` bit masks.
    """
    columns = [F.xxhash64(F.lit(i), *image_columns(old, time_zone)) for i in (1, 2)]
    of_new = [F.xxhash64(F.lit(i), *image_columns(new, time_zone)) for i in (1, 2)]
    key, size = F.col(f"`{pk}`"), tops * leaves
    if dict(old.dtypes)[pk] in ("tinyint", "smallint", "int", "bigint"):
        ends = old.select(key.alias("k")).union(new.select(key)).agg(F.min("k").alias("low"), F.max("k").alias("high")).first()
        low, high = ends.low or 0, ends.high or 0
        width = max(1, -(-(high - low + 1) // size))
        spot = F.expr(f"cast((cast(`{pk}` as decimal(20,0)) - {low}) div {width} as bigint)")
    else:
        spot = F.pmod(F.xxhash64(key), F.lit(size))

    def hashed(df: DataFrame, hashes: list[Column]) -> DataFrame:
        at = df.withColumn("__spot", spot)
        return at.select("*", F.floor(F.col("__spot") / leaves).cast("bigint").alias("__top"), (F.col("__spot") % leaves).cast("int").alias("__leaf"),
                         *(h.alias(f"__h{i}") for i, h in enumerate(hashes, 1)))

    a, b = hashed(old, columns), hashed(new, of_new)
    known = [s.filter("__top is not null").select("__top", "__leaf", "__h1", "__h2") for s in (a, b)]
    tops_differ = F.broadcast(_differing(*known, ["__top"]))  # at most ``tops`` rows
    leaves_differ = _differing(*(s.join(tops_differ, "__top", "left_semi") for s in known), ["__top", "__leaf"])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__leaf") % 64)
    masks = F.broadcast(leaves_differ.groupBy("__top", F.floor(F.col("__leaf") / 64).cast("int").alias("__word")).agg(F.bit_or(bit).alias("__bits")))

    def left(side: DataFrame, names: list[str]) -> DataFrame:
        near = side.withColumn("__word", F.floor(F.col("__leaf") / 64).cast("int")).join(masks, ["__top", "__word"], "left")
        hit = F.col("__top").isNull() | (F.getbit(F.coalesce("__bits", F.lit(0).cast("bigint")), F.col("__leaf") % 64) == 1)
        return near.filter(hit).select(*(F.col(f"`{c}`") for c in names))

    return left(a, old.columns), left(b, new.columns)


def snapshot_diff_by_range(old: DataFrame, new: DataFrame, pk: str, db: str, table: str, position: Column | None = None,
                           time_zone: str | None = None, tops: int = TOPS, leaves: int = LEAVES) -> DataFrame:
    """What ``snapshot_diff`` gives, where most key ranges are the same in both snapshots: only
    rows of ``changed_ranges`` are joined. The snapshots are read three times, and for the
    bounds of an integer key once more, and hardly shuffled. A changed range is missed where all three of its sums agree by chance (two
    64-bit hashes); a key that occurs more than once fails the job only in a changed range."""
    return snapshot_diff(*changed_ranges(old, new, pk, time_zone, tops, leaves), pk, db, table, position, time_zone)
