"""N-gram Jaccard join by vertical partitioning.

The n-grams (word shingles) of all documents have one global order: rarest
first, equally frequent ones by hash. The space of hashes is cut into
fragments, and the documents of a batch into the segments that lie in them; the
segments of one fragment meet in one place, packed, a few bytes an n-gram.

1. Partial counts. A fragment counts in how many documents each of its n-grams
   occurs, and sends back the occurrences of those in more than one. Summed over
   the fragments, a document has its number of n-grams that any other document
   has. A document with fewer of them than its size allows can link with
   nothing; most documents end here.
2. Candidates. Of two linked sets, the first n - ceil(t * n) + 1 n-grams in the
   global order have one in common. N-grams of one document come first in that
   order and meet nothing, so a document gives few rows or none. Documents
   that meet form groups (connected components of the meetings: one row per
   n-gram and document, so a bucket of any size costs what it holds).
3. Partial overlaps. Each group is dealt into units: a whole small group, or
   pairs of blocks of a large one, of neighbouring size levels only. A unit
   counts the overlaps of all its pairs fragment by fragment, as products of 0/1
   matrices, and sums the partial overlaps per pair. Pairs stay inside the unit;
   what leaves it is the number of links per set and a spanning forest of the
   links. No pair over the threshold is lost, and none is written out twice.

Equal sets are one class from the start. An n-gram that is in ``POPULAR`` or
more documents of a batch sends one marker to its fragment instead of its
occurrences, and comes last in the order wherever it occurs, so a passage that a
third of all documents share puts no more than a row per batch in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, Window

from .components import connected_components
from .scratch import counted, in_few_tasks, join_hot, ready_workers, settle
from .words import mix, shingles, word_hashes

_U = np.uint64
_K1 = 0xA0761D6478BD642F

#: N-grams of a batch, and of one fragment when the fragments are first cut.
BATCH_GRAMS, FRAGMENT_GRAMS = 1 << 20, 1 << 20
#: Documents of a batch that make an n-gram popular.
POPULAR = 64
#: A unit holds two blocks of at most so many n-grams and sets (or one larger set).
BLOCK_GRAMS, BLOCK_SETS = 1 << 18, 512
#: Cells of one fragment's matrix.
CELLS = 1 << 22


def set_class(grams: np.ndarray) -> int:
    """A 64-bit fingerprint of a set of n-grams."""
    total = (int(grams.sum(dtype=np.uint64)) + len(grams) * _K1) & ((1 << 64) - 1)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _each(batches, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, (shingles(w, size) for w in word_hashes(batch.column("text")))


def _classes(batches, size: int):
    for batch, sets in _each(batches, size):
        pairs = [(set_class(g) if len(g) else None, len(g)) for g in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([c for c, _ in pairs], pa.int64()), pa.array([n for _, n in pairs], pa.int64())],
            ["doc_id", "cls", "n"])


def _cut(batches, size: int, bits: int):
    """The segments of each batch by fragment, as rows (k, batch, frag, body): k is
    the fragment, or less than 0 for what goes on to its batch as it is."""
    task, number, seen = TaskContext.get().partitionId(), 0, set()
    for _, sets in _each(batches, size):
        cls, held, grams = [], 0, []
        for g in sets:
            if len(g) and (c := set_class(g)) not in seen:
                seen.add(c)
                cls.append(c)
                grams.append(g)
                held += len(g)
            if held >= BATCH_GRAMS or len(cls) == 1 << 16:
                yield _segments(cls, grams, (task << 24) + number, bits)
                cls, held, grams, number = [], 0, [], number + 1
        if cls:
            yield _segments(cls, grams, (task << 24) + number, bits)
            number += 1


def _segments(cls: list[int], sets: list[np.ndarray], batch: int, bits: int) -> pa.RecordBatch:
    sizes = np.array([len(g) for g in sets], np.int64)
    grams = np.concatenate(sets) >> _U(24 - bits)
    doc = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
    rows = [(-1 - batch, -2, np.array(cls, np.int64).tobytes() + sizes.tobytes())]

    order = np.argsort(grams)
    first = np.flatnonzero(np.concatenate(([True], grams[order[1:]] != grams[order[:-1]])))
    count = np.diff(np.append(first, len(grams)))
    many = count >= POPULAR
    marks, mark_count = grams[order[first[many]]], count[many].astype(np.uint32)
    if len(marks):
        held = np.zeros(len(grams), bool)
        held[order[np.repeat(many, count)]] = True
        rows.append((-1 - batch, -1, grams[held].tobytes() + doc[held].tobytes()))
        grams, doc = grams[~held], doc[~held]
    frag = (grams >> _U(40)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(frag, kind="stable")  # documents stay in order
    frag, grams, doc = frag[order], grams[order], doc[order]
    ids = np.union1d(frag, marks >> _U(40)).astype(np.int64)
    low, high = grams.astype(np.uint32), (grams >> _U(32)).astype(np.uint8)
    doc_high, doc_low = (doc >> np.uint16(8)).astype(np.uint8), doc.astype(np.uint8)
    cut, end = np.searchsorted(frag, ids, "left"), np.searchsorted(frag, ids, "right")
    mcut, mend = np.searchsorted(marks >> _U(40), ids.astype(np.uint64), "left"), np.searchsorted(marks >> _U(40), ids.astype(np.uint64), "right")
    key = marks & _U((1 << 40) - 1)
    for f, a, b, c, d in zip(ids.tolist(), cut, end, mcut, mend):
        rows.append((f, f, b"".join((
            np.array([b - a, d - c], np.uint32).tobytes(), low[a:b].tobytes(), high[a:b].tobytes(), doc_high[a:b].tobytes(),
            doc_low[a:b].tobytes(), key[c:d].tobytes(), mark_count[c:d].tobytes()))))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([batch] * len(rows), pa.int64()),
         pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["k", "batch", "frag", "body"])


def _planes(body: bytes, *kinds: tuple[int, type]) -> list[np.ndarray]:
    out, at = [], 0
    for n, kind in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    return out


def _read_segment(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(body, np.uint32, 2))
    low, high, doc_high, doc_low, marks, count = _planes(
        body[8:], (n, np.uint32), (n, np.uint8), (n, np.uint8), (n, np.uint8), (m, np.uint64), (m, np.uint32))
    return (low.astype(np.uint64) | (high.astype(np.uint64) << _U(32)),
            doc_low.astype(np.uint16) | (doc_high.astype(np.uint16) << np.uint16(8)), marks, count)


def _count_fragment(held: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """From the segments of one fragment, the occurrences of the n-grams that are in
    more than one document, each with its place in the order: 2 to 254 by the
    number of documents, 255 for popular ones."""
    parts = [_read_segment(body) for _, body in held]
    grams, marks = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
    popular = np.unique(marks)
    value, place, count = np.unique(grams, return_inverse=True, return_counts=True)
    rank = np.minimum(count, 254).astype(np.uint8)
    if len(popular) and len(value):
        at = np.minimum(np.searchsorted(popular, value), len(popular) - 1)
        rank[popular[at] == value] = 255
    rank, out, at = rank[place], [], 0
    for (batch, _), (gram, doc, _, _) in zip(held, parts):
        mine = rank[at: at + len(gram)]
        at += len(gram)
        keep = mine > 1
        if keep.any():
            out.append((batch, gram[keep].tobytes() + doc[keep].tobytes() + mine[keep].tobytes()))
    return out


def _fragments(batches):
    """Rows sorted by k: what each fragment sends back to its batches."""
    key, held = None, []

    def out(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.binary())], ["batch", "frag", "body"])

    for rows in batches:
        sent = []
        for k, batch, frag, body in zip(*(rows.column(c).to_pylist() for c in ("k", "batch", "frag", "body"))):
            if k < 0:
                sent.append((batch, frag, body))
                continue
            if k != key:
                sent += [(b, key, x) for b, x in (_count_fragment(held) if held else ())]
                key, held = k, []
            held.append((batch, body))
        yield out(sent)
    yield out([(b, key, x) for b, x in (_count_fragment(held) if held else ())])


def _survivors(batches, percent: int):
    """Rows sorted by batch: the documents that have enough n-grams in common with
    others, with those (grams) and the first of them that may meet (pre)."""
    key, held = None, {}
    names = ["cls", "n", "pre", "grams"]

    def out() -> pa.RecordBatch:
        head = np.frombuffer(held[-2][0], np.int64)
        cls, n = head[: len(head) // 2], head[len(head) // 2:]
        gram, doc, rank = [], [], []
        for frag, bodies in held.items():
            for body in bodies if frag > -2 else ():
                many = len(body) // (10 if frag < 0 else 11)
                g, d, *r = _planes(body, (many, np.uint64), (many, np.uint16), *([(many, np.uint8)] if frag >= 0 else ()))
                gram.append(g if frag < 0 else g | _U(frag << 40))
                doc.append(d)
                rank.append(r[0] if r else np.full(many, 255, np.uint8))
        if not gram:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())], names)
        gram, doc, rank = np.concatenate(gram), np.concatenate(doc), np.concatenate(rank)
        need = -(-percent * n // 100)
        enough = np.bincount(doc, minlength=len(n)) >= need
        mine = enough[doc]
        gram, doc, rank = gram[mine], doc[mine], rank[mine]
        order = np.lexsort((gram, rank, doc))
        gram, doc = gram[order], doc[order]
        rows = np.flatnonzero(enough)
        cut = np.searchsorted(doc, np.append(rows, len(n)))
        pre = [gram[a: b - need[i] + 1].view(np.int64) for i, a, b in zip(rows, cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(cls[rows]), pa.array(n[rows]), pa.array(pre, pa.list_(pa.int64())),
             pa.array([gram[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names)

    for rows in batches:
        for batch, frag, body in zip(*(rows.column(c).to_pylist() for c in ("batch", "frag", "body"))):
            if batch != key:
                if held:
                    yield out()
                key, held = batch, {}
            held.setdefault(frag, []).append(body)
    if held:
        yield out()


def overlaps(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Sizes of the intersections: of all pairs, or of the first ``split`` sets
    with the others. Fragment by fragment, the partial overlaps summed per pair."""
    m = len(sets)
    left = m if split is None else split
    right = slice(0, m) if split is None else slice(split, m)
    out = np.zeros((left, m if split is None else m - split), np.float32)
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(m, dtype=np.int64), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.concatenate(([True], grams[1:] != grams[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # an n-gram of one set adds to no overlap
    owner, column = owner[shared], column[shared]
    if not len(column):
        return out
    column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1
    width = max(1, CELLS // m)
    for low in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((m, int(column[b - 1]) - low + 1), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part[:left] @ part[right].T
    return out


def _unit(cls: np.ndarray, mult: np.ndarray, side: np.ndarray, n: np.ndarray, sets: list[np.ndarray], percent: int):
    """Links of one unit: (class, links) and a forest of (class, class)."""
    first = np.argsort(side, kind="stable")
    cls, mult, side, n, sets = cls[first], mult[first], side[first], n[first].astype(np.float64), [sets[i] for i in first]
    split = None if not side.any() else int((side == 0).sum())
    if len(sets) < 2 or split in (0, len(sets)):
        return [], [], [], []
    rows, cols = (slice(0, split), slice(split, None)) if split is not None else (slice(None), slice(None))
    over = overlaps(sets, split).astype(np.float64)
    link = 100 * over >= percent * (n[rows][:, None] + n[cols][None, :] - over)
    if split is None:
        np.fill_diagonal(link, False)
        a, b = np.nonzero(np.triu(link))
        count = link @ mult
    else:
        a, b = np.nonzero(link)
        b = b + split
        count = np.concatenate([link @ mult[split:], mult[:split] @ link])
    top = np.arange(len(cls))
    while len(a):
        low = np.minimum(top[a], top[b])
        was = top.copy()
        np.minimum.at(top, a, low)
        np.minimum.at(top, b, low)
        top = top[top]
        if (was == top).all():
            break
    tied = np.flatnonzero(top != np.arange(len(cls)))
    some = np.flatnonzero(count)
    return cls[some].tolist(), count[some].astype(np.int64).tolist(), cls[top[tied]].tolist(), cls[tied].tolist()


def _count_links(batches, percent: int):
    """Rows sorted by (grp, unit): the links of each unit."""
    key, held = None, []

    def out():
        cls, count, a, b = _unit(*(np.array([x[i] for x in held]) for i in range(4)), [np.frombuffer(x[4], np.uint64) for x in held], percent)
        return [*zip(cls, [None] * len(cls), count), *((x, y, None) for x, y in zip(a, b))]

    for batch in batches:
        rows: list = []
        *cols, grams = (batch.column(c) for c in ("grp", "unit", "cls", "mult", "side", "n", "grams"))
        grp, unit, cls, mult, side, n = (c.to_numpy(zero_copy_only=False) for c in cols)
        for i in range(batch.num_rows):
            now = (grp[i], unit[i])
            if now != key:
                if len(held) > 1:
                    rows += out()
                key, held = now, []
            held.append((cls[i], mult[i], side[i], n[i], grams[i].as_py()))
        yield _link_batch(rows)
    yield _link_batch(out() if len(held) > 1 else [])


def _link_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["a", "b", "links"])


def _units(members: DataFrame, percent: int) -> DataFrame:
    """Members (grp, cls, n, mult) with a row for each unit that they are part of."""
    # One geometric step a level, a little wider than partners can differ: neighbouring levels hold all partners.
    level = F.floor(F.log("n") / F.log(F.lit(101 / percent))).cast("long")
    sized = members.withColumn("level", level)
    whole = sized.groupBy("grp").agg(F.sum("n").alias("grams_all"), F.count("*").alias("sets_all"))
    blocks = (sized.groupBy("grp", "level").agg(F.sum("n").alias("g"), F.count("*").alias("s"))
              .select("grp", "level", "s", F.ceil(F.greatest(F.col("g") / BLOCK_GRAMS, F.col("s") / BLOCK_SETS)).alias("salts")))
    near = lambda step, name: blocks.select("grp", (F.col("level") - step).alias("level"), F.col("salts").alias(name))
    blocks = (blocks.join(near(1, "above"), ["grp", "level"], "left").join(near(-1, "below"), ["grp", "level"], "left")
              .na.fill(0, ["above", "below"]).join(whole, "grp"))
    rows = join_hot(sized, settle(blocks), ["grp", "level"], f"s > {BLOCK_SETS}").withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts")))

    def over(blocks_of: str, low: str, up: int, first: str, second: str, side: str) -> str:
        """A unit with each block: level of the first, whether the second is of the next level, their salts."""
        unit = f"((({low}) * 2 + {up}) * 16777216L + {first}) * 16777216L + {second}"
        return (f"if({blocks_of} > 0, transform(sequence(0L, {blocks_of} - 1), b -> "
                f"named_struct('unit', {unit}, 'side', cast({side} as int))), array())")

    alone = F.expr("array(named_struct('unit', -1L, 'side', 0))")
    each = F.expr("concat(" + ", ".join((
        over("salts", "level", 0, "least(salt, b)", "greatest(salt, b)", "salt > b"),
        over("above", "level", 1, "salt", "b", "false"),
        over("below", "level - 1", 1, "b", "salt", "true"))) + ")")
    small = (F.col("grams_all") <= BLOCK_GRAMS) & (F.col("sets_all") <= BLOCK_SETS)
    return (rows.select("grp", "cls", "mult", F.explode(F.when(small, alone).otherwise(each)).alias("u"))
            .select("grp", "cls", "mult", "u.unit", "u.side"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents whose sets of ``words``-word shingles have a Jaccard
    similarity of ``percent`` / 100 or more, and find the components.

    Words are runs of bytes other than space and 09-0D, with A-Z as a-z. A text
    with fewer words is one shingle; a null, empty or blank text has none and
    links with nothing. Returns a row per row of ``docs``: doc_id, n_shingles,
    component_id (smallest id reachable by links, its own included; null ids are
    passed over, and stay null where no other is reachable), n_links (rows it
    links with; rows with equal sets link). Repeated rows count as documents of
    their own. Other columns of ``docs`` are not read. No table gives no rows.
    N-grams are compared by the first 50 to 62 bits of 64-bit hashes: 40 bits within a
    fragment, and the bits that name it (a fragment holds about a million n-grams).
    """
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = rows.filter("text is not null")
    own, documents = counted(rows.mapInArrow(partial(_classes, size=words), "doc_id long, cls long, n long"))
    classes = settle(in_few_tasks(own.filter("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("mult")), documents))

    grams = own.agg(F.sum("n")).first()[0] or 0
    bits = min(22, max(10, (grams // FRAGMENT_GRAMS).bit_length()))
    cut = texts.mapInArrow(partial(_cut, size=words, bits=bits), "k long, batch long, frag int, body binary")
    back = (cut.repartition("k").sortWithinPartitions("k")
            .mapInArrow(_fragments, "batch long, frag int, body binary"))
    left = (back.repartition("batch").sortWithinPartitions("batch")
            .mapInArrow(partial(_survivors, percent=percent), "cls long, n long, pre array<long>, grams binary"))
    once = Window.partitionBy("cls").orderBy(F.size("pre"))  # a class comes once from each task that saw it
    left = settle(left.withColumn("_r", F.row_number().over(once)).filter("_r = 1").drop("_r"))

    meet, meetings = counted(left.select("cls", F.explode("pre").alias("gram")))
    hubs = settle(in_few_tasks(meet.groupBy("gram").agg(F.min("cls").alias("hub"), F.count("*").alias("k")).filter("k > 1"), meetings))
    met = join_hot(meet, hubs, ["gram"], "k > 1000").filter("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    groups = connected_components(in_few_tasks(met, meetings), meetings)

    members = settle(in_few_tasks(groups.select(F.col("node").alias("cls"), F.col("root").alias("grp")).join(classes, "cls"), documents))
    parts = (_units(members, percent).join(left.select("cls", "n", "grams"), "cls")
             .repartition("grp", "unit").sortWithinPartitions("grp", "unit"))
    found, links = counted(parts.mapInArrow(partial(_count_links, percent=percent), "a long, b long, links long"))
    linked = in_few_tasks(found.filter("links is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("other")), links)
    roots = connected_components(found.filter("links is null"), links)

    rooted = settle(in_few_tasks(roots.select(F.col("node").alias("cls"), "root").join(classes.select("cls", "rep"), "cls"), documents))
    tops = in_few_tasks(rooted.groupBy("root").agg(F.min("rep").alias("top")), documents)
    rooted = in_few_tasks(rooted.join(tops, "root").select("cls", "top"), documents)
    of_class = (classes.join(linked, "cls", "left").join(rooted, "cls", "left")
                .select("cls", "n", F.coalesce("top", "rep").alias("component"),
                        (F.col("mult") - 1 + F.coalesce("other", F.lit(0))).alias("links")))
    of_class = in_few_tasks(of_class, documents)
    return (own.join(of_class, ["cls", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links")))
