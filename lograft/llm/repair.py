"""Repair of conversation structure: the cheapest edits that make the turns of a
conversation alternate, found by a shortest path over scalar integers.

A conversation is a text of one character per row: the row's role and its fault.
Edits are the steps of a DAG over (row, what the roles so far look like). The weight
of a path is one integer: the cost in its high digits, and below them the letters of
the path's edits, base 8 and in the order of their ASCII codes, the first letter
highest, in a fixed number of digits with zeros behind the last letter. The smallest
integer is the cheapest path and, of the cheapest, the one whose letters come first,
so the minimum of integers decides everything.

Rows reach the search as counted, narrow rows in one global order, so a conversation
of any length is cut into pieces by that order. A piece that may go on elsewhere
gives the best path between each two states; such pieces are put together by minima
over the state between them. Texts move once, when the repaired turns are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import join_hot, ready_workers, settle

#: Letters of edits, as digits in the order of their ASCII codes.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
#: Costs of edits, and what a truncated row that stays costs besides.
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
#: First letters of roles (others are "other"), and faults.
INITIALS = "sua"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
#: Roles so far: none, up to a system, user or assistant row. KEPT: where a row with this
#: initial leads, if it may; TURNED: where the user or assistant row that may follow leads.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEPT = [[SYSTEM, USER, None, None], [None, USER, None, None], [None, None, ASSISTANT, None], [None, USER, None, None]]
TURNED = [USER, USER, ASSISTANT, USER]
ENDS = (NOTHING, ASSISTANT)
#: Rows of a conversation that are searched in one piece.
PIECE = 512
#: Adjacent initials that are legal.
LEGAL = ("su", "ua", "au")

_SPACES = r"[\x20\x09-\x0D]"


def _before(letter: int, cost: int, path: int | None, width: int) -> int | None:
    """The weight of ``path`` with one edit before it."""
    if path is None:
        return None
    letters = path & ((1 << 3 * width) - 1)
    return path - letters + (cost << 3 * width) + (letter << 3 * (width - 1)) + (letters >> 3)


def _least(paths) -> int | None:
    return min((p for p in paths if p is not None), default=None)


def search(codes: str, ends: list[int | None], width: int) -> list[int | None]:
    """The weights of the best paths from each state over the rows ``codes`` (a hexadecimal
    digit each: initial * 4 + fault) to weights ``ends`` behind them. At most one row is
    inserted in a place: of two, one path without them is cheaper."""
    for code in reversed(codes):
        initial, fault = divmod(int(code, 16), 4)
        best: list[int | None] = []
        for state in range(4):
            ways = [_before(DELETE, DELETE_COST, ends[state], width)]
            if fault in (SOUND, TRUNCATED):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                if KEPT[state][initial] is not None:
                    ways.append(_before(KEEP, KEEP_COST + more, ends[KEPT[state][initial]], width))
                ways.append(_before(REROLE, REROLE_COST + more, ends[TURNED[state]], width))
            best.append(_least(ways))
        ends = [_least((best[s], _before(INSERT, INSERT_COST, best[TURNED[s]], width))) for s in range(4)]
    return ends


def _final(width: int) -> list[int | None]:
    """The end of a conversation, where one row may be inserted too."""
    ends = [0 if s in ENDS else None for s in range(4)]
    return [_least((ends[s], _before(INSERT, INSERT_COST, ends[TURNED[s]], width))) for s in range(4)]


def _read(path: int, width: int) -> tuple[int, str]:
    """(cost, letters) of a weight."""
    letters = oct(path & ((1 << 3 * width) - 1))[2:].zfill(width).rstrip("0")
    return path >> 3 * width, letters.translate({ord(str(d)): c for d, c in enumerate(LETTERS)})


@lru_cache(maxsize=4096)
def solve(codes: str) -> tuple[int, str]:
    """(cost, audit) of a conversation. Conversations of few rows are often alike."""
    width = 2 * len(codes) + 1
    return _read(search(codes, _final(width), width)[NOTHING], width)


Ways = tuple[int, list[list[int | None]]]


def ways_through(codes: str) -> Ways:
    """(digits, weights): the best path over ``codes`` from each state to each state."""
    width = 2 * len(codes)
    ends = [[0 if s == t else None for s in range(4)] for t in range(4)]
    found = [search(codes, e, width) for e in ends]
    return width, [[found[t][s] for t in range(4)] for s in range(4)]


def _behind(a: int | None, wide_a: int, b: int | None, wide_b: int) -> int | None:
    """Path ``a``, then path ``b``: b's letters go where the zeros behind a's begin."""
    if a is None or b is None:
        return None
    first, then = a & ((1 << 3 * wide_a) - 1), b & ((1 << 3 * wide_b) - 1)
    free = wide_a if not first else ((first & -first).bit_length() - 1) // 3
    cost = (a >> 3 * wide_a) + (b >> 3 * wide_b)
    return (cost << 3 * (wide_a + wide_b)) | (first << 3 * wide_b) | (then << 3 * free)


def put_together(a: Ways, b: Ways) -> Ways:
    """Ways through two pieces, one behind the other."""
    (wide_a, x), (wide_b, y) = a, b
    return wide_a + wide_b, [[_least(_behind(x[s][m], wide_a, y[m][t], wide_b) for m in range(4)) for t in range(4)] for s in range(4)]


class Chain:
    """Ways through pieces that come one by one. Equally long runs are put together, so
    few are held and each is copied a logarithmic number of times."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, Ways]] = []

    def add(self, ways: Ways) -> None:
        size = 1
        while self.runs and self.runs[-1][0] <= size:
            n, before = self.runs.pop()
            ways, size = put_together(before, ways), size + n
        self.runs.append((size, ways))

    def solve(self) -> tuple[int, str]:
        ends, wide = _final(1), 1
        for _, (w, x) in reversed(self.runs):
            ends = [_least(_behind(x[s][m], w, ends[m], wide) for m in range(4)) for s in range(4)]
            wide += w
        return _read(ends[NOTHING], wide)


def faults(codes: str) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) of a conversation's rows."""
    count = [0, 0, 0, 0]
    for c in set(codes):
        count[int(c, 16) % 4] += codes.count(c)
    letters = codes.translate({ord(f"{i * 4 + k:x}"): (INITIALS + "?")[i] for i in range(4) for k in range(4)})
    legal = sum(letters.count(p) for p in LEGAL)  # the letters of a pair differ: no two places overlap
    return count[BLANK], count[DUPLICATE], count[TRUNCATED], max(0, len(letters) - 1) - legal


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_PLAN = "conv_id long, seq long, codes string, low long, high long, turns long, audit string, cost long, width long, ways array<binary>"
_PLAN_COLS = [f.split()[0] for f in _PLAN.split(", ")]
_PLAN_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]


def _held(paths: list[list[int | None]]) -> list[bytes | None]:
    return [None if p is None else p.to_bytes(p.bit_length() // 8 + 1, "big") for row in paths for p in row]


def _taken(width: int, held: list[bytes | None]) -> Ways:
    paths = [None if h is None else int.from_bytes(h, "big") for h in held]
    return width, [paths[4 * s: 4 * s + 4] for s in range(4)]


def _merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Counted rows that follow one another with one key as one: (conv, turn, n, code, again)."""
    last = None
    for conv, turn, role, digest, n, code, again in rows:
        if last is not None and last[0] == (conv, turn, role, digest):
            last[1] += n
            last[2] = last[2] or again
            continue
        if last is not None:
            yield last[0][0], last[0][1], last[1], last[3], last[2]
        last = [(conv, turn, role, digest), n, again, code]
    if last is not None:
        yield last[0][0], last[0][1], last[1], last[3], last[2]


def _characters(n: int, code: int, again: bool) -> Iterator[str]:
    """The characters of n equal rows, in runs: all but the first are duplicates."""
    if code % 4 == BLANK:
        first = rest = f"{code:x}"
    else:
        rest = f"{code // 4 * 4 + DUPLICATE:x}"
        first = rest if again else f"{code:x}"
    yield first
    for left in range(n - 1, 0, -PIECE):
        yield rest * min(left, PIECE)


def _plans(batches) -> Iterator[pa.RecordBatch]:
    """A row per conversation that lies within this task and one piece, and rows with ways
    through the pieces of the others."""
    task, seq = TaskContext.get().partitionId(), 0
    out: list[tuple] = []
    conv, started, codes, low, high, turns = None, False, "", None, None, 0
    alone = False  # the conversation began in this piece; the first may have begun in another task

    def flush(whole: bool) -> None:
        nonlocal seq, codes, low, high, turns
        if whole:
            cost, audit = solve(codes)
            out.append((conv, None, codes, low, high, turns, audit, cost, None, None))
        else:
            width, ways = ways_through(codes)
            out.append((conv, (task << 40) + seq, codes, low, high, turns, None, None, width, _held(ways)))
            seq += 1
        codes, low, high, turns = "", None, None, 0

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PLAN_TYPES)], _PLAN_COLS)
        out.clear()
        return made

    for this, turn, n, code, again in _merged(_rows(batches)):
        if started and this != conv:
            if codes:
                flush(whole=alone)
            alone = True
        conv, started = this, True
        if turn is not None:
            turns += turn != high
            low, high = (turn if low is None else low), turn
        for run in _characters(n, code, again):
            while run:
                room = PIECE - len(codes)
                codes, run = codes + run[:room], run[room:]
                if len(codes) == PIECE:
                    flush(whole=False)
                    alone = False
        if len(out) >= 2000:
            yield batch()
    if codes:
        flush(whole=False)  # goes on in another task, perhaps
    if out:
        yield batch()


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """Conversations of several pieces, which come in order."""
    conv, started = None, False
    chain, codes, low, high, turns = Chain(), [], None, None, 0

    def done() -> pa.RecordBatch:
        cost, audit = chain.solve()
        row = (conv, None, "".join(codes), low, high, turns, audit, cost, None, None)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _PLAN_TYPES)], _PLAN_COLS)

    for this, _, text, first, last, some, _, _, width, ways in _rows(batches):
        if started and this != conv:
            yield done()
            chain, codes, low, high, turns = Chain(), [], None, None, 0
        conv, started = this, True
        chain.add(_taken(width, ways))
        codes.append(text)
        if first is not None:
            turns += some - (first == high)
            low, high = (first if low is None else low), last
    if started:
        yield done()


def _counted(batches, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count = list(zip(*map(faults, batch.column("codes").to_pylist()))) or [()] * 4
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(c, pa.int64()) for c in count)],
                                         [*keep, "blank", "duplicate", "truncated", "illegal"])


def _turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as one space, and the digest that orders equal turns."""
    named = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    return named.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _fault(text: Column) -> Column:
    words = F.regexp_replace(text, _SPACES, "")
    return F.when(words == "", BLANK).when(~F.substring(words, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)


def plan_repairs(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation, from rows (conv_id, turn, role, text).

    A conversation's rows go by turn (nulls first), rows of one turn by role and by the
    SHA-256 of their text. A row's fault is the first of: blank (no word), duplicate (its
    role and text were seen earlier), truncated (its last character that is no space
    ends no sentence). Returns per conversation: conv_id, codes (a character per row), gaps
    (turns missing between the least and the greatest, 0 without turns), blank,
    duplicate, truncated, illegal (adjacent roles out of order), cost and audit (the
    letters of its edits). Null roles and texts count as one space, null ids are one
    conversation, repeated rows are duplicates, other columns are not read, no rows give
    no rows. A conversation's codes and audit are one text each, a character per row.
    """
    ready_workers(rows.sparkSession)
    initial = F.when(F.col("role") == "", F.lit(len(INITIALS)))
    for i, letter in enumerate(INITIALS):
        initial = initial.when(F.col("role").startswith(letter), F.lit(i))
    key = ["conv_id", "turn", "role", "digest"]
    named = _turns(rows)
    seen = settle(named.withColumn("code", (initial.otherwise(len(INITIALS)) * 4 + _fault(F.col("text"))).cast("int"))
                  .groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("code").alias("code")))
    # Texts of a role that stand at several turns: at all but the first they are duplicates.
    spot = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = ["conv", "role", "digest"]
    keyed = seen.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    first = keyed.groupBy(*same).agg(F.min(spot).alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    again = join_hot(keyed, settle(first), same, "k > 1000").filter(~spot.eqNullSafe(F.col("first")))
    marks = again.select(*key, F.lit(0).cast("long").alias("n"), "code", F.lit(True).alias("again"))
    order = [F.asc_nulls_first(c) for c in key]
    found = settle(seen.select(*key, "n", "code", F.lit(False).alias("again")).union(marks)
                   .repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_plans, _PLAN))
    parts = (found.filter("audit is null").repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_joined, _PLAN))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return (found.filter("audit is not null").union(parts).select("conv_id", "codes", gaps, "cost", "audit")
            .mapInArrow(partial(_counted, keep=["conv_id", "codes", "gaps", "cost", "audit"]),
                        "conv_id long, codes string, gaps long, cost long, audit string, blank long, duplicate long, truncated long, illegal long"))


_TURN_COLS = ["conv_id", "place", "edit", "role", "text"]
_TURN_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


class _Walk:
    """One conversation's edits, applied to its rows as they come."""

    def __init__(self, conv, codes: str, audit: str):
        self.conv, self.codes, self.audit = conv, codes, audit
        self.at = self.row = self.place = 0
        self.state = NOTHING

    def _put(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        return self.conv, self.place - 1, edit, role, text

    def until_row(self) -> Iterator[tuple]:
        """Inserted rows, and blank ones gone, up to the next row that has a text."""
        while self.at < len(self.audit):
            if self.audit[self.at] == "I":
                self.state = TURNED[self.state]
                yield self._put("I", "assistant" if self.state == ASSISTANT else "user", "")
            elif int(self.codes[self.row], 16) % 4 == BLANK:
                self.row += 1
            else:
                return
            self.at += 1

    def next_row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.until_row()
        edit, code = self.audit[self.at], int(self.codes[self.row], 16)
        self.at, self.row = self.at + 1, self.row + 1
        if edit == "K":
            self.state = KEPT[self.state][code // 4]
            yield self._put(edit, role, text)
        elif edit == "R":
            self.state = TURNED[self.state]
            yield self._put(edit, "assistant" if self.state == ASSISTANT else "user", text)


def _apply(batches) -> Iterator[pa.RecordBatch]:
    walk = None
    for batch in batches:
        out: list[tuple] = []
        for conv, codes, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "codes", "audit", "role", "text"))):
            if codes is not None:
                out.extend(walk.until_row() if walk else ())
                walk = _Walk(conv, codes, audit)
            else:
                out.extend(walk.next_row(role, text))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TURN_TYPES)], _TURN_COLS)
    rest = list(walk.until_row()) if walk else []
    if rest:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rest), _TURN_TYPES)], _TURN_COLS)


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The turns that ``plans`` (``plan_repairs`` of the same rows) leaves: conv_id, place
    (from 0), edit (K, R, or I for an inserted one), role, text.

    A conversation's turns follow one another, by place, within a partition; they stream,
    and none is held. Conversations that lose all rows have none here."""
    named = _turns(rows).filter(_fault(F.col("text")) != BLANK)
    none = F.lit(None).cast("string")
    edits = plans.select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"),
                         F.lit(None).cast("binary").alias("digest"), "codes", "audit")
    both = named.withColumns({"codes": none, "audit": none}).union(edits)
    order = ["conv_id", F.col("codes").isNull(), F.asc_nulls_first("turn"), "role", "digest"]
    return (both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "codes", "audit", "role", "text")
            .mapInArrow(_apply, "conv_id long, place long, edit string, role string, text string"))


def _digests(batches) -> Iterator[pa.RecordBatch]:
    conv, running = None, None
    out: list[tuple] = []
    for this, place, _, role, text in _rows(batches):
        if place == 0:
            if running is not None:
                out.append((conv, running.hexdigest()))
            conv, running = this, hashlib.sha256()
        running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])
            out.clear()
    if running is not None:
        out.append((conv, running.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the turns' ``role:text``, newline-joined. Takes
    the output of ``repaired_turns`` as it comes, in its partitions and order."""
    return turns.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation what ``plan_repairs`` finds, and the SHA-256 of the repaired turns.

    ``conversations``: a table with the conv_ids to report (default: those of ``rows``); one
    without rows has zeros, an empty audit and the digest of an empty text."""
    plans = settle(plan_repairs(rows))
    digests = turn_digests(repaired_turns(rows, plans))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = (plans if conversations is None else conversations).select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = (ids.join(plans.withColumnRenamed("conv_id", "c"), F.col("id").eqNullSafe(F.col("c")), "left")
           .join(digests.withColumnRenamed("conv_id", "d"), F.col("id").eqNullSafe(F.col("d")) , "left"))
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damage_turns(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults, as (conv_id, turn, role, text): by the CRC-32 of
    ``conv_id:turn`` modulo 20 a row is dropped (0), loses its text (1) or the ends of its
    sentences (2), stands twice (3), or is a user's (4). Nulls count as one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    rule = F.col("_rule")
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        (F.crc32(name) % 20).alias("_rule")).filter(rule != 0)
            .withColumn("text", F.when(rule == 1, "").when(rule == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(rule == 4, "user").otherwise(F.col("role")))
            .withColumn("_copy", F.explode(F.when(rule == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))
