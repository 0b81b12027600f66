import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from lograft.llm import queries, repair
from lograft.llm.repair import Chain, damage_turns, plan_repairs, repair_conversations, repaired_turns, solve, turn_digests, ways_through
from tests.conftest import SF01, SF001

SCHEMA = "conv_id long, turn long, role string, text string, codes string, digest int, place int, n long"
GOOD_ROLES = re.compile(r"(s?(ua)+)?")


def plain_audit(rows):
    """(cost, audit, repaired rows) of (role, text, fault) rows by every sequence of edits
    with up to two insertions in a place."""
    found = []
    edits = []
    for role, text, fault in rows:
        mine = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            mine += [("K", more, (role, text)), ("R", 1 + more, ("user", text)), ("R", 1 + more, ("assistant", text))]
        edits.append(mine)
    new = [(("I", 5, (r, "")),) for r in ("user", "assistant")]
    places = [(), *new, *(a + b for a, b in itertools.product(new, new))]
    for inserts in itertools.product(places, repeat=len(rows) + 1):
        if sum(map(len, inserts)) > 3:
            continue
        for chosen in itertools.product(*edits):
            steps = [*inserts[0], *(x for e, more in zip(chosen, inserts[1:]) for x in (e, *more))]
            left = [s[2] for s in steps if s[2] is not None]
            if GOOD_ROLES.fullmatch("".join(r[:1] or " " for r, _ in left)):
                found.append((sum(s[1] for s in steps), "".join(s[0] for s in steps), left))
    return min(found, key=lambda f: f[:2])


def faults_of(rows):
    """(role, text, fault) of (turn, role, text) rows, in their order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, out = set(), []
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def walk(rows):
    """As ``plain_audit``, by growing the best audit per state row by row, for longer ones."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", [])}

    def offer(table, state, cost, audit, left):
        if state is not None and (state not in table or (cost, audit) < table[state][:2]):
            table[state] = (cost, audit, left)

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, left) in list(table.items()):
                for r in ("user", "assistant"):
                    offer(table, step[state].get(r[0]), cost + 5, audit + "I", left + [(r, "")])
        return table

    for role, text, fault in rows:
        table = {}
        for state, (cost, audit, left) in inserted(best).items():
            offer(table, state, cost + 2, audit + "D", left)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                offer(table, step[state].get(role[:1]), cost + more, audit + "K", left + [(role, text)])
                for r in ("user", "assistant"):
                    offer(table, step[state].get(r[0]), cost + more + 1, audit + "R", left + [(r, text)])
        best = table
    return min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])


def plain(rows, by=walk):
    """Results by conversation of (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for c, *r in rows:
        convs[c].append(tuple(r))
    out = {}
    for c, mine in convs.items():
        marked = faults_of(mine)
        turns = {t for t, _, _ in mine if t is not None}
        initials = [r[:1] for r, _, _ in marked]
        cost, audit, left = by(marked)
        kinds = [f for _, _, f in marked]
        out[c] = (c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
                  kinds.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        rule = zlib.crc32(name.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if rule == 1 else re.sub("[.!?]", "", x) if rule == 2 else x
        out += [(c, t, "user" if rule == 4 else r, x)] * (0 if rule == 0 else 2 if rule == 3 else 1)
    return out


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "0", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)
    return {r[0]: tuple(r) for r in repair_conversations(df).collect()}


CODE = {("s", ""): "0", ("u", ""): "4", ("a", ""): "8", ("t", ""): "c"}


def code(role, fault):
    return f"{'sua'.find(role[:1]) % 4 * 4 + ['', 'truncated', 'blank', 'duplicate'].index(fault):x}"


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_equals_every_sequence_of_edits(n):
    kinds = [("system", ""), ("user", ""), ("assistant", ""), ("tool", ""), ("system", "truncated"), ("user", "truncated"),
             ("assistant", "truncated"), ("user", "blank"), ("assistant", "duplicate")]
    for rows in itertools.product(kinds, repeat=n):
        marked = [(r, "x", f) for r, f in rows]
        want = walk(marked)
        if n < 3:
            assert plain_audit(marked) == want
        assert solve("".join(code(r, f) for r, f in rows)) == want[:2]


def test_pieces_put_together_equal_the_whole():
    draw = random.Random(5)
    for n in (1, 7, 40, 300):
        codes = "".join(draw.choice("0123456789abcdef44448888") for _ in range(n))
        for size in (1, 3, 16):
            chain = Chain()
            for i in range(0, n, size):
                chain.add(ways_through(codes[i:i + size]))
            assert chain.solve() == solve(codes)


def test_conversations_equal_brute_force(spark):
    draw = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "u", "", None]
    texts = ["a b.", "c?", "d! \n", "e", "", " \t", None, "é.", "f"]
    rows = []
    for c in range(60):
        rows += [(c, draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)) for _ in range(draw.randrange(1, 9))]
    rows += [(None, t, "user", "x.") for t in (1, None, 1, 5)] + [(77, None, "user", "b."), (77, None, "assistant", "a.")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows) == run(spark, list(reversed(rows)), parts=7)


def test_a_long_conversation_in_pieces(spark):
    """Half of all rows are one conversation's, a third of those one text's."""
    draw = random.Random(8)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(5, draw.randrange(4000), draw.choice(roles), draw.choice(["ok.", f"text {i}.", f"cut {i}"])) for i in range(3000)]
    rows += [(5, 7, "user", "same.")] * 700
    rows += [(100 + i // 4, i % 4, roles[i % 2], f"t {i}.") for i in range(3000)]
    got, want = run(spark, rows), plain(rows)
    assert got == want and len(got[5][7]) >= 3700
    old = repair.PIECE
    assert old < 3000


def test_no_rows_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).collect() == []
    ids = spark.createDataFrame([(1, 0, "user", "a.", "", 0, 0, 0), (1, 1, "x", "b.", "", 0, 0, 0), (None, 0, "y", "z", "", 0, 0, 0)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, repair_conversations(empty, ids).collect()), key=repr) == [
        (1, 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_repaired_turns_alternate(spark):
    df = damage_turns(spark.read.parquet(f"{SF001}/conversations.parquet"))
    turns = repaired_turns(df, plan_repairs(df))
    by = defaultdict(list)
    for r in turns.collect():
        by[r.conv_id].append(r)
    for mine in by.values():
        assert [r.place for r in mine] == list(range(len(mine)))
        assert GOOD_ROLES.fullmatch("".join(r.role[0] for r in mine))
    got = {r.conv_id: r.repaired_sha256 for r in turn_digests(turns).collect()}
    assert got == {c: hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in m).encode()).hexdigest() for c, m in by.items()}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = plain_damage(rows)
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    assert sorted(map(tuple, damage_turns(df).collect()), key=repr) == sorted(damaged, key=repr)
    want = plain(damaged)
    for c in {r[0] for r in rows} - set(want):
        want[c] = (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = queries.op11_conversation_repair(spark, SF01)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r) for r in got.collect()} == want and len(want) == got.count()
