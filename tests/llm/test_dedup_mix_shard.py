import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lograft.llm import mixing, queries, scratch
from lograft.llm.exact_dedup import exact_duplicates
from lograft.llm.mixing import mix_sources, targets
from lograft.llm.sharding import communication_matrix, shuffle_into_shards
from tests.conftest import SF001
from tests.llm import brute


# --- exact duplicates ---------------------------------------------------------

def plain_duplicates(rows, norm=lambda t: t):
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t or "")].append(d)
    out = []
    for d, t in rows:
        ids = groups[norm(t or "")]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids), d == keep))
    return out


CASES = [(1, None), (2, ""), (3, "same"), (4, "same"), (5, "Same"), (6, "x" * 300 + "a"), (7, "x" * 300 + "b"), (8, "x" * 300 + "a"),
         (9, "abcd"), (None, "same"), (None, "lonely"), (10, "twice"), (10, "twice"), (11, "é"), (12, "e\u0301"), (13, "y" * 500_000), (14, "y" * 500_000)]


def test_exact_duplicates(docs):
    got = exact_duplicates(docs(CASES)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_duplicates(CASES), key=repr)
    assert exact_duplicates(docs(CASES).limit(0)).collect() == []


def test_exact_duplicates_of_normalised_text_and_carried_columns(docs):
    got = exact_duplicates(docs(CASES), normalise=F.lower, carry={"cls": F.col("lang"), "n_text": F.length("text")}).collect()
    want = plain_duplicates(CASES, str.lower)
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)
    assert {r.cls for r in got} == {"en"} and max(r.n_text or 0 for r in got) == 500_000


def test_hot_copies_are_dealt(docs, monkeypatch):
    from lograft.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "HOT_GROUP", 10)
    rows = [(i, "copy") for i in range(300)] + [(i, f"text {i % 400}") for i in range(300, 900)]
    got = exact_duplicates(docs(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(plain_duplicates(rows))


def test_sieve_drops_nothing_wanted(spark):
    rows = spark.range(5000).withColumn("k", F.col("id") % 977)
    wanted = spark.range(0, 977, 3).select(F.col("id").alias("k"))
    marked = scratch.sieve_test(rows, scratch.sieve_cells(wanted, "k"), "k")
    assert marked.filter("k % 3 = 0 and not in_sieve").count() == 0
    assert marked.filter("in_sieve").count() < 1.1 * rows.filter("k % 3 = 0").count()


# --- mixing -------------------------------------------------------------------

def water(sizes, share=1.5, most=2.0):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            return {**out, **{s: level * weight[s] for s in open_}}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_the_water_level(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 5, 50, 1000, 20_000]) for s in ["a", "b", "B", "é", "", None, "z", "zz"]}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = water(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in want)


def mixed_rows():
    rng = random.Random(7)
    rows = [(i, "w " * int(rng.lognormvariate(4, 1)), rng.choice(["hot"] * 5 + ["a", "b", None])) for i in range(3000)]
    rows += [(5000 + i, "equal text here", "hot") for i in range(1500)]
    return rows + [(None, "no id", "a"), (7000, None, "a"), (7001, "", "empty"), (7002, "twice", "b"), (7002, "twice", "b")]


def test_mix(docs):
    rows = mixed_rows()
    df = docs(rows)
    got = mix_sources(df, keep=["lang"]).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.SPACE.findall(t or ""))
    want, taken = water(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.copies <= 2 and r.lang == "en"
        taken[r.source] += r.copies * r.size
    biggest = max(r.size for r in got)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2 * biggest, 0.02 * want[s])
    again = mix_sources(df.repartition(13), keep=["lang"]).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    other = mix_sources(df, seed="other").collect()
    assert sorted((r.doc_id or -1, r.copies) for r in other) != sorted((r.doc_id or -1, r.copies) for r in got)
    assert mix_sources(df.limit(0)).collect() == []


def test_the_mix_is_the_same_in_any_partitioning_without_ids(spark):
    """Half of the rows without an id, many of them equal: the same sample of texts each time,
    and cells that all of them share out."""
    rng = random.Random(3)
    rows = [(None, f"text {i} " * rng.randint(1, 6), "s", i % 3) for i in range(2000)] + [(None, "the same", "s", 1)] * 1500
    rows += [(i, f"text {i} " * rng.randint(1, 6), "s", 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    keep = ["text", "source", "n_chars"]

    def sample(parts):
        return Counter(map(tuple, mix_sources(df.repartition(parts), share=1.3, keep=keep).select("doc_id", "text", "n_chars", "copies").collect()))

    got = sample(4)
    assert got == sample(7) and sum(got.values()) == len(rows)
    assert Counter({(d, t, n): 0 for d, t, _, n in rows}).keys() == {(d, t, n) for d, t, n, _ in got}
    same = Counter({c: n for (_, t, _, c), n in got.items() if t == "the same"})
    assert sum(same.values()) == 1500 and set(same) == {1, 2} and abs(same[2] - 450) <= 1
    narrow = mix_sources(df, share=1.3).groupBy("doc_id", "size").sum("copies").collect()
    assert sum(r["sum(copies)"] for r in narrow) == sum(c * n for (*_, c), n in got.items())


def test_equal_rows_are_told_apart_in_runs(spark, monkeypatch):
    monkeypatch.setattr(scratch, "RUN", 16)
    df = spark.createDataFrame([(1, "a b", "s")] * 1000, "doc_id long, text string, source string")
    got = Counter(r.copies for r in mix_sources(df, share=1.25, keep=["text"]).collect())
    assert got == {1: 750, 2: 250}


def test_a_document_is_taken_once_per_integer_crossed(docs, monkeypatch):
    """One source, so the rate is share * size / size: every document as often as its step crosses integers."""
    monkeypatch.setattr(mixing, "SALTS", 4)
    got = mix_sources(docs([(i, "a b c d") for i in range(1000)]), share=1.25, most=2.0).collect()
    assert sum(r.copies for r in got) in (1249, 1250, 1251) and {r.copies for r in got} == {1, 2}


# --- sharding -----------------------------------------------------------------

def test_matrix_has_its_sums_and_its_law():
    m = communication_matrix([5, 0, 7, 1], [4, 4, 5], 3)
    assert m.sum(axis=1).tolist() == [5, 0, 7, 1] and m.sum(axis=0).tolist() == [4, 4, 5] and (m >= 0).all()
    # Multivariate hypergeometric: of 6 rows in two blocks of 3 and two shards of 3, P(k from block 0 in shard 0) = C(3,k)C(3,3-k)/20.
    seen = Counter(int(communication_matrix([3, 3], [3, 3], s)[0, 0]) for s in range(4000))
    for k, p in enumerate((1 / 20, 9 / 20, 9 / 20, 1 / 20)):
        assert abs(seen[k] / 4000 - p) < 0.03
    big = communication_matrix([4 * 10**9] * 5, [10**10] * 2, 1)  # beyond what one library draw allows
    assert big.sum(axis=0).tolist() == [10**10] * 2 and abs(big[0, 0] - 2 * 10**9) < 10**6
    with pytest.raises(ValueError):
        communication_matrix([1], [2], 0)
    assert communication_matrix([0, 0], [0, 0], 0).sum() == 0


def test_shards(docs, spark):
    rows = [(i, f"t{i % 50}") for i in range(997)] + [(None, None), (None, None), (3, "t3")]
    df = docs(rows).withColumn("shard", F.lit("clash"))
    got = shuffle_into_shards(df, 8, seed=5, blocks=16, parts=4).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(map(len, by.values())) == [125] * 8 and all(sorted(s) == list(range(125)) for s in by.values())
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    again = shuffle_into_shards(df.repartition(9), 8, seed=5, blocks=16, parts=4).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert shuffle_into_shards(df.limit(0), 8).collect() == []


def test_shuffle_is_uniform(spark):
    """Over seeds, a row is as likely in every shard and half, and neighbours part."""
    df = spark.range(64)
    place, together = np.zeros(4), 0
    for seed in range(12):
        rows = {r.id: r for r in shuffle_into_shards(df, 4, seed=seed, blocks=8, parts=2).collect()}
        for i in range(64):
            place[rows[i].shard] += 1
        together += sum(rows[i].shard == rows[i + 1].shard for i in range(63))
        assert len({(r.shard, r.slot) for r in rows.values()}) == 64
    assert (place == 12 * 16).all() and abs(together / (12 * 63) - 15 / 63) < 0.08


def test_sha_of_query(sf001, spark):
    from lograft.llm.queries import op2_exact_dedup
    from tests.conftest import SF001

    want = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in sf001("documents").collect()}
    assert {r.doc_id: r.text_sha256 for r in op2_exact_dedup(spark, SF001).collect()} == want


def test_shards_of_the_tables(spark, sf001):
    rows = queries.op9_sharding(spark, SF001).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in sf001("documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "rows", None) for r in rows)
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert sum(map(len, slots.values())) == len(rows) and all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_equal_rows_go_to_all_shards_and_blocks(spark):
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = shuffle_into_shards(df, shards=8)
    assert [r["count"] for r in got.groupBy("shard").count().collect()] == [2500] * 8
    spread = scratch.tell_apart(df.groupBy("doc_id", "text").agg(F.count("*").alias("n")), "n", "i")
    assert spread.select(F.pmod(F.xxhash64("doc_id", "text", "i"), F.lit(1024)).alias("b")).distinct().count() == 1024
