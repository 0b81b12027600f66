import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lograft.llm import jaccard_join, queries
from lograft.llm.components import connected_components
from lograft.llm.jaccard_join import jaccard_components, overlaps
from lograft.llm.scratch import TASK_ROWS, in_few_tasks, sieve_cells
from lograft.llm.words import PIECE, shingles, word_hashes
from tests.conftest import SF001
from tests.llm import brute


def check(df, rows, size, percent):
    got = sorted(map(tuple, jaccard_components(df, size, percent).collect()), key=repr)
    assert got == sorted(brute.jaccard(rows, size, percent), key=repr)


def near_copies(n, seed, base=60, groups=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    bases = [[rng.choice(words) for _ in range(rng.randint(5, base))] for _ in range(groups)]
    passage = [rng.choice(words) for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.4:
            w += passage
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 60), (3, 100)])
def test_against_all_pairs(docs, size, percent):
    rows = near_copies(120, size * percent)
    check(docs(rows), rows, size, percent)


def test_hand_cases(docs):
    rows = [(5, None), (6, ""), (7, " \t\r\n "), (8, "one"), (9, "ONE"), (10, "one two"), (11, "Öl Üb"), (12, "öl üb"),
            (None, "a b c d e f"), (3, "a b c d e f"), (None, "only without an id here now"), (4, "A  b\tc d\ne f"), (4, "a b c d e f"),
            (20, "x " * 30_000), (21, "x " * 30_001), (22, "y" * (PIECE + 5) + " z"), (23, "y" * (PIECE + 5) + " z")]
    check(docs(rows), rows, 4, 85)


def test_no_rows(docs):
    assert jaccard_components(docs([(1, "a")]).limit(0)).collect() == []
    assert sorted(jaccard_components(docs([(1, None), (2, "")])).collect()) == [(1, 0, 1, 0), (2, 0, 2, 0)]


def test_popular_ngrams_and_blocks(docs, monkeypatch):
    """Small bounds: many batches, popular n-grams, large groups in several blocks."""
    rows = near_copies(150, 5, base=30, groups=2)
    for name, value in (("BLOCK_SETS", 8), ("BLOCK_GRAMS", 200)):
        monkeypatch.setattr(jaccard_join, name, value)
    check(docs(rows).repartition(7), rows, 3, 70)


def test_segments_keep_popular_ngrams_apart():
    rng = np.random.default_rng(1)
    shared = np.sort(rng.integers(0, 1 << 63, 5, np.uint64))
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 20, np.uint64)])) for _ in range(jaccard_join.POPULAR + 3)]
    rows = jaccard_join._segments(list(range(len(sets))), sets, 0, 12)
    frags = [(f, b) for k, f, b in zip(*(rows.column(c).to_pylist() for c in ("k", "frag", "body"))) if k >= 0]
    marks = [m for _, b in frags for m in jaccard_join._read_segment(b)[2]]
    assert len(marks) == 5
    assert sum(len(jaccard_join._read_segment(b)[0]) for _, b in frags) == 20 * len(sets)
    back = jaccard_join._fragments([rows])
    kept = sum(len(b) // 11 for r in back for f, b in zip(r.column("frag").to_pylist(), r.column("body").to_pylist()) if f >= 0)
    assert kept == 0  # the others are in one set each


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB c\tÖ\n1.", max_size=40), min_size=1, max_size=6))
def test_word_hashes_are_those_of_the_words(texts):
    for kind, pattern in (("space", brute.SPACE), ("alnum", brute.ALNUM)):
        want = {}
        for text, got in zip(texts, word_hashes(pa.array(texts), kind)):
            words = pattern.findall(brute.fold(text))
            assert len(words) == len(got)
            for w, h in zip(words, got.tolist()):
                assert want.setdefault(w, h) == h
        assert len(set(want.values())) == len(want)


def test_word_hashes_of_long_texts_and_slices():
    long = "word Ünd\n" * 200_000
    table = pa.array(["skip", None, long, "word"])
    got = [h.tolist() for h in word_hashes(table.slice(1))]
    short = next(word_hashes(pa.array(["word ünd"]))).tolist()
    assert got[0] == [] and got[2] == short[:1] and len(got[1]) == 400_000
    assert got[1][:2] == short[:1] + next(word_hashes(pa.array(["Ünd"]))).tolist()
    assert len(shingles(np.array(got[1], np.uint64), 3)) == 2


def test_overlaps_by_fragment(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELLS", 16)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, 15, np.uint64)) for _ in range(7)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = overlaps(sets)
    shared = got[~np.eye(7, dtype=bool)]
    assert shared.tolist() == np.array(want)[~np.eye(7, dtype=bool)].tolist()
    assert overlaps(sets, 3).tolist() == [r[3:] for r in want[:3]]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (3, None)]
    pairs += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    top = {x: x for p in pairs if None not in p and p[0] != p[1] for x in p}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a in top and b in top and a != b:
            a, b = sorted((find(a), find(b)))
            top[b] = a
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in top}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_small_graphs_take_few_tasks(spark):
    """However many partitions a shuffle gives: each of their tasks and files costs the driver memory."""
    held = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.range(900).selectExpr("xxhash64(id) as a", "xxhash64(id + 1) as b")
        found = connected_components(edges, 900)
        cells = sieve_cells(edges, "a")
        few = spark.sparkContext.defaultParallelism
        assert found.count() == 901 and found.select("root").distinct().count() == 1
        assert len(found.inputFiles()) <= few and cells.rdd.getNumPartitions() <= few
        assert in_few_tasks(edges.distinct(), 101 * TASK_ROWS).rdd.getNumPartitions() == 101
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_query_of_the_tables(spark, sf001):
    rows = [(r.doc_id, r.text) for r in sf001("documents").collect()]
    got = queries.op1_ngram_jaccard_join(spark, SF001).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert sorted(map(tuple, got)) == sorted(brute.jaccard(rows, 4, 85))
