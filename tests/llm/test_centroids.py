import hashlib
import math

import numpy as np
import pytest

from lograft.llm import queries
from lograft.llm.centroids import LARGEST, cluster_vectors, nearest, walsh_hadamard, walsh_order
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<double>, cluster int, x int, v string"


def plain(rows, clusters, rounds, width=64, scale=256, seed="2"):
    """By every distance, in Python integers. Rows (id, vector), results by row."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    fit = [max(map(abs, v)) < LARGEST for _, v in kept]
    name = [hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    own = [k for k in range(len(kept)) if fit[k]]
    cents = [kept[k][1] for k in sorted(own, key=lambda k: (name[k], kept[k][1]))[:clusters]]

    def assign():
        out = {}
        for k in own:
            d = [sum((a - b) ** 2 for a, b in zip(kept[k][1], c)) for c in cents]
            out[k] = (d.index(min(d)), min(d))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(cents)):
            mine = [kept[k][1] for k in own if at[k][0] == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    at, out = assign(), []
    for k, (i, _) in enumerate(kept):
        if k not in at:
            out.append((i, None, None, None, None, None))
            continue
        c, d = at[k]
        out.append((i, c, d, sum(x for y, x in at.values() if y == c), sum(x for _, x in at.values()),
                    hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 7, 8, "z") for i, v in rows], SCHEMA)
    return sorted(map(tuple, cluster_vectors(df, **how).collect()), key=repr)


def test_transform_is_orthogonal_and_ordered():
    order = walsh_order(16)
    h = walsh_hadamard(np.eye(16, dtype=np.int64), order).T
    assert (h @ h.T == 16 * np.eye(16)).all()
    assert [(a != b).sum() for a, b in ((r[1:], r[:-1]) for r in h)] == list(range(16))


@pytest.mark.parametrize("top", [3, 200, 1 << 26])
def test_nearest_is_exact_with_ties(top):
    rng = np.random.default_rng(top)
    x, c = rng.integers(-top, top, (300, 64)), rng.integers(-top, top, (17, 64))
    c[9], x[5], c[12] = c[2], c[2], x[7]
    where, far = nearest(x, c)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (where == d.argmin(1)).all() and (np.asarray(far, np.int64) == d.min(1)).all()


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=64) * 0.2).tolist()) for i in range(150)]
    assert run(spark, rows, clusters=9, rounds=3) == plain(rows, 9, 3)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(rng.normal(size=64) * 3).tolist() for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(4, good[4])] * 40 + [(None, good[1]), (None, good[2])]  # copies, null ids
    rows += [(100, None), (101, []), (102, good[0][:63]), (103, [*good[0][:63], None]), (104, [*good[0][:63], float("nan")]),
             (105, [*good[0][:63], float("inf")]), (106, good[0] + [1.0]), (107, [1e30] * 64), (108, [400000.0] * 64), (109, [-0.001] * 64)]
    for clusters in (1, 5, 60):
        assert run(spark, rows, clusters=clusters, rounds=2) == plain(rows, clusters, 2)
    assert run(spark, [], clusters=3) == []
    assert run(spark, [(1, None), (2, [1e300] * 64)]) == [(2, None, None, None, None, None)]


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    want = sorted(map(tuple, cluster_vectors(df, clusters=7, rounds=2).collect()))
    assert want == sorted(map(tuple, cluster_vectors(df.repartition(13, "label"), clusters=7, rounds=2).collect()))


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = queries.op12_centroid_clustering(spark, SF001)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 40, 5)
