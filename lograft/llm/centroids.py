"""Centroid clustering of integer vectors, with nearest centroids found by
progressive search over Walsh-Hadamard coefficients.

The transform H of a vector holds sums and differences of its components: H is
made of 1 and -1, its rows are orthogonal, so ``|H x - H c|^2 = width * |x - c|^2``
and all of it is exact in integers. The coefficients go coarse to fine, by their
number of sign changes. The squared differences of the first few are a lower
bound of the whole distance, the whole distance to the centroid that looks
nearest is an upper bound of the least one; a centroid whose bound is strictly
above it is out. Those that are left go on through the finer coefficients, and
whoever is left at the end has its exact distance, ties included.

A round is one pass over the vectors: a task adds up its members' components per
cluster and gives a row per cluster and component, so neither a large cluster nor a
vector that many rows hold makes a large task. Only centroids and sums, a
fixed number of rows, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ready_workers, settle

#: Integer components from here on have distances that a long cannot hold.
LARGEST = 1 << 27
#: Components below this keep all sums of the transform's squares within 64 bits.
NARROW = 1 << 20
#: Coefficients compared with all centroids before the first elimination.
FIRST = 4
#: Differences held at once.
CELLS = 1 << 20


def walsh_order(width: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix of this size by their number of sign changes."""
    h = walsh_hadamard(np.eye(width, dtype=np.int64), np.arange(width))
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The transforms of the rows of ``x``, unscaled, coefficients by ``order``."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2)
        half *= 2
    return x.reshape(n, width)[:, order]


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the nearest row of ``c`` (the first of equally near ones) and
    the squared distance, both exact. Integer arrays with a power of two of columns."""
    if max(abs(int(v)) for a in (x, c) for v in (a.min(), a.max())) >= NARROW:
        x, c = x.astype(object), c.astype(object)  # integers of any length
    width = x.shape[1]
    order = walsh_order(width)
    x, c = walsh_hadamard(x, order), walsh_hadamard(c, order)
    head = min(FIRST, width)
    part = sum((x[:, None, j] - c[None, :, j]) ** 2 for j in range(head))
    guess = part.argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    row, col = np.nonzero(part <= bound[:, None])
    part = part[row, col]
    low = head
    while low < width:
        high = min(2 * low, width)
        part = part + ((x[row, low:high] - c[col, low:high]) ** 2).sum(axis=1)
        stay = np.asarray(part <= bound[row], dtype=bool)
        row, col, part, low = row[stay], col[stay], part[stay], high
    # Rows stand in order, and each has its guess at least.
    best = np.minimum.reduceat(part, np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))))
    hit = np.flatnonzero(np.asarray(part == best[row], dtype=bool))
    _, first = np.unique(row[hit], return_index=True)
    return col[hit[first]], best // width


def _pieces(batches, centroids: np.ndarray) -> Iterator[tuple]:
    """(batch, rows that have components, those, cluster, distance) in pieces of bounded size."""
    size = max(1, CELLS // max(1, len(centroids)))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            lists = part.column("v")
            known = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(known), -1) if len(known) else np.empty((0, 0), np.int64)
            near = nearest(x, centroids) if len(known) and len(centroids) else (np.empty(0, np.int64),) * 2
            yield (part, known[: len(near[0])], x, *near)


def _sums(batches, centroids: np.ndarray):
    """Rows (cluster, dim, s, n): sums of the task's members."""
    total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
    for _, _, x, cluster, _ in _pieces(batches, centroids):
        if len(x):
            np.add.at(total, cluster, x)
            count += np.bincount(cluster, minlength=len(count))
    some = np.flatnonzero(count)
    width = total.shape[1]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(some, width), pa.int32()), pa.array(np.tile(np.arange(width), len(some)), pa.int32()),
         pa.array(total[some].ravel(), pa.int64()), pa.array(np.repeat(count[some], width), pa.int64())], ["cluster", "dim", "s", "n"])


def _assign(batches, centroids: np.ndarray):
    for batch, rows, _, cluster, distance in _pieces(batches, centroids):
        where = np.full(batch.num_rows, -1, np.int64)
        where[rows] = np.arange(len(rows))
        take = pa.array(where, mask=where < 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(np.asarray(cluster, np.int32)).take(take), pa.array(np.asarray(distance, np.int64)).take(take)],
            ["vec_id", "cluster", "distance"])


def integer_vectors(vectors: DataFrame, width: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) for each row whose vector has exactly ``width`` components, none null, NaN
    or infinite: ``v`` holds floor(scale * x), or is null where one of these has ``LARGEST``
    or more as its magnitude."""
    kept = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
            .filter(F.size("x") == width)
            .filter(F.forall("x", lambda e: F.coalesce(F.abs(e) < F.lit(float("inf")), F.lit(False)))))
    exact = F.forall("x", lambda e: F.abs(e) < F.lit(float(LARGEST // scale)))
    return kept.select("vec_id", F.when(exact, F.transform("x", lambda e: F.floor(e * scale).cast("int"))).alias("v"))


def cluster_vectors(vectors: DataFrame, clusters: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: str = "2",
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Vectors by nearest of ``clusters`` centroids after ``rounds`` rounds of assignment and
    averaging, all in exact integers.

    Takes the rows of ``integer_vectors``; other rows are left out. The first centroids
    are the vectors with the smallest hexadecimal SHA-256 of ``seed:id``, in that order
    (a null id counts as the word null; equal ids by their components); with fewer
    vectors there are fewer centroids. A round assigns every vector to its nearest
    centroid (squared Euclidean distance, ties to the smaller number) and replaces each
    centroid that has members by the floor of their mean. Returns per row: vec_id,
    cluster, distance (squared), cluster_inertia and inertia (distances summed over its
    cluster and over all; null if no long holds them), centroid_sha256 (of the
    components of its final centroid, comma-joined). Repeated rows are vectors of their
    own. Rows with a component too large for exact distances (``LARGEST``) form no
    centroid and come back with a null cluster and distance. Other columns of ``vectors`` are
    not read. No rows give no rows. ``width`` has to be a power of two.
    """
    if width < 1 or width & (width - 1):
        raise ValueError(f"width has to be a power of two, not {width}")
    spark = vectors.sparkSession
    ready_workers(spark)
    kept = settle(integer_vectors(vectors, width, scale, id_col, vector_col))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = kept.filter("v is not null").select("v").orderBy(hashed, "v").limit(clusters).collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(len(first), width)

    sums = "cluster int, dim int, s long, n long"
    for _ in range(rounds if first else 0):
        means = (kept.select("v").mapInArrow(partial(_sums, centroids=centroids), sums).groupBy("cluster", "dim")
                 .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")))
        centroids = centroids.copy()
        for r in means.collect():  # clusters * width rows at most
            centroids[r.cluster, r.dim] = int(r.s) // r.n

    found = settle(kept.mapInArrow(partial(_assign, centroids=centroids), "vec_id long, cluster int, distance long"))
    inertia = {r.cluster: int(r.d) for r in found.filter("cluster is not null").groupBy("cluster")
               .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    about = [(c, fits(d), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, d in sorted(inertia.items())]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # A row per cluster: bounded by ``clusters``.
    return found.join(F.broadcast(table), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
