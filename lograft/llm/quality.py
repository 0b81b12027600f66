"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text is a vector of counts of its byte trigrams (hashed, case kept, so it sees
words as well as shouting, symbol runs and tables in any language) and of words
that repeat the two before, damped, weighted by rarity and projected on the main axes of the labelled sample (latent
semantic analysis). Every document is compared with every labelled vector, by
blocked matrix products; its ``NEIGHBOURS`` nearest vote with their labels, weighted
by similarity.

The labelled vectors are a sample of bounded size (``SAMPLE``), so they and the
axes are broadcast at any size of the corpus. Scoring is one pass, with no exchange.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import ready_workers
from .words import text_bytes, word_hashes

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 3000
#: Cells that trigrams are hashed to, axes kept, neighbours that vote.
CELLS, AXES, NEIGHBOURS = 2048, 64, 25
#: Trigrams that a repeated word counts as.
REPEAT = 6
#: Bytes of text, and documents, of one block.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 256


def trigram_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of trigram counts per text, the texts being raw[at[i]:at[i + 1]]."""
    out = np.zeros((len(at) - 1, CELLS), np.float32)
    for i in range(len(at) - 1):
        for low in range(int(at[i]), int(at[i + 1]) - 2, BLOCK_BYTES):  # pieces of a long text
            b = raw[low: min(low + BLOCK_BYTES + 2, int(at[i + 1]))].astype(np.uint32)
            cell = ((b[:-2] * np.uint32(2654435761) + b[1:-1] * np.uint32(2246822519) + b[2:] * np.uint32(3266489917)) >> np.uint32(15)) % (CELLS - 1)
            out[i] += np.bincount(cell, minlength=CELLS)
    return out


def _add_repeats(counts: np.ndarray, texts: pa.Array) -> None:
    """In the last cell: words that repeat the two before, in units of trigrams. (Two of
    a kind happen in any text.)"""
    for row, words in zip(counts, word_hashes(texts)):
        same = words[1:] == words[:-1]
        row[-1] = REPEAT * np.count_nonzero(same[1:] & same[:-1])


def _damped(counts: np.ndarray) -> np.ndarray:
    """Shares of a text's trigrams, damped: its length does not count."""
    total = counts.sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1))


def _blocks(texts: pa.Array):
    """Trigram shares of a few texts at a time."""
    raw, at = text_bytes(texts)
    i, n = 0, len(at) - 1
    while i < n:
        j = min(n, i + BLOCK_DOCS, max(i + 1, int(np.searchsorted(at, at[i] + BLOCK_BYTES, "right")) - 1))
        counts = trigram_counts(raw, at[i: j + 1])
        _add_repeats(counts, texts.slice(i, j - i))
        yield _damped(counts)
        i = j


def _sample_rows(batches):
    for batch in batches:
        done, rest = 0, ["label", "turn", "draw"]
        for block in _blocks(batch.column("text")):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in block], pa.binary()), *(batch.column(c).slice(done, len(block)) for c in rest)],
                                             ["vector", *rest])
            done += len(block)


class Model:
    """Axes and labelled vectors. Fitted on rows of trigram shares and labels 0 to 1."""

    def __init__(self, shares: np.ndarray, labels: np.ndarray, seed: int = 11):
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 1.0
        seen = (shares > 0).sum(axis=0)
        self.weight = np.log((1 + len(shares)) / (1 + seen)).astype(np.float32) + np.float32(1)
        x = shares * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)  # in place: the sample is the largest array of a driver
        # Main axes by randomised subspace iteration.
        axes = min(AXES, *x.shape) if len(x) else 0
        basis = np.random.default_rng(seed).standard_normal((CELLS, axes + 16 if axes else 0)).astype(np.float32)
        for _ in range(4 if axes else 0):
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        if axes:
            _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
            basis = basis @ turn[:axes].T
        self.basis = basis.astype(np.float32)
        self.points = self._unit(x @ self.basis)

    def _weighted(self, shares: np.ndarray) -> np.ndarray:
        return self._unit(shares * self.weight)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, shares: np.ndarray) -> np.ndarray:
        """0 to 1 for each row; the sample's mean label for a text without trigrams."""
        out = np.full(len(shares), self.prior, np.float64)
        some = shares.any(axis=1)
        if not len(self.labels) or not some.any():
            return out
        near = self._unit(self._weighted(shares[some]) @ self.basis) @ self.points.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 8 + 1e-9
        out[some] = np.clip((weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1), 0, 1)
        return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labelled documents, ``sample`` of them at most (by a hash of the id).

    Several labels of one id count as their mean; null labels and ids, and labels
    without a document, are left out, and take no room in the sample. Where an id stands
    on several rows, all its rows count; if they are too many, each id's first row (by a
    hash of the text) goes before any second one. The driver receives a vector per
    sampled row, never a text."""
    ready_workers(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    chosen = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("label")).dropna()
              .groupBy("_id").agg(F.avg("label").alias("label")).join(texts.select("_id").distinct(), "_id", "left_semi")
              .withColumn("draw", F.xxhash64("_id")).orderBy("draw", "_id").limit(sample))
    turn = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("text")))
    rows = (texts.join(F.broadcast(chosen), "_id")  # ``sample`` rows of a few numbers
            .withColumn("turn", turn).filter(F.col("turn") <= sample).select("text", "label", "turn", "draw")
            .mapInArrow(_sample_rows, "vector binary, label double, turn int, draw long")
            .orderBy("turn", "draw").limit(sample).select("label", "vector").sortWithinPartitions("vector", "label").toArrow())
    vectors = rows.column("vector").combine_chunks()
    raw = text_bytes(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors)[0]
    return Model(raw.view(np.float32).reshape(-1, CELLS), rows.column("label").to_numpy())


def _scores(batches, model, keep: list[str]):
    model = model.value
    for batch in batches:
        blocks = [model.score(b) for b in _blocks(batch.column("_text"))]
        scores = pa.array(np.concatenate(blocks) if blocks else [], pa.float64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), scores], [*keep, "score"])


def score_quality(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and score: 0 to 1, higher where
    label 1 is likelier.

    Every whole text is scored, from its text alone. Null and empty texts and those
    under three bytes get the mean label of the sample (1 without a sample). Copies
    score alike; repeated rows are scored each. A column named score is replaced.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    kinds = dict((f.name, f.dataType.simpleString()) for f in docs.schema.fields)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double"])
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(partial(_scores, model=spark.sparkContext.broadcast(model), keep=keep), schema)
