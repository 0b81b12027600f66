"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive words: some positions count, others are
ignored, so a substituted word spoils only the seeds that look at it. Test
items and documents are hashed under every mask at every position, and the
hashes are joined. Around each hit the texts are laid over each other and the words
compared in place; an overlap counts if enough words in a row agree but for a
share of substitutions. Short items, which masks may not fit, are also hashed as a whole.

Documents are hashed where they are read. A filter of fixed size, made from the
test hashes, holds back windows that cannot hit; the join after it is exact. Only
stretches of words around hits move.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import SIEVE_WORDS, ready_workers, settle
from .words import mix, word_hashes

#: The masks; 1 counts, 0 is ignored.
MASKS = ("11101011", "1101001011", "11011000111")
#: An overlap has so many words at least (or the whole item), of which this share agrees.
LEAST_WORDS, LEAST_SHARE = 13, 0.8
#: Items of so many words at most are also searched for as a whole; of so many at least, one word changed leaves the share.
SHORT, SPARE = 12, 5
_U = np.uint64


def _seeds(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each mask that fits, its length and the hash at every position."""
    for m, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n < 1:
            continue
        h = np.full(n, 0x9E3779B97F4A7C15 * (m + 1) & ((1 << 64) - 1), np.uint64)
        for j, c in enumerate(mask):
            if c == "1":
                h += words[j: j + n] * _U(0xD6E8FEB86659FD93 * (2 * j + 1) & ((1 << 64) - 1))
        yield len(mask), mix(h)


def _whole(words: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """n and the hash of n words in a row at every position; from ``SPARE`` words on, a hash
    without each one of them, all of which a true copy has."""
    count = len(words) - n + 1
    if count < 1:
        return

    def part(j):
        return words[j: j + count] * _U(0xD6E8FEB86659FD93 * (2 * j + 1) & ((1 << 64) - 1))

    total = np.zeros(count, np.uint64)
    for j in range(n):
        total += part(j)
    for j in range(n) if n >= SPARE else (None,):
        kind = _U(0x9E3779B97F4A7C15 * (100 + 16 * n + (j or 0)) & ((1 << 64) - 1))
        yield n, mix((total if j is None else total - part(j)) + kind)


def _item_seeds(batches):
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        for item, words in zip(ids, word_hashes(batch.column("text"), "alnum")):
            whole = len(words) if len(words) <= SHORT else 0
            for _, h in chain(_seeds(words), _whole(words, whole) if whole else ()):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(h), pa.int64()), pa.array(np.arange(len(h))), pa.array(h.view(np.int64)),
                                                  pa.array([whole] * len(h), pa.int32())], ["item_id", "at", "seed", "whole"])


def _item_words(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array([w.tobytes() for w in word_hashes(batch.column("text"), "alnum")], pa.binary())], ["item_id", "item"])


def _regions(batches, cells, lengths, longest):
    """Stretches of words around windows that may hit, by ``longest`` words (of any item) on
    either side: their words, and the hits. ``lengths`` are those of items that are
    searched for as a whole."""
    bits = cells.value
    for batch in batches:
        rows: list = []
        for i, words in enumerate(word_hashes(batch.column("text"), "alnum")):
            at, end, seed = [], [], []
            for length, h in chain(_seeds(words), *(_whole(words, n) for n in lengths)):
                cell = (h >> _U(6)) & _U(SIEVE_WORDS - 1)
                hit = np.flatnonzero((bits[cell] >> (h & _U(63))) & _U(1))
                at.append(hit)
                end.append(hit + length)
                seed.append(h[hit])
            if not at or not any(map(len, at)):
                continue
            at, end, seed = np.concatenate(at), np.concatenate(end), np.concatenate(seed)
            order = np.argsort(at, kind="stable")
            at, end, seed = at[order], end[order], seed[order]
            cut = np.flatnonzero(at[1:] - np.maximum.accumulate(end)[:-1] > 2 * longest) + 1
            for a, b in zip([0, *cut], [*cut, len(at)]):
                low, high = max(0, int(at[a]) - longest), min(len(words), int(end[a:b].max()) + longest)
                rows.append((i, low, words[low:high].tobytes(), at[a:b] - low, seed[a:b].view(np.int64)))
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0])), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int64()))], ["doc_id", "low", "words", "ats", "seeds"])


def best_overlap(agree: np.ndarray, share: float, least: int = LEAST_WORDS) -> tuple[int, int]:
    """Start and end of the stretch with the most agreement among those of ``least``
    words or more (the whole, if shorter): a word that agrees counts 1 - share, one that
    does not -share. If any such stretch has that share, so does this one."""
    least = max(0, min(least, len(agree)))
    gain = np.where(agree, 1 - share, -share)
    total = np.concatenate(([0.0], np.cumsum(gain)))
    floor = np.minimum.accumulate(total[: len(total) - least])  # for each end, starts that leave room
    end = least + int(np.argmax(total[least:] - floor + np.arange(len(floor)) * 1e-12))
    start = int(np.flatnonzero(total[: end - least + 1] == floor[end - least])[-1])
    return start, end


def _verify(batches, least: int, share: float):
    names = ["doc_id", "item_id", "n_agree", "n_words", "doc_word", "item_word"]
    for batch in batches:
        rows: list = []
        for doc, low, words, item_id, item, shift in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "low", "words", "item_id", "item", "shift"))):
            text, item = np.frombuffer(words, np.uint64), np.frombuffer(item, np.uint64)
            a, b = max(0, -shift), min(len(item), len(text) - shift)
            agree = text[a + shift: b + shift] == item[a:b]
            start, end = best_overlap(agree, share, least)
            same = int(agree[start:end].sum())
            if end - start >= min(least, len(item)) and same >= share * (end - start) - 1e-9:
                rows.append((doc, item_id, same, end - start, low + a + start + shift, a + start))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)], names)


def _sieve_bits(seeds: DataFrame) -> np.ndarray:
    """A filter of the test hashes with one bit each: SIEVE_WORDS 64-bit words at any
    number of items."""
    cells = (seeds.select(F.shiftrightunsigned("seed", 6).bitwiseAND(SIEVE_WORDS - 1).alias("cell"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), F.col("seed").bitwiseAND(63).cast("int")).alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(SIEVE_WORDS, np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents that contain passages of benchmark items, up to substituted words.

    Words are runs of digits, letters and characters beyond ASCII, A-Z as a-z. A
    passage counts from ``least_words`` words in a row (or all of a shorter item) of
    which ``least_share`` agree in place. Items of up to 12 words are also searched for as a
    whole, from 5 words on with any one word changed; an item of one word is found
    wherever the word stands, so callers may want only pairs of so many ``n_words``.
    Longer overlaps are found if a seed hits them: those of 13 or more words with few
    substitutions have one, some with every third or fourth word changed have none.

    Returns a row per pair of document and item, with the largest overlap: doc_id,
    item_id, n_agree, n_words (of the overlap), doc_word and item_word (where it
    starts, in words). Null and empty texts contain nothing. Rows with the same id
    are one document, as are those without an id; null item ids are an item. No
    rows on either side give no pairs. Other columns are not read.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    seeds = settle(items.mapInArrow(_item_seeds, "item_id long, at long, seed long, whole int"))
    lengths = sorted(r.whole for r in seeds.filter("whole > 0").select("whole").distinct().collect())  # at most SHORT
    words = settle(items.mapInArrow(_item_words, "item_id long, item binary"))
    longest = (words.agg(F.max(F.length("item"))).first()[0] or 0) // 8
    cells = spark.sparkContext.broadcast(_sieve_bits(seeds))
    regions = settle(rows.filter("text is not null")
                     .mapInArrow(partial(_regions, cells=cells, lengths=lengths, longest=longest), "doc_id long, low long, words binary, ats array<long>, seeds array<long>")
                     .withColumn("region", F.xxhash64("doc_id", "low", "words")))
    hits = (regions.select("region", F.explode(F.arrays_zip("ats", "seeds")).alias("h"))
            .select("region", F.col("h.ats").alias("here"), F.col("h.seeds").alias("seed")))
    laid = (hits.join(seeds, "seed").select("region", "item_id", (F.col("here") - F.col("at")).alias("shift")).distinct())
    pairs = (laid.join(regions.select("region", "doc_id", "low", "words").dropDuplicates(["region"]), "region")
             .join(words.withColumnRenamed("item_id", "_item"), F.col("item_id").eqNullSafe(F.col("_item")))
             .select("doc_id", "low", "words", "item_id", "item", "shift"))
    found = pairs.mapInArrow(partial(_verify, least=least_words, share=least_share),
                             "doc_id long, item_id long, n_agree long, n_words long, doc_word long, item_word long")
    best = F.max(F.struct("n_agree", (-F.col("n_words")).alias("less"), (-F.col("doc_word")).alias("first"), F.col("n_words"), F.col("doc_word"), F.col("item_word")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.n_agree", "b.n_words", "b.doc_word", "b.item_word"))
