"""Language identification with bit-sliced Bloom filters of letter n-grams.

A text's n-grams are three neighbouring letters of a word, its beginning and end
counting as one. A language contains an n-gram that is frequent in its documents, in
itself and compared with the language where it is most frequent. All languages
share one table of cells: a cell is a bit mask with a bit per language, and an n-gram's
languages are set in each of its ``HASHES`` cells. The AND of these cells is the mask
of all languages that contain the n-gram, and others by chance. Per language, the bits of a
text's distinct n-grams are counted; the chance hits to be expected, which follow from how
full the language's filter is, are taken off; the largest count decides.

Counts are over all documents: tasks add up documents per n-gram and language, Spark
the tasks' sums. What reaches the driver and the workers is the table of cells, whose size
is fixed by ``cells`` and the number of languages, not by the corpus.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import ready_workers, settle
from .words import mix

#: Cells of the filters, and cells per n-gram.
CELLS, HASHES = 1 << 20, 3
#: A language contains the n-grams of at least this share of its documents ...
SHARE = 0.002
#: ... and at least this part of the share of the language where it is largest.
PART = 0.25
#: Languages of one mask.
BITS = 64
#: Characters of text taken apart at once, and counts that a task holds.
PIECE, HELD = 1 << 18, 1 << 20
UNKNOWN = "und"

_tables: dict[str, np.ndarray] = {}


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (marks count as letters of a word, all else is
    0), and whether it is a letter in the strict sense."""
    if not _tables:
        fold, strict = np.zeros(0x110000, np.int64), np.zeros(0x110000, bool)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))[0]
            if kind in "LM":
                low = chr(i).lower()
                fold[i], strict[i] = ord(low) if len(low) == 1 else i, kind == "L"
        _tables["fold"], _tables["strict"] = fold, strict
    return _tables["fold"], _tables["strict"]


def ngrams(text: str | None) -> np.ndarray | None:
    """The distinct n-grams of a text, each as one integer; None if it has no letter."""
    fold, strict = _letters()
    found, some = [], False
    tail = np.zeros(1, np.int64)
    for at in range(0, len(text or ""), PIECE):
        points = np.frombuffer(text[at: at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        some = some or bool(strict[points].any())
        last = at + PIECE >= len(text)
        codes = np.concatenate((tail, fold[points], tail[:1] * 0) if last else (tail, fold[points]))
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0  # one 0 between words
        keep[0] = True
        codes = codes[keep]
        tail = codes[-2:]
        inside = codes[1:-1] != 0
        found.append(np.unique(((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])[inside]))
    if not some:
        return None
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _cells(grams: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cells of each n-gram, one array per hash."""
    h = mix(grams.astype(np.uint64))
    step = mix(h) | np.uint64(1)
    return [((h + np.uint64(j) * step) % np.uint64(cells)).astype(np.int64) for j in range(HASHES)]


_COUNTS = "lang string, gram long, n long"


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, documents) of a task, and per language one with gram -1: its documents."""
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    docs: dict[str, int] = defaultdict(int)
    size = 0

    def add_up() -> int:
        for lang, parts in held.items():
            grams, n = sums.get(lang, (np.empty(0, np.int64), np.empty(0, np.int64)))
            new, times = np.unique(np.concatenate(parts), return_counts=True)
            both, where = np.unique(np.concatenate((grams, new)), return_inverse=True)
            sums[lang] = both, np.bincount(where, np.concatenate((n, times)), len(both)).astype(np.int64)
        held.clear()
        return sum(len(g) for g, _ in sums.values())

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in sums.items():
            for at in range(0, len(grams), 1 << 16):
                g = grams[at: at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n[at: at + (1 << 16)])], ["lang", "gram", "n"])
        sums.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            grams = ngrams(text.as_py())
            if grams is None:
                continue
            docs[lang] += 1
            held[lang].append(grams)
            size += len(grams)
            if size >= HELD:
                size = 0
                if add_up() >= HELD:
                    yield from rows()
    add_up()
    yield from rows()
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array([-1] * len(docs), pa.int64()),
                                          pa.array(list(docs.values()), pa.int64())], ["lang", "gram", "n"])


def _places(batches, cells: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _cells(batch.column("gram").to_numpy(), cells)
        bit = batch.column("bit")
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.concat_arrays([bit] * HASHES)], ["cell", "bit"])


class Model:
    """Languages, most documents first, and their filters: masks[w, cell] has a bit for
    each of the languages BITS * w to BITS * w + 63."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        full = [np.count_nonzero(masks[i // BITS] >> np.uint64(i % BITS) & np.uint64(1)) / masks.shape[1] for i in range(len(languages))]
        #: The chance that a filter has an n-gram that was never put into it.
        self.chance = np.array(full) ** HASHES

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language contains, without chance hits."""
        found = _cells(grams, self.masks.shape[1])
        out = np.zeros(len(self.languages))
        for w, slice_ in enumerate(self.masks):
            mask = slice_[found[0]] & slice_[found[1]] & slice_[found[2]]
            for i in range(BITS * w, min(BITS * (w + 1), len(self.languages))):
                out[i] = np.count_nonzero(mask >> np.uint64(i % BITS) & np.uint64(1))
        free = np.maximum(1 - self.chance, 1e-9)
        return np.maximum(out - len(grams) * self.chance, 0) / free

    def identify(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is the count's part of its sum with the runner-up's;
        without any hit it is 0 and the language is that of most documents."""
        grams = ngrams(text)
        if grams is None or not self.languages:
            return UNKNOWN, 0.0
        counts = self.counts(grams)
        best = int(counts.argmax())
        others = np.delete(counts, best)
        second = float(others.max()) if len(others) else 0.0
        top = float(counts[best])
        return self.languages[best], top / (top + second) if top else 0.0


def fit_languages(docs: DataFrame, cells: int = CELLS, share: float = SHARE, part: float = PART,
                  text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all documents with a language and a letter in their text.

    Rows with a null language or text, or no letter, teach nothing; repeated rows count
    each; without any row the model knows no language. The driver receives a row per
    language and the cells that are set: at most ``cells`` for 64 languages."""
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    counts = settle(rows.mapInArrow(_counted, _COUNTS).groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    about = sorted(counts.filter("gram = -1").select("lang", "n").collect(), key=lambda r: (-r.n, r.lang))
    languages = [r.lang for r in about]
    masks = np.zeros((max(1, -(-len(languages) // BITS)), cells), np.uint64)
    if not languages:
        return Model([], masks)
    table = spark.createDataFrame([(r.lang, r.n, i) for i, r in enumerate(about)], "lang string, docs long, i int")
    # Rates side by side: an n-gram has a row per language at most, in one aggregate row.
    rated = (counts.filter("gram >= 0").join(F.broadcast(table), "lang")  # a row per language
             .withColumn("rate", F.col("n") / F.col("docs")))
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    held = (rated.join(top, "gram").filter((F.col("rate") >= share) & (F.col("rate") >= F.col("top") * part)).select("gram", F.col("i").alias("bit")))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(BITS)).cast("int"))
    found = (held.mapInArrow(partial(_places, cells=cells), "cell long, bit int")
             .groupBy(F.floor(F.col("bit") / BITS).cast("int").alias("w"), "cell").agg(F.bit_or(one).alias("mask")).toArrow())
    masks[found.column("w").to_numpy(), found.column("cell").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return Model(languages, masks)


def _identified(batches, model, keep: list[str]) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        found = [model.identify(t.as_py()) for t in batch.column("_text")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            [*keep, "lang_pred", "score"])


def identify_languages(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all), lang_pred and score (0 to 1).

    Every whole text is judged, from its text alone. Null and empty texts, those without
    a letter, and all texts where the model knows no language are ``und`` with score 0.
    Equal counts go to the language of more documents, then to the first by name. Repeated
    rows are judged each; columns named lang_pred and score are replaced."""
    spark = docs.sparkSession
    ready_workers(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    kinds = dict((f.name, f.dataType.simpleString()) for f in docs.schema.fields)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double"])
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(partial(_identified, model=spark.sparkContext.broadcast(model), keep=keep), schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == 0, F.lit(False))
