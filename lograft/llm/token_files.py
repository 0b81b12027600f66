"""Token ids in binary blocks with Elias-Fano encoded boundaries.

A block holds the ids of many documents, one after another, and two monotone
sequences, each Elias-Fano encoded: where each document begins, and its id. A
sequence of m values below u takes about 2 + log2(u / m) bits a value, and a select
sample every ``SAMPLE`` ones finds any value without decoding the others.
Blocks are rows of a Parquet table, so they are written by Spark's committers
to any file system and a lost task leaves nothing behind. A second, small
table has the number of ids before each block.

Documents are sorted by id with one range exchange of their texts, and encoded
after it, where they stay.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import ready_workers
from .words import text_bytes

#: Ids of a block, unless one document has more.
BLOCK_IDS = 1 << 20
#: Ones between two samples of select.
SAMPLE = 64
#: Words of a generation kept with their ids by each Python worker, and bytes of text split at once.
#: Workers outlive their tasks: what they keep stands beside the steps that follow.
CACHE_WORDS, SLICE_BYTES = 1 << 18, 4 << 20
_MAGIC = b"EFT1"


class EliasFano:
    """A sequence of m non-decreasing values, 0 to ``top``."""

    def __init__(self, m: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.m, self.top, self.low_bits, self.low, self.high, self.samples = m, top, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        m, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // m).bit_length() - 1) if m else 0
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(m)
        bits = np.zeros(int(ones[-1]) + 1 if m else 0, np.uint8)
        bits[ones] = 1
        kept = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        return cls(m, top, low_bits, np.packbits(kept.astype(np.uint8).ravel(), bitorder="little"), np.packbits(bits, bitorder="little"),
                   ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        return struct.pack("<QQBQQ", self.m, self.top, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        m, top, low_bits, n_low, n_high = struct.unpack_from("<QQBQQ", data, at)
        at += struct.calcsize("<QQBQQ")
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        n = -(-m // SAMPLE)
        return cls(m, top, low_bits, low, high, np.frombuffer(data, "<u8", n, at)), at + 8 * n

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample to the i-th one."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        start = at >> 3
        bits = np.unpackbits(self.high[start: start + SAMPLE // 4 + 1], bitorder="little")
        bits[: at & 7] = 0
        ones = np.flatnonzero(bits)
        step = SAMPLE // 4 + 1
        while len(ones) <= left:  # a gap in the values
            more = np.unpackbits(self.high[start + step: start + 4 * step], bitorder="little")
            ones = np.concatenate([ones, np.flatnonzero(more) + step * 8])
            step *= 4
        return ((start * 8 + int(ones[left]) - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")[: None])[: self.m]
        i = np.arange(self.m)
        return ((ones - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One block: documents in ascending order of id, null ids first."""
    nulls = sum(d is None for d in doc_ids)
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.uint64)
    names = EliasFano.of(np.array([d - base for d in known], np.uint64))
    return (_MAGIC + struct.pack("<BQQq", width, len(ids), nulls, base) + EliasFano.of(ends).to_bytes() + names.to_bytes()
            + np.concatenate(ids).astype(f"<u{width}").tobytes())


class Block:
    """A block read back; ``ids(i)`` are those of its i-th document."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:4]) != _MAGIC:
            raise ValueError("not a block of token ids")
        self.width, self.n_docs, self.nulls, self.base = struct.unpack_from("<BQQq", view, 4)
        self.ends, at = EliasFano.read(view, 4 + struct.calcsize("<BQQq"))
        self.names, at = EliasFano.read(view, at)
        self.body = np.frombuffer(view, f"<u{self.width}", self.ends.top, at)

    def ids(self, i: int) -> np.ndarray:
        return self.body[self.ends.select(i): self.ends.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + int(x) for x in self.names.all()]


#: Characters that end a word's letters, as a token run of their own.
_TAIL = ".,;:!?$%&*#|"
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Byte-level models show bytes as characters: printable ones of Latin-1 as they are, the
#: others, in order, from 256 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
_BYTE_SHOWN = {b: 256 + i for i, b in enumerate(_HIDDEN)}
#: By byte: A-Z as a-z; the second byte of a letter of Latin-1 (after C3) in lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER_C3 = np.arange(256, dtype=np.uint8)
_LOWER_C3[[*range(0x80, 0x97), *range(0x98, 0x9F)]] += 0x20
#: By byte: white space, letters of ASCII, characters of ``_TAIL``.
_SPACE, _LETTER, _ENDS = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\v\f\r", range(0x61, 0x7B), _TAIL.encode()))


def _plain(word: str) -> bool:
    """Letters of ASCII or Latin-1 alone: one run, whose lower case and normal form are
    those of its characters."""
    return word.isalpha() and (word.isascii() or _LATIN.fullmatch(word) is not None)


def _folded(texts: pa.Array) -> pa.Array:
    """The texts with words of characters below U+0100 in lower case, and a space between a
    letter of theirs and a character of ``_TAIL`` after it. Such words are in normal form,
    whatever their case; others stay as they are."""
    raw, at = text_bytes(texts)
    if not len(raw):
        return pa.array([""] * len(texts), pa.large_string())
    low = _LOWER[raw]
    second = np.flatnonzero(raw == 0xC3) + 1
    low[second] = _LOWER_C3[raw[second]]
    letter = _LETTER[low]
    letter[second] = (raw[second] != 0x97) & (raw[second] != 0xB7)  # the signs for times and divided
    split = np.flatnonzero(letter[:-1] & _ENDS[raw[1:]]) + 1
    far = np.flatnonzero(raw > 0xC3)
    if len(far):  # words with any other character
        gap = _SPACE[raw]
        gap[at[at < len(raw)]] = True
        word = np.cumsum(gap, dtype=np.int32)
        other = np.zeros(int(word[-1]) + 1, bool)
        other[word[far]] = True
        low = np.where(other[word], raw, low)
        split = split[~other[word[split]]]
    body = np.insert(low, split, 0x20)
    ends = at + np.searchsorted(split, at)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(body)])


class _Words:
    """Encodes texts word by word with the tokenizers library, each word once.

    For a tokenizer that lower-cases, drops white space and works on runs of
    letters and of other characters alone, a text's ids are those of its words in
    order, and those of a Latin word with punctuation after it are those of the
    lower-cased letters and of the punctuation. So words are looked up in lower case
    and apart from their punctuation: few are left to be learnt and kept."""

    def __init__(self, path: str, width: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.kind, self.known, self.older = np.dtype(f"<u{width}"), {}, {}

    def _learn(self, words: list[str]) -> None:
        new, known, code, tokenize = [], self.known, self.kind.char, self.model.tokenize
        for w in words:  # lower-case letters are normal already and one token run: straight to the model
            if w.islower() and _plain(w):
                shown = w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_SHOWN)
                known[w] = array(code, [t.id for t in tokenize(shown)]).tobytes()
            else:
                new.append(w)
        for i in range(0, len(new), 4096):
            some = new[i: i + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False)):
                known[w] = array(code, e.ids).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of the different words. Words are kept in two generations: those that
        come up again move to the newer one, and the older one goes when that is full."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out = list(map(known.get, words))
        missing = [w for w, ids in zip(words, out) if ids is None]
        if missing:
            known.update((w, older[w]) for w in missing if w in older)
            self._learn([w for w in missing if w not in older])
            out = list(map(known.__getitem__, words))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the n + 1 offsets into them."""
        lists = pc.ascii_split_whitespace(_folded(texts))
        coded = lists.flatten().dictionary_encode()
        each = self._ids(coded.dictionary.to_pylist())
        length = np.fromiter(map(len, each), np.int64, len(each)) // self.kind.itemsize
        start = np.cumsum(length) - length
        pool = np.frombuffer(b"".join(each), self.kind)
        at = coded.indices.to_numpy(zero_copy_only=False)
        count = length[at] if len(at) else np.empty(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(count)))
        ids = pool[np.repeat(start[at] - ends[:-1], count) + np.arange(ends[-1])] if len(at) else np.empty(0, self.kind)
        offsets = lists.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]


def _encoder(path: str, width: int) -> _Words:
    """One for each worker process, whatever tasks it runs."""
    cache = sys.modules[__name__].__dict__.setdefault("_encoders", {})
    if (path, width) not in cache:
        cache[path, width] = _Words(path, width)
    return cache[path, width]


def _blocks(batches, path: str, end_id: int, width: int, block_ids: int):
    """Rows sorted by doc_id: the blocks of this range of documents."""
    words, task, seq = _encoder(path, width), TaskContext.get().partitionId(), 0
    end = np.array([end_id], f"<u{width}")
    names: list = []
    ids: list = []
    held = 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([task]), pa.array([seq]), pa.array([len(names)]), pa.array([held]), pa.array([pack_block(names, ids, width)], pa.binary())],
            ["part", "seq", "n_docs", "n_ids", "block"])

    for batch in batches:
        docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        at = text_bytes(texts)[1]
        i = 0
        while i < len(docs):  # so many texts at a time that their words fit in memory
            j = min(len(docs), max(i + 1, int(np.searchsorted(at, at[i] + SLICE_BYTES, "right")) - 1))
            flat, ends = words.encode(texts.slice(i, j - i))
            for d, a, b in zip(docs[i:j], ends[:-1], ends[1:]):
                x = np.concatenate((flat[a:b], end))
                if held and held + len(x) > block_ids:
                    yield out()
                    names, ids, held, seq = [], [], 0, seq + 1
                names.append(d)
                ids.append(x)
                held += len(x)
            i = j
    if names:
        yield out()


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, vocabulary: int = 1 << 16,
                      id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text, append ``end_id``, and write blocks in ascending order
    of id to ``path``/blocks, and where each begins to ``path``/starts.

    The tokenizer must drop white space and encode each white-space separated word
    alone. Null texts are empty: only the end id. Null ids come first; rows with the
    same id stand next to each other in order of their text. Two bytes an id
    where the vocabulary allows, else four. No rows give empty tables. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    width = 2 if vocabulary <= 1 << 16 else 4
    by_id = F.col("doc_id").asc_nulls_first()
    # An id, or none, on many rows is cut by the beginnings of their texts, which go in the order of the texts.
    blocks = (rows.repartitionByRange(by_id, F.substring("text", 1, 32)).sortWithinPartitions(by_id, "text")
              .mapInArrow(partial(_blocks, path=tokenizer_path, end_id=end_id, width=width, block_ids=block_ids),
                          "part long, seq long, n_docs long, n_ids long, block binary"))
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    # One row a block, as in the ids of a million: parts are summed first, then blocks within a part.
    sizes = spark.read.parquet(f"{path}/blocks").select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    line = Window.partitionBy("part").orderBy("seq")
    (sizes.join(before, "part").select("part", "seq", (F.col("before") + F.sum("n_ids").over(line) - F.col("n_ids")).alias("start"))
     .write.parquet(f"{path}/starts"))


def _documents(batches):
    for batch in batches:
        for start, data in zip(batch.column("start").to_pylist(), batch.column("block").to_pylist()):
            block = Block(data)
            at = block.ends.all().astype(np.int64)
            crc = [zlib.crc32(block.body[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.doc_ids(), pa.int64()), pa.array(start + at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """A row per document, read back from the blocks: doc_id, start (ids of all
    documents before it), n_tokens (with the end id), ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers)."""
    ready_workers(spark)
    blocks = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/starts"), ["part", "seq"])
    return blocks.select("start", "block").mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
