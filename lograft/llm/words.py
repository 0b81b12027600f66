"""Vectorised word hashing for Arrow batches of text.

Words are found and hashed by numpy over the raw UTF-8 bytes of many texts at
once: a word's hash is the difference of two prefix sums of a polynomial over
its bytes, modulo 2**64, then mixed. Memory per step is bounded by ``PIECE``
bytes of text however long a text is; what a text leaves is 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once.
PIECE = 1 << 18

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15  # odd
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_STEP = 0xD6E8FEB86659FD93  # odd
_tables: dict = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in a new array)."""
    h = h ^ (h >> _U(30))
    h *= _MIX1
    h ^= h >> _U(27)
    h *= _MIX2
    h ^= h >> _U(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, up to n."""
    if len(_tables.get("pow", ())) < n:
        n = max(n, PIECE + 1)
        inverse = pow(_MULT, -1, 1 << 64)
        for name, base in (("pow", _MULT), ("inv", inverse)):
            p = np.full(n, _U(base))
            p[0] = 1
            _tables[name] = np.multiply.accumulate(p)
    return _tables["pow"], _tables["inv"]


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, the same for A-Z and a-z."""
    if "bytes" not in _tables:
        v = mix(np.arange(1, 257, dtype=np.uint64) * _U(_STEP))
        v[65:91] = v[97:123]
        _tables["bytes"] = v
    return _tables["bytes"]


def _class(name: str) -> np.ndarray:
    """Which bytes belong to words. ``space``: all but space and 09-0D.
    ``alnum``: digits, letters and all bytes of characters beyond ASCII."""
    if name not in _tables:
        ok = np.ones(256, bool)
        if name == "space":
            ok[[0x20, *range(0x09, 0x0E)]] = False
        elif name == "alnum":
            ok[:128] = False
            for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
                ok[a:b] = True
        else:
            raise ValueError(name)
        _tables[name] = ok
    return _tables[name]


def _hash_piece(buf: np.ndarray, breaks: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``buf``; no word goes over a break."""
    ok = _class(kind)[buf]
    first = ok.copy()
    first[1:] &= ~ok[:-1]
    last = ok.copy()
    last[:-1] &= ~ok[1:]
    inside = breaks[(breaks > 0) & (breaks < len(buf))]
    if len(inside):
        both = inside[ok[inside] & ok[inside - 1]]
        first[both] = True
        last[both - 1] = True
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(len(buf) + 1)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.multiply(_byte_values()[buf], power[: len(buf)], out=total[1:])
    np.cumsum(total, out=total)
    return start, mix((total[end] - total[start]) * inverse[start])


def _long(buf: np.ndarray, kind: str) -> np.ndarray:
    """Word hashes of one text of any length, piece by piece."""
    ok, out, at = _class(kind), [], 0
    while at < len(buf):
        end = min(len(buf), at + PIECE)
        step = 4096
        while end < len(buf):  # cut where no word is cut
            gaps = np.flatnonzero(~ok[buf[end: end + step]])
            if len(gaps):
                end += int(gaps[0])
                break
            end, step = min(len(buf), end + step), step * 4
        out.append(_hash_piece(buf[at:end], np.empty(0, np.int64), kind)[1])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow array and the n + 1 offsets into them;
    a null text has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, texts.offset * (8 if wide else 4)) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0]: at[-1]], (at - at[0]).astype(np.int64)


def word_hashes(texts: pa.Array, kind: str = "space") -> Iterator[np.ndarray]:
    """For each text, in order, the 64-bit hashes of its words with A-Z folded to a-z."""
    raw, at = text_bytes(texts)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        j = min(j, n)
        buf = raw[at[i]: at[j]]
        if j == i + 1 and len(buf) > PIECE:
            yield _long(buf, kind)
        else:
            local = at[i: j + 1] - at[i]
            start, h = _hash_piece(buf, local, kind) if len(buf) else (np.empty(0, np.int64), np.empty(0, np.uint64))
            cut = np.searchsorted(start, local)
            for k in range(j - i):
                yield h[cut[k]: cut[k + 1]]
        i = j


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-word shingles; of a text with
    fewer words, one hash for the whole sequence; none without words."""
    n = len(words)
    if not n:
        return words
    take = min(size, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - take + 1, np.uint64)
        for j in range(take):
            h += words[j: n - take + 1 + j] * _U(pow(_STEP, j + 1, 1 << 64))
        h += _U(take * _MULT % (1 << 64))
    h = np.sort(mix(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]
