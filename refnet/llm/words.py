"""Words and word n-grams of whole texts as 64-bit hashes, for a batch of texts at a time.

Words are taken from UTF-8 bytes: A-Z is lower-cased, every other byte is kept. Both word classes used here can be
told from single bytes, because all bytes of a non-ASCII character are 0x80 or above.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(seed))


def _class(member) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, letters, everything beyond ASCII.
ALNUM = _class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: ``[^\x20\x09-\x0D]``: everything but ASCII white space.
NON_SPACE = _class(lambda b: b != 32 and not 9 <= b <= 13)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_RANDOM = stream(7, 256) | np.uint64(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array (null: empty) and the offsets of its rows in them."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def segment_hashes(data: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A polynomial hash of each segment; one runs from its start to the next start, bytes of value 0 don't count."""
    out = np.empty(len(starts), dtype=np.uint64)
    cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, len(data), _SLICE)), len(starts)])
    powers = np.ones(1, dtype=np.uint64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        lo, hi = int(starts[a]), int(starts[b]) if b < len(starts) else len(data)
        at = starts[a:b] - lo
        lengths = np.diff(np.r_[at, hi - lo])
        if lengths.max() > len(powers):
            powers = np.full(int(lengths.max()), _BASE, dtype=np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
        v = values[data[lo:hi]]
        v *= powers[np.arange(hi - lo, dtype=np.int64) - np.repeat(at, lengths)]
        out[a:b] = np.add.reduceat(v, at)
    return mix(out)


def word_hashes(texts: pa.Array, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and the offsets of each text's words in them."""
    data, at = buffers(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    inside = members[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    values = np.where(members, _RANDOM[_LOWER], np.uint64(0))
    return segment_hashes(data, starts, values), np.searchsorted(starts, at)


def ngram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbouring words; those of runs over the end of a text are for the caller to leave out."""
    n = max(0, len(words) - k + 1)
    h = np.full(n, np.uint64(k))
    for i, c in enumerate(stream(1000 + k, k) | np.uint64(1)):
        h += words[i : i + n] * c
    return mix(h)


def text_words(text: str, members: np.ndarray = ALNUM) -> np.ndarray:
    return word_hashes(pa.array([text.encode()], type=pa.binary()), members)[0]
