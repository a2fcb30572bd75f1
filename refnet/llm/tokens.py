"""Byte-level BPE ids of whole texts, a batch at a time.

Each distinct chunk is encoded once; a chunk is what stands between two places where the pre-tokenizer always cuts, so
ids of a text are the ids of its chunks one after another. Such places are:

* before one ASCII white-space byte that stands between two characters that aren't white space (a pre-token takes white
  space only as its one leading space or in a run of white space); a neighbour beyond ASCII counts only if it surely
  isn't white space (two-byte characters from U+00C0), elsewhere the chunk just goes on;
* between an ASCII letter and ASCII punctuation.

Chunks are known by 64-bit hashes; the table of known chunks starts afresh beyond ``max_known``. The same vocabulary
lies there as JSON and as ranks. New chunks are encoded from the ranks, which is several times faster, and those with
the special token's string by the JSON file's tokenizer, which takes that string for its id; tests hold both equal.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa

from refnet.llm.words import buffers, segment_hashes, stream

TOKENIZER = "byte_bpe_50k.json"

_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
# What a text may have before and after a cut: by its last and its first byte.
_FIRST = np.array([33 <= b <= 126 or 0xC3 <= b <= 0xDF for b in range(256)])
_ASCII = np.array([33 <= b <= 126 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
# Without the bar, so that the special token's string stays in one chunk.
_POINT = _ASCII & ~_LETTER & ~np.array([48 <= b <= 57 or b == 0x7C for b in range(256)])
_LEAD = np.array([0xC3 <= b <= 0xDF for b in range(256)])
_VALUES = stream(11, 256) | np.uint64(1)


def chunk_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where chunks begin: at every text's first byte and at every sure cut."""
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n > 2:
        before = _ASCII[data[:-2]]
        before[1:] |= _LEAD[data[:-3]] & (data[1:-2] >= 0x80)
        cut[1:-1] = _SPACE[data[1:-1]] & before & _FIRST[data[2:]]
        cut[1:] |= _LETTER[data[:-1]] & _POINT[data[1:]]
    # A cut looks at its neighbours; those must belong to the same text.
    begins, lasts = at[:-1][at[:-1] < n], at[1:][at[1:] > 0] - 1
    cut[lasts] &= ~_SPACE[data[lasts]]
    cut[begins] = True
    if len(begins):
        after = begins + 1  # what stands before it is the text's first byte, whose lead could be another text's
        after = after[after < n]
        cut[after] &= ~((data[after - 1] >= 0x80) & _SPACE[data[after]])
        cut[begins] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes binary arrays; one for each Python worker and tokenizer file."""

    _own: dict[str, Encoder] = {}

    def __init__(self, file: str, max_known: int = 1 << 19):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.special = "<|endoftext|>"
        with open(file.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.max_known = max_known
        self._clear()

    @classmethod
    def of(cls, file: str) -> Encoder:
        if file not in cls._own:
            cls._own[file] = cls(file)
        return cls._own[file]

    def _clear(self) -> None:
        """No chunk known. ``slots`` is an open-addressing table of entry numbers (0: free), entry 0 is a dummy."""
        self.slots = np.zeros(4 * self.max_known, np.int32)
        self.hashes = np.zeros(1, np.uint64)
        self.place = np.zeros(1, np.int64)  # of each entry's ids in ids
        self.size = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, 0 if it has none."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (hashes & mask).astype(np.int64)
        entry = self.slots[slot]
        miss = np.flatnonzero((entry > 0) & (self.hashes[entry] != hashes))
        while len(miss):
            slot[miss] = (slot[miss] + 1) & int(mask)
            entry[miss] = e = self.slots[slot[miss]]
            miss = miss[(e > 0) & (self.hashes[e] != hashes[miss])]
        return entry

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        plain = self.plain.encode_ordinary
        found = [self.tokenizer.encode(c, add_special_tokens=False).ids if self.special in c else plain(c) for c in chunks]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((x for e in found for x in e), np.uint32, int(size.sum()))
        entry = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.hashes, self.size = np.r_[self.hashes, hashes], np.r_[self.size, size]
        self.place = np.r_[self.place, len(self.ids) + np.cumsum(size) - size]
        self.ids = np.r_[self.ids, ids]
        mask = len(self.slots) - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        while len(entry):  # of those that want one free slot, the last gets it
            free = self.slots[slot] == 0
            self.slots[slot[free]] = entry[free]
            left = self.slots[slot] != entry
            entry, slot = entry[left], (slot[left] + 1) & mask

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the offsets of each text's ids in them."""
        data, at = buffers(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        starts = chunk_starts(data, at)
        hashes = segment_hashes(data, starts, _VALUES)
        entry = self._find(hashes)
        new = np.flatnonzero(entry == 0)
        if len(new):
            if len(self.hashes) + len(new) > 2 * self.max_known:
                self._clear()
                new = np.arange(len(hashes))
            unknown, first = np.unique(hashes[new], return_index=True)
            while len(unknown) > len(self.slots) // 2:  # one very long text of very many chunks
                self.slots = np.zeros(2 * len(self.slots), np.int32)
            ends = np.r_[starts[1:], len(data)]
            raw = data.tobytes()
            self._learn(unknown, [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in new[first].tolist()])
            entry[new] = self._find(hashes[new])
        place, size = self.place[entry], self.size[entry]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(place - (total - size), size) + np.arange(total[-1])]
        return ids, np.r_[0, total][np.searchsorted(starts, at)]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
