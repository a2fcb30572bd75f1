"""Benchmark decontamination with suffix arrays of the training text.

Each slice of a partition is a shard: its words are put into one sequence, and a suffix array sorts the places of that
sequence by the words that follow, as deep as a window. Every suffix of every benchmark item, cut to a window, is looked
up by binary search; the places of an interval are its occurrences. Occurrences of neighbouring suffixes at
neighbouring places are merged into the longest verbatim matches, with their places in text and item.

Windows that several items share are searched once: a *passage* is a run of windows that the same items have one after
another, wherever it lies in each of them. A match names its passage by the first item that has it, and counts the others;
all items of a text's passages are in its ``item_ids``. So a prompt that a thousand items begin with costs as much as one.

Only words of the benchmark can be part of a match, so a suffix counts in the array only if the words of the shortest
window all occur in some item; words are numbered by that vocabulary. Nothing is shuffled. The benchmark is read in
blocks of about ``block_bytes``, each sent to all tasks; each block is one more pass over the same rows.

Defined results: null text and text without words have no words and are clean; an item without words has no window; a
null item_id counts as the empty string, rows with the same item_id are one item; each row has its own result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import carried, extended, pieces, utf8
from refnet.llm.words import ALNUM, mix, word_hashes

WINDOW = 13
MATCH = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32()), ("items", pa.int32())])
MATCHES = "array<struct<start:int,length:int,item_id:string,item_start:int,items:int>>"


class Suffixes:
    """All distinct suffixes of some items, cut to a window, as keys over the items' own vocabulary, and their passages.

    ``passage`` and ``place`` say of each suffix which passage it is part of and where; ``holders`` lists each passage's
    items and where it begins in them.
    """

    def __init__(self, item_ids: list[str], texts: list[bytes], window: int):
        hashes, at = word_hashes(pa.array(texts, pa.binary()), ALNUM)
        self.item_ids, self.window = item_ids, window
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        self.few = np.zeros(1 << 16, dtype=bool)  # what the low bits of a word's hash can be
        self.few[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        sizes = np.diff(at)
        each = np.where(sizes >= window, sizes - window + 1, np.minimum(sizes, 1))  # windows of each item
        item = np.repeat(np.arange(len(texts)), each)
        offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        length = np.minimum(sizes, window)[item]
        self.shortest = int(length.min()) if len(length) else 0
        self.bits = max(1, len(self.vocabulary).bit_length())
        padded = np.r_[number + 1, np.zeros(window, np.int64)].astype(np.uint64)
        inside = np.arange(window)[None, :] < length[:, None]
        words = np.where(inside, padded[(at[:-1][item] + offset)[:, None] + np.arange(window)], np.uint64(0))
        # Equal suffixes are one, with all its (item, offset) in order.
        keys = self.keys(words.T)
        order = np.lexsort((offset, item, *keys[::-1]))
        new = np.ones(len(order), bool)
        if len(order) > 1:
            new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
        cut = np.r_[np.flatnonzero(new), len(order)]
        first = order[cut[:-1]]
        self.length = length[first]
        top = np.uint64((1 << self.bits) - 1)
        self.low, self.high = [k[first] for k in keys], self.keys(np.where(inside[first], words[first], top).T)
        self._passages(item[order], offset[order], cut)

    def _passages(self, item: np.ndarray, offset: np.ndarray, cut: np.ndarray) -> None:
        """Suffixes with the same items, each as far behind in all of them, are of one passage."""
        n = len(cut) - 1
        count = np.diff(cut)
        begin = offset[cut[:-1]] if n else np.zeros(0, np.int64)
        behind = offset - np.repeat(begin, count)
        # A hash of (item, how far behind the first) of all holders; the first item's own place is the place in the passage.
        with np.errstate(over="ignore"):
            each = mix(mix(item.astype(np.uint64) + np.uint64(1)) ^ (behind.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            names = np.add.reduceat(each, cut[:-1]) if n else np.zeros(0, np.uint64)
        _, some, self.passage = np.unique(names, return_index=True, return_inverse=True)
        self.place = begin
        self.holders = [(item[cut[x] : cut[x + 1]], behind[cut[x] : cut[x + 1]]) for x in some.tolist()]

    def ids_of(self, passages: tuple[int, ...]) -> list[str]:
        """The ids of all items that hold any of the passages, sorted."""
        held = np.unique(np.concatenate([self.holders[p][0] for p in passages]))
        return sorted({self.item_ids[i] for i in held.tolist()})

    def keys(self, words) -> list[np.ndarray]:
        """Words of each depth packed into as few 64-bit keys as hold them, first words first."""
        per = 64 // self.bits
        out = []
        for a in range(0, self.window, per):
            key = np.zeros(len(words[0]), np.uint64)
            for i in range(a, a + per):
                key <<= np.uint64(self.bits)
                if i < self.window:
                    key |= words[i]
            out.append(key)
        return out

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Of each word, counted from 1; 0 for words that no item has."""
        out = np.zeros(len(hashes), np.uint64)
        some = np.flatnonzero(self.few[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        to = np.minimum(np.searchsorted(self.vocabulary, hashes[some]), len(self.vocabulary) - 1)
        hit = self.vocabulary[to] == hashes[some]
        out[some[hit]] = to[hit] + 1
        return out


def _bound(keys: list[np.ndarray], wanted: list[np.ndarray], upper: bool) -> np.ndarray:
    """Binary search of many keys of several columns at once: the first place not below (upper: above) each."""
    lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]))
    while (open_ := lo < hi).any():
        mid = np.minimum((lo + hi) // 2, len(keys[0]) - 1)
        below, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for k, w in zip(keys, wanted, strict=True):
            have = k[mid]
            below |= same & (have < w)
            same &= have == w
        below |= same & upper
        lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
    return lo


def shard_matches(hashes: np.ndarray, at: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, ...]:
    """(text, start, length, passage, place in it) of the longest matches in the texts whose words lie at ``at``."""
    none = (np.zeros(0, np.int64),) * 5
    if not len(hashes) or not len(tests.length):
        return none
    number = tests.numbers(hashes)
    # How many words from each place on are known ones of the same text.
    stop = number == 0
    place = np.arange(len(number) + 1)
    end = np.full(len(number) + 1, len(number))
    end[:-1][stop] = place[:-1][stop]
    end[at[1:]] = at[1:]
    known = np.where(stop, 0, np.minimum.accumulate(end[::-1])[::-1][1:] - place[:-1])
    places = np.flatnonzero(known >= tests.shortest)
    if not len(places):
        return none
    padded, depth = np.r_[number, np.zeros(tests.window, np.uint64)], known[places]
    keys = tests.keys([np.where(depth > i, padded[places + i], np.uint64(0)) for i in range(tests.window)])
    order = np.lexsort(keys[::-1])
    suffix_array, keys = places[order], [k[order] for k in keys]
    first, last = _bound(keys, tests.low, False), _bound(keys, tests.high, True)
    count = last - first
    total = np.cumsum(count)
    if not total[-1]:
        return none
    which = np.repeat(np.arange(len(count)), count)
    start = suffix_array[np.repeat(first - (total - count), count) + np.arange(total[-1])]
    text = np.searchsorted(at, start, side="right") - 1
    passage, offset, length = tests.passage[which], tests.place[which], tests.length[which]
    # Neighbouring suffixes of a passage at neighbouring places lie on one diagonal.
    line = np.lexsort((start, start - offset, passage, text))
    text, start, passage, offset, length = (x[line] for x in (text, start, passage, offset, length))
    new = np.r_[True, (np.diff(text) != 0) | (np.diff(passage) != 0) | (np.diff(start - offset) != 0) | (np.diff(start) != 1)]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(new)] - 1
    return text[begin], start[begin] - at[text[begin]], start[end] + length[end] - start[begin], passage[begin], offset[begin]


def _scan(docs: DataFrame, keep: list[str], tests: Suffixes) -> DataFrame:
    """Adds the block's matches and items to those of earlier blocks in ``_matches`` and ``_items`` and sets ``_words``."""
    sent = docs.sparkSession.sparkContext.broadcast(tests)
    schema = extended(docs, [*keep, "_utf8"], f"_words long, _matches {MATCHES}, _items array<string>")
    lists = {"_matches": pa.list_(MATCH), "_items": pa.list_(pa.string())}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for part in pieces(batches, "_utf8"):
            hashes, at = word_hashes(part.column("_utf8"), ALNUM)
            text, start, length, passage, place = shard_matches(hashes, at, tests)
            first = {p: tests.holders[p] for p in np.unique(passage).tolist()}
            names = [tests.item_ids[first[p][0][0]] for p in passage.tolist()]
            held = [len(first[p][0]) for p in passage.tolist()]
            columns = [pa.array(start, pa.int32()), pa.array(length, pa.int32()), pa.array(names, pa.string()), pa.array(place, pa.int32()), pa.array(held, pa.int32())]
            cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
            # Texts of the same passages have the same items; their list is made once.
            groups = [tuple(sorted(set(passage[a:b].tolist()))) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            ids = {g: tests.ids_of(g) if g else [] for g in set(groups)}
            order = {g: n for n, g in enumerate(ids)}
            found = {
                "_matches": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(MATCH))),
                "_items": pa.array(list(ids.values()), lists["_items"]).take(pa.array([order[g] for g in groups], pa.int64())),
            }
            for name in found:
                if name in part.schema.names:
                    found[name] = pa.array([a + b for a, b in zip(part.column(name).to_pylist(), found[name].to_pylist(), strict=True)], lists[name])
            yield pa.RecordBatch.from_arrays([part.column(c) for c in [*keep, "_utf8"]] + [pa.array(np.diff(at), pa.int64()), *found.values()], names=[*keep, "_utf8", "_words", *found])

    return docs.mapInArrow(scan, schema)


def covered(matches: Column) -> Column:
    """How many words some match covers."""
    spans = F.sort_array(F.transform(matches, lambda m: F.struct(m["start"].cast("long").alias("a"), (m["start"] + m["length"]).cast("long").alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        spans,
        start,
        lambda s, m: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), m["b"] - F.greatest(m["a"], s["reach"]))).alias("n"), F.greatest(s["reach"], m["b"]).alias("reach")),
        lambda s: s["n"],
    )


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, block_bytes: int = 16 << 20) -> DataFrame:
    """``keep`` columns of every document plus n_words, n_hit, item_ids (sorted strings) and matches."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), utf8("text").alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    found = docs.select(*keep, utf8("text").alias("_utf8"))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = _scan(found, keep, Suffixes([r["item_id"] for r in rows], [bytes(r["text"]) for r in rows], window))
    return found.select(
        *keep,
        F.col("_words").alias("n_words"),
        covered(F.col("_matches")).alias("n_hit"),
        F.array_sort(F.array_distinct("_items")).alias("item_ids"),
        F.col("_matches").alias("matches"),
    )


def contaminated(hit: str = "n_hit", words: str = "n_words") -> Column:
    """At least one word in twenty is hit."""
    return (F.col(hit) > 0) & (20 * F.col(hit) >= F.col(words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns."""
    inner, keep, names = carried(docs)
    return find_matches(inner, benchmark, keep, window).filter(~contaminated()).select(*names)
