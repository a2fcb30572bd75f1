"""Near duplicates by SimHash, compared bit plane by bit plane.

A document's fingerprint has a bit set where over half of the XXH64 hashes of its word shingles have it; repeated shingles
count each time. Two fingerprints link if at most ``radius`` bits differ.

The 64 bits are cut into ``radius + 2`` parts. Fingerprints that link agree in two parts at least, so they meet in the block
of those two parts' bits: every pair of parts deals the distinct fingerprints into blocks, and all that share a block are
compared. A block with at least ``1 / shares`` of all pairs (there are ``shares`` such blocks at most, so their broadcast
list is bounded) is dealt over a grid of cells by hashes of the fingerprints, as many as its part of the pairs asks for.

A task stores its rows as bit planes: plane p has bit p of every row, 64 rows to a word. Shifted by d, a plane stands
beside the rows d further on, so one exclusive or gives bit p of 64 differences. The planes are added eight at a time
into carry-save counters (ones, twos, fours; eights stick), and a word whose 64 distances have all passed the radius is
abandoned. Planes of the block's own parts are equal and left out; the others go by how evenly they split the rows.

What leaves a task are not pairs but each linked row with the smallest fingerprint it reaches in its cell, so a group
of near copies costs a row each. Chunks of a cell that are one component already aren't compared again. At most 679,121
fingerprints lie within four bits of another, which bounds what a group of near copies can put into a block.

Defined results: a null text, and one without words, has the fingerprint zero and links like any other; fewer words than
``k`` make one shingle; rows that repeat an id or a text are documents each; null ids name a component only where it has no
other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import pieces, stored, utf8
from refnet.llm.components import components
from refnet.llm.words import _LOWER, NON_SPACE, buffers
from refnet.plans.skew import balanced_join

K, RADIUS, SEED = 4, 4, 42
HASHED = 1 << 16  # shingles hashed at a time
SEGMENT = 1 << 13  # rows of small cells compared at a time
CHUNK = 1 << 12  # rows of a large cell that stand on one side
BUFFER = 1 << 17  # rows that a task holds, or one cell


def joined_words(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All words, lower-cased, with one space after another; where each starts and ends, and the offsets of each text's words."""
    data, at = buffers(texts)
    inside = NON_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = at[:-1][at[:-1] < len(data)]
    first[begins] = inside[begins]
    ends = begins[begins > 0] - 1
    last[ends] = inside[ends]
    after = np.zeros(len(data), bool)
    after[1:] = inside[:-1] & ~inside[1:]
    keep = inside | after
    place = np.cumsum(keep, dtype=np.int32 if len(data) < 1 << 31 else np.int64) - 1
    joined = np.where(inside, _LOWER[data], np.uint8(32))[keep]
    starts = np.flatnonzero(first)
    return joined.tobytes(), place[starts], place[np.flatnonzero(last)] + 1, np.searchsorted(starts, at)


def simhash(texts: pa.Array, k: int = K) -> np.ndarray:
    """The fingerprint of each text."""
    out = np.zeros(len(texts), np.uint64)
    joined, starts, ends, at = joined_words(texts)
    if not len(starts):
        return out
    words = np.diff(at)
    shingles = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(texts)), shingles)
    first = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + np.repeat(at[:-1], shingles)
    last = np.minimum(first + k, np.repeat(at[1:], shingles)) - 1
    set_bits = np.zeros((len(texts), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, len(text), HASHED):
        own = text[a : a + HASHED]
        spans = zip(starts[first[a : a + HASHED]].tolist(), ends[last[a : a + HASHED]].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[x:y], SEED) for x, y in spans), np.uint64, len(own))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        set_bits[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    over = (2 * set_bits > shingles[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text); fp holds the 64 bits as a signed number."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "_utf8", 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(simhash(part.column("_utf8"), k).view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8("text").alias("_utf8")).mapInArrow(sign, f"doc_id {kind}, fp long")


def parts(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the radius + 2 parts of a fingerprint, three at least."""
    n = max(radius, 1) + 2
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def blocks(fps: DataFrame, radius: int) -> DataFrame:
    """(block, fp): each distinct fingerprint once for every two parts; a block is those two and their bits."""

    def bits(part: tuple[int, int]) -> Column:
        return F.shiftrightunsigned("fp", part[0]).bitwiseAND(F.lit((1 << part[1]) - 1).cast("long"))

    names = []
    for n, (a, b) in enumerate(combinations(parts(radius), 2)):
        names.append(F.lit(n << 52).cast("long").bitwiseOR(F.shiftleft(bits(a), b[1])).bitwiseOR(bits(b)))
    return fps.select(F.explode(F.array(*names)).alias("block"), "fp")


def dealt(rows: DataFrame, shares: int) -> DataFrame:
    """(block, i, j, second, fp): the rows by cell. Every pair of rows of a block is in one cell: within a part (i = j), or
    of two parts, whose rows are told apart by ``second``."""
    counts = stored(rows.groupBy("block").agg(F.count("*").alias("n")).filter("n > 1"), "block-counts")
    pairs = F.col("n").cast("double") * F.col("n")
    total = counts.agg(F.sum(pairs).alias("t")).first()["t"] or 1.0
    side = F.ceil(F.sqrt(2 * pairs * shares / total)).cast("int").alias("_side")
    large = counts.filter(pairs * shares >= total).select(F.col("block").alias("_block"), side)  # shares rows at most
    split = rows.join(F.broadcast(large), F.col("block") == F.col("_block"), "left")
    own = F.when(F.col("_side").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("_side"))).otherwise(0).cast("int")
    others = F.when(F.col("_side").isNotNull(), F.sequence(F.lit(0), F.col("_side") - 1)).otherwise(F.array(F.lit(0)))
    cells = split.withColumn("_own", own).withColumn("_other", F.explode(others))
    return cells.select("block", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") > F.col("_other")).alias("second"), "fp")


def add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A carry-save adder: the sums and the carries of three bits each."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Which of the counts (ones, twos, fours, sticky eights) are above ``radius``, which is below eight."""
    over, equal = counters[3].copy(), ~counters[3]
    for bit in (2, 1, 0):
        if radius >> bit & 1:
            equal &= counters[bit]
        else:
            over |= equal & counters[bit]
            equal &= ~counters[bit]
    return over


def close_pairs(fps: np.ndarray, low: np.ndarray, high: np.ndarray, planes: list[int], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, i + d) of rows that differ in ``radius`` bits of ``planes`` at most, with low[i] <= d <= high[i]."""
    n, most = len(fps), int(high.max(initial=0))
    if most < 1:
        return
    width = -(-n // 64)
    bits = np.zeros((len(planes), 128 * width + 128), np.uint8)
    for x, p in enumerate(planes):
        bits[x, :n] = (fps >> np.uint64(p)) & np.uint64(1)
    spread = np.abs(bits[:, :n].sum(axis=1, dtype=np.int64) * 2 - n)
    plane = np.packbits(bits[np.argsort(spread, kind="stable")], axis=1, bitorder="little").view(np.uint64)
    shifts = min(64, most + 1)
    moved = np.empty((len(planes), shifts, 2 * width), np.uint64)  # plane x, r rows further on
    moved[:, 0] = plane[:, : 2 * width]
    for r in range(1, shifts):
        moved[:, r] = (plane[:, : 2 * width] >> np.uint64(r)) | (plane[:, 1 : 2 * width + 1] << np.uint64(64 - r))
    for q in range(most // 64 + 1):
        d = 64 * q + np.arange(shifts)[:, None]
        asked = np.zeros((shifts, 64 * width), np.uint8)
        asked[:, :n] = (low <= d) & (d <= high)
        alive = np.packbits(asked, axis=1, bitorder="little").view(np.uint64)
        r, k = np.nonzero(alive)
        alive = alive[r, k]
        counters = [np.zeros(len(k), np.uint64) for _ in range(4)]
        for a in range(0, len(planes), 8):
            if not len(k):
                break
            x = [plane[p, k] ^ moved[p, r, k + q] for p in range(a, min(a + 8, len(planes)))]
            x += [np.uint64(0)] * (8 - len(x))
            ones, twos, fours, eights = counters
            ones, t1 = add(ones, x[0], x[1])
            ones, t2 = add(ones, x[2], x[3])
            twos, f1 = add(twos, t1, t2)
            ones, t1 = add(ones, x[4], x[5])
            ones, t2 = add(ones, x[6], x[7])
            twos, f2 = add(twos, t1, t2)
            fours, e = add(fours, f1, f2)
            counters = [ones, twos, fours, eights | e]
            alive &= ~beyond(counters, radius)
            left = np.flatnonzero(alive)
            if 4 * len(left) < 3 * len(k):  # words whose distances all passed the radius are abandoned
                r, k, alive, counters = r[left], k[left], alive[left], [c[left] for c in counters]
        left = np.flatnonzero(alive)
        for a in range(0, len(left), 1 << 14):
            some = left[a : a + (1 << 14)]
            word, lane = np.nonzero(np.unpackbits(alive[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i = 64 * k[some][word] + lane
            yield i, i + 64 * q + r[some][word]


def merge(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the components (rows by their smallest row) of the pairs, in place."""
    while True:
        a, b = roots[i], roots[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        roots[np.maximum(a, b)] = np.minimum(a, b)
        while True:
            up = roots[roots]
            if np.array_equal(up, roots):
                break
            roots[:] = up


def linked(cells: np.ndarray, tables: np.ndarray, second: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, the smallest it reaches in its cell) for rows of whole cells, in order of cell, second and fingerprint."""
    cut = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[cut, len(cells)])
    two = np.add.reduceat(second.astype(np.int64), cut)  # rows of the second part
    roots = np.arange(len(cells))
    cuts = parts(radius)
    sides = [[p for n, (a, w) in enumerate(cuts) for p in range(a, a + w) if n not in pair] for pair in combinations(range(len(cuts)), 2)]

    def compare(rows: np.ndarray, low: np.ndarray, high: np.ndarray, table: int) -> None:
        for i, j in close_pairs(fps[rows], low, high, sides[table], radius):
            merge(roots, rows[i], rows[j])

    def reach(size: int, later: int) -> tuple[np.ndarray, np.ndarray]:
        """Partners of the rows of a cell, as distances: all that follow, or those of the second part."""
        at = np.arange(size)
        if not later:
            return np.ones(size, np.int64), size - 1 - at
        first = size - later
        return np.maximum(first - at, 1), np.where(at < first, size - 1 - at, 0)

    several = (sizes > 1) & (two < sizes)
    large = several & (sizes > CHUNK)
    small = np.flatnonzero(several & ~large)
    small = small[np.lexsort((sizes[small], tables[cut[small]]))]
    start = 0
    while start < len(small):
        table, end, rows = tables[cut[small[start]]], start, 0
        while end < len(small) and tables[cut[small[end]]] == table and (end == start or rows + sizes[small[end]] <= SEGMENT):
            rows += sizes[small[end]]
            end += 1
        own = small[start:end]
        ranges = [reach(int(s), int(t)) for s, t in zip(sizes[own], two[own], strict=True)] if two[own].any() else None
        where = np.repeat(cut[own], sizes[own]) + np.arange(rows) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
        if ranges is None:
            low, high = np.ones(rows, np.int64), np.repeat(cut[own] + sizes[own] - 1, sizes[own]) - where
        else:
            low, high = (np.concatenate(x) for x in zip(*ranges, strict=True))
        compare(where, low, high, int(table))
        start = end

    for c in np.flatnonzero(large).tolist():
        rows = np.arange(cut[c], cut[c] + sizes[c])
        first = int(sizes[c] - two[c])
        left = [rows[a : min(a + CHUNK, first)] for a in range(0, first, CHUNK)]
        right = [rows[a : a + CHUNK] for a in range(first, len(rows), CHUNK)] if two[c] else None
        pairs = [(x, y) for x in left for y in right] if right else sorted(((x, y) for n, x in enumerate(left) for y in left[n:]), key=lambda xy: xy[0] is not xy[1])
        for x, y in pairs:
            one = roots[x[0]]
            if (roots[x] == one).all() and (roots[y] == one).all():
                continue
            both = x if x is y else np.r_[x, y]
            compare(both, *reach(len(both), 0 if x is y else len(y)), int(tables[cut[c]]))

    moved = np.flatnonzero(roots != np.arange(len(cells)))
    return fps[moved], fps[roots[moved]]


def links(cells: DataFrame, radius: int) -> DataFrame:
    """(a, b): fingerprints and the smallest each reaches in its cell, of the rows of ``dealt``."""
    spread = cells.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "second", "fp")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def number(rows: pa.Table) -> np.ndarray:
            new = np.zeros(rows.num_rows, bool)
            for c in ("block", "i", "j"):
                x = rows.column(c).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return np.cumsum(new)

        def found(rows: pa.Table) -> pa.RecordBatch:
            a, b = linked(number(rows), rows.column("block").to_numpy() >> 52, rows.column("second").to_numpy(), rows.column("fp").to_numpy().view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BUFFER:
                rows = pa.Table.from_batches(held)
                cells = number(rows)
                whole = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
                held, n = rows.slice(whole).combine_chunks().to_batches(), rows.num_rows - whole
                if whole:
                    yield found(rows.slice(0, whole))
        if n:
            yield found(pa.Table.from_batches(held))

    return spread.mapInArrow(join, "a long, b long").distinct()


def near_components(docs: DataFrame, k: int = K, radius: int = RADIUS, shares: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text); ``radius`` is 7 at most."""
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold distances up to 7")
    shares = shares or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = stored(fingerprints(docs, k), "fingerprints")
    ids = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints")
    found = stored(links(dealt(blocks(ids.select("fp"), radius), shares), radius), "links")
    labels = components(found, "components")
    named = stored(ids.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "id", F.coalesce("label", "fp").alias("label")), "named")
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of = stored(balanced_join(named, least, ["label"], "left", left_salt=["fp"]).select("fp", "component_id"), "classes")
    out = balanced_join(signed, of, ["fp"], "left", left_salt=["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
