"""Join of documents by the Jaccard similarity of their word n-gram sets, with R-trees over count vectors.

A document's set holds the 64-bit hashes of its distinct word n-grams. Documents with the same set are one class; only
classes are compared. A class's point counts the hashes of its set by group (bits of the hash); no two sets share more than
the sum, over the groups, of the smaller count. An R-tree over points keeps the largest count of each group and the
smallest and largest set size below each node, so the same sum over two nodes bounds the overlap of all pairs below them.

Blocks keep the trees small and dealt out (a large one by pairs of its parts): sets of similarity t or more share one of their first ``n - ceil(t n) + 1``
hashes in any common order. The order puts frequent hashes last (counted over all documents in a table that grows with their
number) and goes by the hash elsewhere, so a passage that many documents share makes no block. The components are found in
rounds:

1. Each class and the first class of its blocks, if many blocks say so and the bound of their points allows it, are verified
   against the texts' sets. Large groups of near copies become components by it, from a few pairs for each member.
2. In a part of the blocks, by hash, whose members are still in different components, R-trees are joined with themselves,
   and each class's partner of the largest bound in another component is verified, a pair at most for each member of a
   block; then in another part. This only leaves less to round 3.
3. Over all blocks all surviving pairs of different components are verified. So no link between components is lost, and pairs
   within one are never listed.

A class without a class of similar size in a block leaves it. Sets are computed anew from a text of each class in question
(a Bloom filter sized by their number picks the texts, the join decides), and compared hash by hash. Tables between the steps
are written to the shared folder.

A block that holds at least a ``shares``-th of all rows (so ``shares`` blocks at most, twice the number of shuffle partitions)
never meets in one task: its sizes, labels and chunks come from aggregates by (block, size) and (block, label), and its members
are dealt to chunks by hash. Other blocks are ranked by windows.

Defined results: null text and text without words have size 0 and are their own component; a text of fewer than ``k``
words has the whole sequence as its one n-gram, which differs from every longer n-gram; null ids are never a component's
name while it has another; rows that repeat an id are documents each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import pieces, stored, utf8
from refnet.llm.components import components
from refnet.llm.words import NON_SPACE, mix, ngram_hashes, word_hashes
from refnet.plans.skew import hot_keys, salted_join

K, PERCENT = 4, 85
BUCKETS = (1 << 22, 1 << 24)  # of the count table, 16 a document within these
OFTEN, LEAST_OFTEN = 8, 32  # a bucket is frequent with so many times the mean, and so many at least
FILTER_BITS = (1 << 20, 1 << 28)  # of the filter, 16 a text within these; beyond, it lets more texts through
LEAF = 16
MOST_GROUPS = 1024
BEST_ROUNDS, PARTS = 3, 8
CHUNK = 1024  # members of a block that one side of a cell holds
LEAST_CHUNK = 64  # of a block that holds much of the rows of a small table
BUFFER = 1 << 16  # pairs that a task holds before they leave


def power_of_two(n: int, bounds: tuple[int, int]) -> int:
    """The least power of two from ``n`` on, within ``bounds``."""
    return min(max(1 << max(0, n - 1).bit_length(), bounds[0]), bounds[1])


def sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The sorted set of each row, a slice of rows at a time."""
    for part in pieces(batches, "_utf8", 1 << 20):
        words, at = word_hashes(part.column("_utf8"), NON_SPACE)
        grams = ngram_hashes(words, k)
        found = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                found.append(np.unique(grams[a : b - k + 1]))
            else:
                found.append(ngram_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        yield part, found


def class_of(own: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = mix(own ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) + np.uint64(len(own)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def point(own: np.ndarray) -> np.ndarray:
    """How many hashes of a set are in each group, about two while MOST_GROUPS are enough; groups are a power of two."""
    groups = 8
    while groups * 2 < len(own) and groups < MOST_GROUPS:
        groups *= 2
    while True:
        counts = np.bincount(((own >> np.uint64(40)) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8)
        groups *= 2


def frequent_buckets(docs: DataFrame, k: int) -> np.ndarray:
    """Which buckets of n-gram hashes are frequent over all documents.

    A task reports its buckets of half the frequency; what it leaves out of a bucket is less than the other half.
    """
    buckets = power_of_two(16 * docs.count(), BUCKETS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in pieces(batches, "_utf8"):
            words, at = word_hashes(part.column("_utf8"), NON_SPACE)
            inside = np.ones(max(0, len(words) - k + 1), bool)
            for i in range(1, k):  # an n-gram that starts in the last words of a text reaches over its end
                ends = at[1:] - i
                inside[ends[(ends >= 0) & (ends < len(inside))]] = False
            total += np.bincount((ngram_hashes(words, k)[inside] & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
        mean = total.sum() / buckets
        often = np.flatnonzero(total >= max(2, OFTEN / 2 * mean))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, often]), pa.array(np.r_[total.sum(), total[often]])], names=["bucket", "n"])

    counts = stored(docs.select(utf8("text").alias("_utf8")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "buckets")
    total = (counts.filter("bucket = -1").first() or {"n": 0})["n"]
    least = max(LEAST_OFTEN, OFTEN / 2 * total / buckets)  # so at most buckets * 2 / OFTEN rows follow
    found = np.zeros(buckets, bool)
    found[counts.filter((F.col("bucket") >= 0) & (F.col("n") >= least)).select("bucket").toArrow().column(0).to_numpy()] = True
    return found


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, class, prefix, point (compressed)) of every document; class is null and the rest empty for an empty set."""
    often = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent_buckets(docs, k)))
    kept = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8("text").alias("_utf8"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(often.value).view(bool)
        for part, found in sets(batches, k):
            classes, prefixes, points = [], [], []
            for own in found:
                if not len(own):
                    classes.append(None), prefixes.append(None), points.append(None)
                    continue
                last = frequent[(own & np.uint64(len(frequent) - 1)).astype(np.int64)]
                first = np.r_[own[~last], own[last]][: prefix_size(len(own), percent)]
                classes.append(class_of(own)), prefixes.append(first.view(np.int64)), points.append(zlib.compress(point(own).tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in found], pa.int64()), pa.array(classes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(points, pa.binary())],
                names=["doc_id", "text_hash", "n", "class", "prefix", "point"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(sign, f"doc_id {kind}, text_hash long, n long, class long, prefix array<long>, point binary")


def bloom_positions(values: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(values.view(np.uint64))
    return [((h >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (0, 18, 36)]


def bloom(values: DataFrame, n: int) -> np.ndarray:
    """The words of a filter that lets each of the column's ``n`` values through, and few others while its bits are eight a
    value."""
    size = power_of_two(16 * n, FILTER_BITS)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            at = np.concatenate(bloom_positions(part.column(0).to_numpy(), size))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    words = values.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # FILTER_BITS / 64 at most
    out = np.zeros(size // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


class Pairs:
    """Pairs (a, b) of classes, a stored table, and what belongs to both: a class of very many pairs is dealt over tasks."""

    def __init__(self, pairs: DataFrame):
        self.pairs = pairs
        self.hot = {side: hot_keys(pairs, None, [side]) for side in ("a", "b")}

    def with_both(self, of: DataFrame) -> DataFrame:
        """The pairs with the other columns of ``of`` (by ``class``, unique) for a and b, as ``a_`` and ``b_`` before the names."""
        found = self.pairs
        for side, other in (("a", "b"), ("b", "a")):
            own = of.select(F.col("class").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in of.columns if c != "class"))
            found = salted_join(found, own, [side], [other], self.hot[side])
        return found


def bounded(pairs: Pairs, points: DataFrame, percent: int) -> DataFrame:
    """The pairs that their points (class, n, point) allow."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            two = lambda c: [x for both in zip(batch.column(f"a_{c}").to_pylist(), batch.column(f"b_{c}").to_pylist(), strict=True) for x in both]  # noqa: B023, E731
            m = batch.num_rows
            first = small_pairs(np.repeat(np.arange(m), 2), np.arange(2 * m), np.array(two("n"), np.int64), [zlib.decompress(p) for p in two("point")], percent)[0] if m else []
            yield batch.select(["a", "b"]).take(pa.array(np.unique(np.asarray(first, np.int64) // 2)))

    return pairs.with_both(points).mapInArrow(bound, "a long, b long")


def verified(docs: DataFrame, signed: DataFrame, pairs: Pairs, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their whole sets."""
    wanted = pairs.pairs.select(F.col("a").alias("_class")).union(pairs.pairs.select("b")).distinct()
    texts = signed.groupBy("class").agg(F.min("text_hash").alias("text_hash")).join(wanted, F.col("class") == F.col("_class"), "left_semi")
    texts = stored(texts, "texts")
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom(texts.select("text_hash"), texts.count()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = filter_.value

        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = np.ones(batch.num_rows, bool)
                for at in bloom_positions(batch.column("text_hash").to_numpy(), 64 * len(words)):
                    hit &= (words[at >> 6] >> (at & 63)) & 1 == 1
                for a in range(0, batch.num_rows, 1000):
                    yield batch.slice(a, 1000).filter(pa.array(hit[a : a + 1000]))

        for _, found in sets(some(), k):
            own = {class_of(s): s for s in found if len(s)}
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array([s.view(np.int64) for s in own.values()], pa.list_(pa.int64()))], names=["class", "hashes"])

    every = docs.select(F.xxhash64("text").alias("text_hash"), utf8("text").alias("_utf8"))
    own = every.mapInArrow(pick, "class long, hashes array<long>").dropDuplicates(["class"])
    own = stored(own.join(texts.select("class"), "class", "left_semi"), "sets")
    both = pairs.with_both(own).withColumn("_both", F.size(F.array_intersect("a_hashes", "b_hashes")).cast("long"))
    return both.filter(100 * F.col("_both") >= percent * (F.size("a_hashes") + F.size("b_hashes") - F.col("_both"))).select("a", "b")


class RTree:
    """Points of one width, packed by halving the widest coordinate; nodes as (largest counts, least n, most n, below,
    least label, largest label)."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.points, self.sizes, self.labels = points, sizes, labels
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, rows: np.ndarray) -> tuple:
        own, n, label = self.points[rows], self.sizes[rows], self.labels[rows]
        if len(rows) <= LEAF:
            return own.max(axis=0), n.min(), n.max(), rows, None, label.min(), label.max()
        # Set sizes count as a coordinate, by the share of their range that can be similar.
        spread = own.max(axis=0).astype(np.int64) - own.min(axis=0)
        by = n if n.max() * 85 > n.min() * 100 else own[:, spread.argmax()]
        order = np.argsort(by, kind="stable")
        below = [self._pack(rows[half]) for half in np.array_split(order, 2)]
        return own.max(axis=0), n.min(), n.max(), None, below, label.min(), label.max()

    def folded(self, width: int) -> RTree:
        """The tree of the same sets in fewer groups."""
        if self.points.shape[1] == width:
            return self
        return RTree(self.points.reshape(len(self.points), -1, width).sum(axis=1, dtype=np.uint16), self.sizes, self.labels)


def similar(left: RTree, right: RTree, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of pairs with different labels whose bound allows the similarity, and the bound; of a tree with itself, each
    pair once."""
    stack = [(left.root, right.root, same)]
    while stack:
        a, b, twin = stack.pop()
        if 100 * a[2] < percent * b[1] or 100 * b[2] < percent * a[1] or a[5] == a[6] == b[5] == b[6]:
            continue
        if not twin and np.minimum(a[0], b[0]).sum(dtype=np.int64) * (100 + percent) < percent * (a[1] + b[1]):
            continue
        if a[3] is not None and b[3] is not None:
            n = left.sizes[a[3]][:, None] + right.sizes[b[3]][None, :]
            most = np.minimum(left.points[a[3]][:, None, :], right.points[b[3]][None, :, :]).sum(axis=2, dtype=np.int64)
            good = most * (100 + percent) >= percent * n
            good &= left.labels[a[3]][:, None] != right.labels[b[3]][None, :]
            if twin:
                good = np.triu(good, 1)
            i, j = np.nonzero(good)
            if len(i):
                yield a[3][i], b[3][j], most[i, j] / n[i, j]
        elif twin:
            stack += [(a[4][0], a[4][0], True), (a[4][1], a[4][1], True), (a[4][0], a[4][1], False)]
        elif b[3] is not None or a[3] is None and a[2] >= b[2]:
            stack += [(x, b, False) for x in a[4]]
        else:
            stack += [(a, x, False) for x in b[4]]


def bands_of(rows: np.ndarray, labels: np.ndarray, sizes: np.ndarray, points: list[bytes]) -> dict[int, tuple[np.ndarray, RTree]]:
    """Of some members (by number), those of each width of points and their tree."""
    widths = np.array([len(points[i]) for i in rows.tolist()], np.int64)
    bands = {int(w): rows[widths == w] for w in np.unique(widths)}
    return {w: (own, RTree(np.frombuffer(b"".join(points[i] for i in own.tolist()), np.uint8).reshape(len(own), w), sizes[own], labels[own])) for w, own in bands.items()}


def cell_pairs(left: np.ndarray, right: np.ndarray | None, labels: np.ndarray, sizes: np.ndarray, points: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some pairs after others of members (by number) of ``left`` and ``right`` (of ``left`` with itself if None) with
    different labels that may be similar, and their bounds."""
    one = bands_of(left, labels, sizes, points)
    two = one if right is None else bands_of(right, labels, sizes, points)
    for w, (rows, tree) in one.items():
        for v, (others, other) in two.items():
            if right is None and v < w or 100 * sizes[rows].max() < percent * sizes[others].min() or 100 * sizes[others].max() < percent * sizes[rows].min():
                continue
            # Folded to the smaller width, the groups are the same.
            for i, j, bound in similar(tree.folded(min(w, v)), other.folded(min(w, v)), percent, right is None and v == w):
                yield rows[i], others[j], bound


def block_pairs(labels: np.ndarray, sizes: np.ndarray, points: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All of cell_pairs of one block with itself."""
    found = list(cell_pairs(np.arange(len(points)), None, labels, sizes, points, percent))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def small_pairs(token: np.ndarray, labels: np.ndarray, sizes: np.ndarray, points: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As block_pairs, for many blocks of LEAF members at most, which are leaves by themselves, all at once."""
    left, right = [], []
    for d in range(1, LEAF):
        i = np.flatnonzero(token[:-d] == token[d:])
        least, most = np.minimum(sizes[i], sizes[i + d]), np.maximum(sizes[i], sizes[i + d])
        i = i[(labels[i] != labels[i + d]) & (100 * least >= percent * most)]
        left.append(i), right.append(i + d)
    i, j = np.concatenate(left), np.concatenate(right)
    widths = np.fromiter(map(len, points), np.int64, len(points))
    swap = widths[i] > widths[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    bound = np.zeros(len(i))
    for w, wider in {*zip(widths[i].tolist(), widths[j].tolist(), strict=True)}:
        some = np.flatnonzero((widths[i] == w) & (widths[j] == wider))
        for a in range(0, len(some), max(1, (1 << 20) // wider)):
            part = some[a : a + max(1, (1 << 20) // wider)]
            x, y = (np.frombuffer(b"".join(points[m] for m in side[part].tolist()), np.uint8).reshape(len(part), -1) for side in (i, j))
            y = y.reshape(len(part), wider // w, w).sum(axis=1, dtype=np.uint16) if wider > w else y
            bound[part] = np.minimum(x, y).sum(axis=1, dtype=np.int64) / (sizes[i[part]] + sizes[j[part]])
    good = bound * (100 + percent) >= percent * (1 - 1e-12)
    return i[good], j[good], bound[good]


def best_of(a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each member's pairs that with the largest bound, and the bound."""
    member, other, bound = np.r_[a, b], np.r_[b, a], np.r_[bound, bound]
    order = np.lexsort((other, -bound, member))
    member, other, bound = member[order], other[order], bound[order]
    first = np.r_[True, member[1:] != member[:-1]][: len(member)]
    return member[first], other[first], bound[first]


def in_parts(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], best: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs and bounds in parts of about BUFFER; if ``best`` those of best_of alone, at the end."""
    held, n = [], 0
    for part in found:
        held.append(part)
        n += len(part[0])
        if n >= BUFFER:
            whole = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n = [], 0
            if best:
                held = [best_of(*whole)]
            else:
                yield whole
    if held:
        whole = tuple(np.concatenate(x) for x in zip(*held, strict=True))
        yield best_of(*whole) if best else whole


def chunked(blocks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of blocks (of apart) with their chunk by rank, their block's last chunk, and the chunks from ``_low`` to before
    ``_high`` that hold the row's component alone."""
    of = lambda rank: F.floor(rank / F.lit(chunk)).cast("int")
    last = of(F.col("_count") - 1)
    to = F.col("_from") + F.col("_same")
    places = {"_chunk": of(F.col("_rank")), "_last": last, "_low": of(F.col("_from") + chunk - 1), "_high": F.when(to == F.col("_count"), last + 1).otherwise(of(to))}
    return blocks.withColumns(places).drop("_rank", "_from", "_same", "_count")


def in_cells(rows: DataFrame) -> DataFrame:
    """The rows of blocks (of chunked) by cell (token, i, j): a cell has the members of two chunks, or of one (i = j). So every
    pair of members is in one cell, but for pairs of chunks that hold one known component alone, which are left out."""
    inside = (F.col("_chunk") >= F.col("_low")) & (F.col("_chunk") < F.col("_high"))
    others = F.filter(F.sequence(F.lit(0), F.col("_last")), lambda c: ~(inside & (c >= F.col("_low")) & (c < F.col("_high"))))
    cells = rows.withColumn("_other", F.explode(F.when(F.col("_last") == 0, F.array(F.lit(0))).otherwise(others)))
    return cells.select(
        "token", F.least("_chunk", "_other").alias("i"), F.greatest("_chunk", "_other").alias("j"), (F.col("_chunk") > F.col("_other")).alias("second"), "class", "label", "n", "point"
    )


def dealt(blocks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of blocks (of apart, with their points) by cell."""
    return in_cells(chunked(blocks, chunk))


def candidate_pairs(blocks: DataFrame, percent: int, best: bool, chunk: int = CHUNK) -> DataFrame:
    """:func:`pairs_of_cells` over all blocks (those of apart with their points)."""
    return pairs_of_cells(dealt(blocks, chunk), percent, best)


def pairs_of_cells(cells: DataFrame, percent: int, best: bool) -> DataFrame:
    """(a, b) over all cells, each in one task, one after another; only each member's best partner in the cell if ``best``."""
    spread = cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        seen: set[tuple[int, int]] = set()

        def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero(np.r_[True, changes(rows), True])
            classes, labels, sizes = (rows.column(c).to_numpy() for c in ("class", "label", "n"))
            second = rows.column("second").to_numpy()
            points = [zlib.decompress(p) for p in rows.column("point").to_pylist()]
            length = np.diff(cut)
            numbers = np.repeat(np.arange(len(length)), length)
            mixed = np.add.reduceat(second, cut[:-1], dtype=np.int64) > 0  # a cell of two chunks
            few = (length <= LEAF) & ~mixed

            def small() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
                at = np.flatnonzero(few[numbers])
                if len(at):
                    x, y, bound = small_pairs(numbers[at], labels[at], sizes[at], [points[m] for m in at.tolist()], percent)
                    yield at[x], at[y], bound

            def large(c: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
                own = np.arange(cut[c], cut[c + 1])
                one, two = own[~second[own]], own[second[own]]
                if len(one):
                    yield from cell_pairs(one, two if mixed[c] else None, labels, sizes, points, percent)

            def named(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
                return ((classes[x], classes[y], bound) for x, y, bound in found)

            new: list[tuple[int, int]] = []
            for found in (small(), *(large(c) for c in np.flatnonzero(~few).tolist())):
                for x, y, _ in in_parts(named(found), best):
                    if len(seen) > 1 << 20:
                        seen.clear()  # a pair that comes again is sent again; distinct() below decides
                    for pair in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True):
                        if pair not in seen:
                            seen.add(pair)
                            new.append(pair)
                    if len(new) >= BUFFER:
                        yield sent(new)
                        new = []
            yield sent(new)

        def sent(new: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in new], pa.int64()), pa.array([p[1] for p in new], pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and changes(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]))[0]:
                yield from pairs(pa.Table.from_batches(held))
                held = []
            # All but the last cell are complete.
            last = int(np.flatnonzero(np.r_[True, changes(pa.Table.from_batches([batch]))])[-1])
            if last:
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return spread.mapInArrow(join, "a long, b long").distinct()


def changes(rows: pa.Table) -> np.ndarray:
    """Whether each row but the first is in another cell than the row before."""
    return np.logical_or.reduce([np.diff(rows.column(c).to_numpy()) != 0 for c in ("token", "i", "j")])


def close_in_size(percent: int) -> Column:
    """Whether a row of a block (ordered by n) has a neighbour of similar size; if any row has one, a neighbour has."""
    order = Window.partitionBy("token").orderBy("n", "class")
    before, after = F.lag("n").over(order), F.lead("n").over(order)
    return F.coalesce(100 * before >= percent * F.col("n"), F.lit(False)) | F.coalesce(100 * F.col("n") >= percent * after, F.lit(False))


def hot_tokens(tokens: DataFrame, shares: int | None = None) -> DataFrame:
    """(token): all with at least ``1 / shares`` of the rows, perhaps some others, ``shares`` at most. Buckets of tokens are
    counted first, so that hardly anything is shuffled."""
    shares = shares or 2 * int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucketed = tokens.select("token", F.pmod(F.xxhash64("token"), F.lit(16 * shares)).alias("_bucket"))
    buckets = hot_keys(bucketed, None, ["_bucket"], shares).select("_bucket")
    if buckets.isEmpty():
        return tokens.sparkSession.createDataFrame([], "token long")
    return hot_keys(bucketed.join(F.broadcast(buckets), "_bucket", "left_semi"), None, ["token"], shares).select("token")


def near_blocks(tokens: DataFrame, percent: int) -> DataFrame:
    """(token, class, n, first, first_n): the rows with a class of similar size in their block, and its first such class."""
    near = tokens.withColumn("_near", close_in_size(percent)).filter("_near")
    first = F.min(F.struct("class", "n")).over(Window.partitionBy("token"))
    return near.withColumn("_first", first).select("token", "class", "n", F.col("_first.class").alias("first"), F.col("_first.n").alias("first_n"))


def near_in_hot_blocks(tokens: DataFrame, percent: int) -> DataFrame:
    """As near_blocks for hot tokens, from each block's distinct sizes."""
    sizes = tokens.groupBy("token", "n").agg(F.count(F.lit(1)).alias("_members"), F.min("class").alias("_least"))
    order = Window.partitionBy("token").orderBy("n")
    before, after = F.lag("n").over(order), F.lead("n").over(order)
    close = (F.col("_members") > 1) | F.coalesce(100 * before >= percent * F.col("n"), F.lit(False)) | F.coalesce(100 * F.col("n") >= percent * after, F.lit(False))
    near = sizes.withColumn("_near", close).filter("_near")
    first = near.groupBy("token").agg(F.min(F.struct(F.col("_least").alias("class"), "n")).alias("_first"))  # a row for a hot token
    sized = near.join(F.broadcast(first), "token").select("token", "n", F.col("_first.class").alias("first"), F.col("_first.n").alias("first_n"))
    found = salted_join(tokens, sized, ["token", "n"], ["class"])
    return found.filter(F.col("first").isNotNull()).select("token", "class", "n", "first", "first_n")


def labelled(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (token, class, n, label) of blocks; a class without a label is its own."""
    return blocks.join(labels.withColumnRenamed("node", "_node"), F.col("class") == F.col("_node"), "left").select("token", "class", "n", F.coalesce("label", "class").alias("label"))


def hot_apart(blocks: DataFrame, labels: DataFrame, chunk: int) -> DataFrame:
    """As chunked(apart) for hot tokens: a label with over a quarter of ``chunk`` rows has chunks of its own, its rows dealt by
    their hash; others are dealt whole, by the label's hash, to as many chunks as their rows ask for."""
    named = stored(labelled(blocks, labels), "hot-blocks")
    each = stored(named.groupBy("token", "label").agg(F.count(F.lit(1)).alias("_same")), "hot-labels")
    chunks = lambda n: F.ceil(n / F.lit(chunk)).cast("int")
    large = F.col("_same") > chunk // 4
    # A row for a hot token: few by proof.
    totals = each.groupBy("token").agg(F.count(F.lit(1)).alias("_labels"), chunks(F.sum(F.when(large, 0).otherwise(F.col("_same")))).alias("_mixed"), F.sum(F.when(large, chunks(F.col("_same")))).alias("_owned"))
    totals = totals.filter("_labels > 1").select("token", "_mixed", (F.col("_mixed") + F.coalesce("_owned", F.lit(0)) - 1).cast("int").alias("_last"))
    before = F.coalesce(F.sum("_own").over(Window.partitionBy("token").orderBy("label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = each.filter(large).join(F.broadcast(totals), "token").withColumn("_own", chunks(F.col("_same")))
    own = own.select("token", "label", "_own", (F.col("_mixed") + before).cast("int").alias("_start"))
    rows = salted_join(named, own, ["token", "label"], ["class"]).join(F.broadcast(totals), "token")
    place = lambda column, n: F.pmod(F.xxhash64(column), n).cast("int")
    at = F.when(F.col("_start").isNotNull(), F.col("_start") + place("class", F.col("_own"))).otherwise(place("label", F.greatest(F.col("_mixed"), F.lit(1))))
    low = F.coalesce("_start", F.lit(0))
    return rows.select("token", "class", "n", "label", at.alias("_chunk"), "_last", low.alias("_low"), (low + F.coalesce("_own", F.lit(0))).alias("_high"))


def apart(blocks: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The rows (token, class, n, label) of blocks with more than one component, with their rank by label in the block, the
    first rank of their label, and how many rows their label and the block have."""
    block, alike, order = Window.partitionBy("token"), Window.partitionBy("token", "label"), Window.partitionBy("token").orderBy("label", "class")
    named = labelled(blocks, labels)
    counted = named.withColumn("_rank", F.row_number().over(order) - 1).withColumn("_same", F.count("*").over(alike)).withColumn("_count", F.count("*").over(block))
    first = F.rank().over(Window.partitionBy("token").orderBy("label")) - 1
    return counted.withColumn("_from", first).filter("_same < _count")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after further links: the components of the links between labels, and each node by its label's."""
    names = labels.withColumnRenamed("node", "_node").withColumnRenamed("label", "_label")
    one = links.join(names, F.col("a") == F.col("_node"), "left").select(F.coalesce("_label", "a").alias("a"), "b")
    between = one.join(names, F.col("b") == F.col("_node"), "left").select("a", F.coalesce("_label", "b").alias("b"))
    joined = components(between, "components")
    to = joined.select(F.col("node").alias("_from"), F.col("label").alias("_to"))
    old = labels.join(to, F.col("label") == F.col("_from"), "left").select("node", F.coalesce("_to", "label").alias("label"))
    return stored(old.union(joined.join(labels, "node", "left_anti")), "components")


def join_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, label) of every row of ``docs`` (doc_id, text); text_hash tells rows of
    one id apart, label components whose ids don't (null for an empty set)."""
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs, k, percent), "signatures")
    classes = stored(signed.filter("class is not null").dropDuplicates(["class"]).select("class", "n", "prefix", "point"), "classes")

    tokens = classes.select("class", "n", F.explode("prefix").alias("token"))
    hot = hot_tokens(tokens)
    some_hot = not hot.isEmpty()
    of_hot = lambda rows, how: rows.join(F.broadcast(hot), "token", how) if some_hot else rows
    near = near_blocks(of_hot(tokens, "left_anti"), percent)
    if some_hot:
        near = near.union(near_in_hot_blocks(of_hot(tokens, "left_semi"), percent))
    blocks = stored(near, "blocks")
    shares = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = min(CHUNK, max(LEAST_CHUNK, blocks.count() // shares))  # of a hot block

    # Round 1: a class and the first of its blocks, where a quarter of its prefix says so.
    alike = (F.col("class") != F.col("first")) & (100 * F.least("n", "first_n") >= percent * F.greatest("n", "first_n"))
    votes = blocks.filter(alike).groupBy("class", "first").agg(F.count("*").alias("votes"), F.max("n").alias("n"))
    likely = votes.filter(400 * F.col("votes") >= (100 - percent) * F.col("n"))
    pairs = Pairs(stored(likely.select(F.least("class", "first").alias("a"), F.greatest("class", "first").alias("b")).distinct(), "pairs"))
    pairs = Pairs(stored(bounded(pairs, classes.select("class", "n", "point"), percent), "pairs"))
    links = stored(verified(docs, signed, pairs, k, percent), "links")
    labels = components(links, "components")

    # Rounds 2, each over a part of the blocks, and round 3 over all.
    points = classes.select(F.col("class").alias("_class"), "point")
    for part in (*range(BEST_ROUNDS), None):
        best = part is not None
        some = blocks.filter(F.pmod(F.xxhash64("token"), F.lit(PARTS)) == part) if best else blocks
        rest = chunked(apart(of_hot(some, "left_anti"), labels, percent))
        if some_hot:
            rest = rest.unionByName(hot_apart(of_hot(some, "left_semi"), labels, chunk))
        rest = rest.join(points, F.col("class") == F.col("_class"))
        found = stored(pairs_of_cells(in_cells(rest), percent, best), "pairs")
        if found.isEmpty():
            continue
        more = stored(verified(docs, signed, Pairs(found), k, percent), "links")
        labels = labels if more.isEmpty() else merged(labels, more)

    # The smallest id of every component.
    ids = signed.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("id"))
    ids = ids.join(labels, F.col("class") == F.col("node"), "left").select("class", "id", F.coalesce("label", "class").alias("label"))
    least = ids.groupBy("label").agg(F.min("id").alias("component_id"))
    of = stored(ids.join(least, "label").select("class", "component_id", "label"), "components-of")
    rows = signed.select("doc_id", "text_hash", "n", "class")
    joined = salted_join(rows.filter("class is not null"), of, ["class"], ["doc_id", "text_hash"])
    empty = rows.filter("class is null").select("class", "doc_id", "text_hash", "n", F.lit(None).cast(of.schema["component_id"].dataType).alias("component_id"), F.lit(None).cast("long").alias("label"))
    return joined.select(*empty.columns).union(empty).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash", "label")
