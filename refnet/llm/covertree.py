"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are both indexed. A node has a centre, one of its points, and a covering radius; its children's centres
are picked farthest first, so they lie at least as far apart as the radius within which they cover the node's points, the
separation and covering of a cover tree with scales taken from the data. For a query node (centre p, radius r) and a data
node (centre c, radius s) no inner product of their points exceeds ``<p,c> + |p| s + |c| r + r s``; a pair of nodes whose
bound is below the worst k-th score of the node's queries is dropped, at every level of the query tree, and what is left is
searched best bound first for each group of queries.

Data is packed into shards of ``shard_rows`` rows and queries into blocks of ``block_rows``, both stored tables; a row of each
block goes to each shard through a shuffle, and nothing of the queries passes the driver. A task builds a shard's tree once
and searches block after block in it; the trees of the last blocks, and each query's k-th score so far, are kept for the
task's next shards. Each query starts from its k-th score within ``sample_rows`` rows (smallest hashes). Both only prune:
results are exact.

Defined results: vectors that are null or hold a null, NaN or infinite component, and rows with a null id, take no part;
shorter vectors are padded with zeros; of rows that repeat a query's id none is its candidate, and of queries that share an
id the smallest vector counts; other rows that repeat an id are candidates each. Scores must fit a long.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import SHARDS_PER_TASK, array_of, by_shard, rows_of, stored

BLOCKS_KEPT = 8  # of queries, with their trees, in a task
FANOUT, LEAF = 16, 256
SCORED = 1024  # rows of data that a group of queries is scored against at a time


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v) of the rows that take part, v being floor(scale * x)."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    x = F.col(vector_col)
    return vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, fine)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list array, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _padded(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products of two matrices are exact as doubles."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: as doubles while they fit, else as whole numbers of any size."""
    return a.astype(np.float64) @ b.T.astype(np.float64) if fits(a, b) else a.astype(object) @ b.T.astype(object)


class Tree:
    """A cover tree over points, as arrays by node; a node without children is a leaf with ``members``."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.real = real = points.astype(np.float64)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.members: list[np.ndarray | None] = []
        if len(points):
            self._build(real, np.arange(len(points)), 0)
        self.centres = real[self.centre] if self.centre else np.zeros((0, points.shape[1]))
        # A little more than measured, for rounding.
        self.radii = np.array(self.radius) * (1 + 1e-9) + 1e-9
        self.norms = np.sqrt((self.centres**2).sum(axis=1)) * (1 + 1e-9)

    def _build(self, real: np.ndarray, members: np.ndarray, centre: int) -> int:
        node, far = len(self.centre), np.sqrt(((real[members] - real[centre]) ** 2).sum(axis=1))
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.children.append([])
        self.members.append(None)
        if len(members) <= LEAF or self.radius[node] == 0:
            self.members[node] = members
            return node
        # Farthest first; the node's own centre is its first child's.
        near, nearest, chosen = far, np.zeros(len(members), int), [centre]
        while len(chosen) < FANOUT and near.max() > 0:
            new = members[int(near.argmax())]
            distance = np.sqrt(((real[members] - real[new]) ** 2).sum(axis=1))
            closer = distance < near
            nearest[closer], near = len(chosen), np.where(closer, distance, near)
            chosen.append(int(new))
        self.children[node] = [self._build(real, members[nearest == i], c) for i, c in enumerate(chosen)]
        return node


def search(queries: Tree, least: np.ndarray, query_ids: np.ndarray, data: Tree, data_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): the k best rows of ``data`` for every query that reach its score in ``least``."""
    worst = least.astype(np.float64).copy()
    exact = fits(queries.points, data.points)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def bounds(node: int, others: np.ndarray) -> np.ndarray:
        r = queries.radii[node]
        bound = data.centres[others] @ queries.centres[node] + queries.norms[node] * data.radii[others] + data.norms[others] * r + r * data.radii[others]
        return bound + 1e-9 * np.abs(bound) + 1e-6

    def leaves(node: int, others: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The data leaves below ``others`` that the node's queries can still need, best bound first."""
        done, bound = [], []
        while len(others):
            leaf = np.array([data.members[o] is not None for o in others.tolist()])
            done.append(others[leaf]), bound.append(high[leaf])
            others = np.array([c for o in others[~leaf].tolist() for c in data.children[o]], dtype=np.int64)
            high = bounds(node, others)
            keep = high >= worst[queries.members[node]].min()
            others, high = others[keep], high[keep]
        done, bound = np.concatenate(done), np.concatenate(bound)
        order = np.argsort(-bound)
        return done[order], bound[order]

    def group(node: int, others: np.ndarray, high: np.ndarray) -> None:
        """A leaf of queries against data nodes."""
        own = queries.members[node]
        others, high = leaves(node, others, high)
        tops = np.full((len(own), k), -np.inf)
        at = 0
        while at < len(others) and high[at] >= worst[own].min():
            taken, size = [], 0
            while at < len(others) and size < SCORED and high[at] >= worst[own].min():
                taken.append(data.members[others[at]])
                size += len(taken[-1])
                at += 1
            members = np.concatenate(taken)
            s = queries.real[own] @ data.real[members].T if exact else products(queries.points[own], data.points[members])
            same = data_ids[members][None, :] == query_ids[own][:, None]
            good = (s >= worst[own][:, None]) & ~same
            if not good.any():
                continue
            q, r = np.nonzero(good)
            found.append((own[q], members[r], s[q, r]))
            merged = np.concatenate([tops, np.where(good, s, -np.inf).astype(np.float64)], axis=1)
            tops = -np.partition(-merged, k - 1, axis=1)[:, :k]
            worst[own] = np.maximum(worst[own], tops[:, k - 1])

    def visit(node: int, others: np.ndarray) -> None:
        high = bounds(node, others)
        keep = high >= worst[_under(queries, node)].min()
        others, high = others[keep], high[keep]
        if not len(others):
            return
        if queries.members[node] is not None:
            group(node, others, high)
            return
        # Data nodes much wider than the query node are opened on the way down.
        wide = (data.radii[others] > 2 * queries.radii[node]) & np.array([data.members[o] is None for o in others.tolist()])
        others = np.r_[others[~wide], np.array([c for o in others[wide].tolist() for c in data.children[o]], dtype=np.int64)]
        for child in queries.children[node]:
            visit(child, others)

    if queries.centre and data.centre:
        visit(0, np.zeros(1, np.int64))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, r, s = (np.concatenate(x) for x in zip(*found, strict=True))
    reached = s >= worst[q]
    q, r, s = q[reached], r[reached], s[reached]
    order = np.lexsort((data_ids[r], -s, q))
    q, r, s = q[order], r[order], s[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], r[rank < k], s[rank < k].astype(np.int64)


def _under(tree: Tree, node: int) -> np.ndarray:
    cache = tree.__dict__.setdefault("_under", {})
    if node not in cache:
        own = tree.members[node]
        cache[node] = own if own is not None else np.concatenate([_under(tree, c) for c in tree.children[node]])
    return cache[node]


def _least(queries: DataFrame, sample: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """Adds the k-th score of each query within the sample; null if the sample has fewer."""
    sent = queries.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                v, own = matrix(part.column("v")), part.column("vec_id").to_numpy()
                width = max(v.shape[1], points.shape[1])
                least = [None] * len(own)
                if len(ids) > k:
                    s = products(_padded(v, width), _padded(points, width))
                    s = np.where(ids[None, :] == own[:, None], -np.inf, s).astype(np.float64)
                    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                    least = [float(x) if np.isfinite(x) else None for x in kth]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), pa.array(least, pa.float64())], names=["vec_id", "v", "least"])

    return queries.mapInArrow(run, "vec_id long, v array<long>, least double")


def packed(rows: DataFrame, by: str | None, size: int, names: str) -> DataFrame:
    """Rows of (vec_id, v[, least]) in rows of about ``size`` vectors each, as binary: by the column ``by``, or as they lie."""

    def row(name: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        mats = [matrix(p.column("v")) for p in parts]
        width = max(m.shape[1] for m in mats)
        points, ids = np.concatenate([_padded(m, width) for m in mats]), np.concatenate([p.column("vec_id").to_numpy() for p in parts])
        order = np.argsort(ids, kind="stable")
        columns = [pa.array([name]), pa.array([ids[order].tobytes()], pa.binary()), pa.array([points[order].tobytes()], pa.binary())]
        if "least" in parts[0].schema.names:
            least = np.concatenate([p.column("least").fill_null(-math.inf).to_numpy() for p in parts])
            columns.append(pa.array([least[order].tobytes()], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in names.split(", ")])

    def as_they_lie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, count = TaskContext.get().partitionId() * SHARDS_PER_TASK, [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                if held and count + part.num_rows > size:
                    yield row(name, held)
                    name, held, count = name + 1, [], 0
                held.append(part)
                count += part.num_rows
        if held:
            yield row(name, held)

    def group(part: pa.Table) -> pa.Table:
        batches = part.drop_columns([by]).combine_chunks().to_batches()
        return pa.Table.from_batches([row(part.column(by)[0].as_py(), batches)])

    return rows.mapInArrow(as_they_lie, names) if by is None else rows.groupBy(by).applyInArrow(group, names)


def top_k(data: DataFrame, is_query: Column, k: int, block_rows: int = 8192, shard_rows: int = 16384, sample_rows: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``data`` (vec_id, v) for which ``is_query`` holds, against all others."""
    # TakeOrdered of a fixed number of rows.
    head = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    width = max((len(r["v"]) for r in head), default=0)
    sample = (np.array([r["vec_id"] for r in head], np.int64), np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in head], np.int64).reshape(len(head), width))
    queries = stored(_least(data.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), sample, k), "queries")
    # By hash, so a block is about block_rows.
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, math.ceil(queries.count() / block_rows)))).alias("block")
    blocks = stored(packed(queries.select("*", block), "block", block_rows, "block long, query_ids binary, queries binary, least binary"), "query-blocks")
    shards = stored(packed(data, None, shard_rows, "shard long, ids binary, points binary").withColumn("kind", F.lit(0)), "shards")
    found = _search(by_shard(shards, blocks, shards), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Block:
    """A block of queries in a task: their trees by width and their best scores so far."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.points, self.k = ids, points.reshape(len(ids), -1), k
        self.tops = np.full((len(ids), k), -np.inf)
        self.least = least.copy()
        self.tree = lru_cache(2)(lambda width: Tree(_padded(self.points, width)))

    def seen(self, query: np.ndarray, score: np.ndarray) -> None:
        """Takes in a shard's results, in order of query, best first."""
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        new = np.full_like(self.tops, -np.inf)
        new[query, rank] = np.where(np.abs(score) < 2**53, score, np.nextafter(score, -np.inf))  # never above the exact one
        self.tops = -np.partition(-np.concatenate([self.tops, new], axis=1), self.k - 1, axis=1)[:, : self.k]
        self.least = np.maximum(self.least, self.tops.min(axis=1))


def _search(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each shard, each query's best."""
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, ids, points = None, None, None, None
        blocks: OrderedDict[int, Block] = OrderedDict()
        for row in rows_of(batches):
            if row["kind"].as_py() == 0:
                ids, tree, shard = array_of(row["ids"], np.int64), None, row["shard"].as_py()
                points = array_of(row["points"], np.int64).reshape(len(ids), -1)
                continue
            if row["shard"].as_py() != shard:
                continue  # no shard has this number
            name = row["block"].as_py()
            if name not in blocks:
                blocks[name] = Block(array_of(row["query_ids"], np.int64), array_of(row["queries"], np.int64), array_of(row["least"], np.float64), k)
                if len(blocks) > BLOCKS_KEPT:
                    blocks.popitem(last=False)
            blocks.move_to_end(name)
            own = blocks[name]
            width = max(own.points.shape[1], points.shape[1])
            if tree is None or tree.points.shape[1] != width:
                tree = Tree(_padded(points, width))
            q, r, s = search(own.tree(width), own.least, own.ids, tree, ids, k)
            own.seen(q, s.astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(own.ids[q]), pa.array(ids[r]), pa.array(s, pa.int64())], names=names)

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")
