"""Lexical retrieval packing of whole documents into training sequences.

Each document is encoded and ends with id ``end_id``. Full windows of a long document are sequences of their own. What is
left of each document goes to a shard: the table is range-partitioned by a lexical signature (min-hash of the ids) and the
row, so documents of like words meet, partitions are even, and copies of one document spread over as many as they need.
A partition is packed in shards of bounded size, in ids and in documents. Each has a BM25 inverted index of its documents' ids, weighted by the
document frequencies of the whole corpus. The next unused document is the seed of a window and asks the index, with its
``query_terms`` heaviest terms, for unused neighbours, best first, which fill the window greedily; the last one is cut to
fit and what is left of it seeds the next window. A window still open at a shard's end goes on in the next one. What a
partition has left at its end is cut into sequences whose lengths are powers of two, so no sequence needs padding.

The encoded table is written once to the shared folder. Document frequencies (one number for each id of the vocabulary)
and the totals are all that goes to the driver.

Defined results: null and empty texts are one id, ``end_id``; repeated rows are packed each; an empty table gives no
piece; sequence ids are unique and not dense.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import extended, pieces, stored, utf8
from refnet.llm.tokens import TOKENIZER, Encoder, tokenizer_path
from refnet.llm.words import mix

WINDOW = 2048
END_ID = 1
PART_TOKENS = 4_000_000  # of a partition
SHARD_TOKENS = 2_000_000
SHARD_DOCS = 1 << 16
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encode(docs: DataFrame, keep: list[str], end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` columns, _row, _tokens, _ids (little-endian 16-bit, the vocabulary has no more) and _sign of every row; and
    for each task a row of null _row with _term and _docs: of how many of its documents an id is part."""
    own = ["_row", "_tokens", "_ids", "_sign", "_term", "_docs"]
    schema = extended(docs, keep, "_row long, _tokens long, _ids binary, _sign long, _term array<int>, _docs array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, docs_of, kinds = Encoder.of(tokenizer_path(tokenizer)), np.zeros(1 << 16, np.int64), None
        for part in pieces(batches, "_utf8", 1 << 20):
            ids, at = encoder.encode(part.column("_utf8"))
            blobs, signs, n = [], [], part.num_rows
            for i in range(n):
                mine = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id))
                terms = np.unique(mine)
                docs_of[terms] += 1  # an id beyond 16 bits fails here
                signs.append(int(mix(terms.astype(np.uint64)).min() >> np.uint64(1)))
                blobs.append(mine.astype("<u2").tobytes())
            kinds = [part.schema.field(c).type for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in [*keep, "_row"]), pa.array(np.diff(at) + 1), pa.array(blobs, pa.binary()), pa.array(signs, pa.int64()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))],
                names=[*keep, *own],
            )
        if kinds is not None:
            terms = np.flatnonzero(docs_of)
            nulls = [pa.nulls(1, t) for t in [*kinds, pa.int64(), pa.int64(), pa.binary(), pa.int64()]]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array([terms], pa.list_(pa.int32())), pa.array([docs_of[terms]], pa.list_(pa.int64()))], names=[*keep, *own])

    return docs.select(*keep, F.monotonically_increasing_id().alias("_row"), utf8("text").alias("_utf8")).mapInArrow(run, schema)


class Index:
    """A BM25 inverted index of one shard, with the corpus's document frequencies."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float, query_terms: int, k1: float = 1.2, b: float = 0.75):
        self.n, self.query_terms = len(docs), query_terms
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        cells = np.repeat(np.arange(len(docs), dtype=np.int64), sizes) * len(idf) + np.concatenate(docs)
        cells, counts = np.unique(cells, return_counts=True)
        doc, term = np.divmod(cells, len(idf))
        weight = idf[term] * counts * (k1 + 1) / (counts + k1 * (1 - b + b * sizes[doc] / mean_length))
        self.bounds = np.searchsorted(doc, np.arange(len(docs) + 1))  # terms of each document
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.posting, self.score = doc[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """The scores of all documents against the seed's heaviest terms."""
        own = slice(self.bounds[seed], self.bounds[seed + 1])
        terms, weight = self.term[own], self.weight[own]
        if len(terms) > self.query_terms:
            terms = terms[np.argpartition(-weight, self.query_terms)[: self.query_terms]]
        lo, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        total = np.cumsum(size)
        at = np.repeat(lo - (total - size), size) + np.arange(total[-1])
        return np.bincount(self.posting[at], weights=self.score[at], minlength=self.n)


class Document(NamedTuple):
    """What is left of a document after its full windows."""

    row: dict  # the columns to keep
    tokens: int  # of the whole document
    start: int
    ids: np.ndarray


Window = list[tuple[Document, int, int]]  # (document, start within its rest, length)


def best_first(scores: np.ndarray, unused: np.ndarray, most: int) -> list[int]:
    """The ``most`` unused documents with the largest scores above 0, best first and the first of equal ones."""
    some = np.flatnonzero(unused & (scores > 0))
    own = scores[some]
    if len(some) > most:
        least = np.partition(own, len(own) - most)[len(own) - most]
        above, equal = np.flatnonzero(own > least), np.flatnonzero(own == least)
        chosen = np.r_[above, equal[: most - len(above)]]
        some, own = some[chosen], own[chosen]
    return some[np.lexsort((some, -own))].tolist()


def fill(docs: list[Document], idf: np.ndarray, mean: float, window: int, query_terms: int, open_: Window) -> Iterator[Window]:
    """All windows of one shard, of which the first goes on with ``open_``; the last one may not be full."""
    index = Index([d.ids for d in docs], idf, mean, query_terms)
    start, left = np.zeros(len(docs), np.int64), np.fromiter((len(d.ids) for d in docs), np.int64, len(docs))
    unused, remaining, following = np.ones(len(docs), bool), len(docs), 0
    parts, space = open_, window - sum(n for _, _, n in open_)
    near: Iterator[int] | None = None  # the seed's neighbours; each takes one id at least, so ``space`` are enough
    cut = None
    while remaining:
        chosen = next((d for d in near if unused[d]), None) if near is not None else None
        if chosen is None:  # a new seed: what the last cut has left, or the next document
            while not unused[following]:
                following += 1
            chosen = following if cut is None else cut
            near, cut = iter(best_first(index.neighbours(chosen), unused, space)), None
        n = int(min(space, left[chosen]))
        parts.append((docs[chosen], int(start[chosen]), n))
        start[chosen] += n
        left[chosen] -= n
        space -= n
        if not left[chosen]:
            unused[chosen] = False
            remaining -= 1
        if not space:
            yield parts
            cut = chosen if left[chosen] else None
            parts, space, near = [], window, None
    if parts:
        yield parts


def pack_partition(docs: Iterator[Document], idf: np.ndarray, mean: float, window: int, query_terms: int) -> Iterator[Window]:
    """The sequences of a partition, shard by shard: full windows, at the end some whose length is a power of two."""
    shard, tokens, open_ = [], 0, []

    def pack_shard() -> Iterator[Window]:
        nonlocal open_
        last, open_ = open_, []
        for parts in fill(shard, idf, mean, window, query_terms, last):
            if sum(n for _, _, n in parts) == window:
                yield parts
            else:
                open_ = parts

    for doc in docs:
        shard.append(doc)
        tokens += len(doc.ids)
        if tokens >= SHARD_TOKENS or len(shard) >= SHARD_DOCS:
            yield from pack_shard()
            shard, tokens = [], 0
    if shard:
        yield from pack_shard()
    total = sum(n for _, _, n in open_)
    for power in range(total.bit_length() - 1, -1, -1):
        need, own = total & 1 << power, []
        while need:
            doc, at, n = open_.pop(0)
            own.append((doc, at, min(n, need)))
            if n > need:
                open_.insert(0, (doc, at + need, n - need))
            need -= min(n, need)
        if own:
            yield own


def statistics(coded: DataFrame, window: int) -> tuple[np.ndarray, float, int]:
    """Inverse document frequencies, mean length and the number of ids beyond full windows, of an encoded table."""
    cells = coded.filter("_term is not null").select(F.explode(F.arrays_zip("_term", "_docs")).alias("c"))
    found = cells.groupBy(F.col("c._term").alias("term")).agg(F.sum("c._docs").alias("docs")).collect()  # one for each id of the vocabulary
    total = coded.filter("_row is not null").agg(F.count("*").alias("docs"), F.sum("_tokens").alias("tokens"), F.sum(F.col("_tokens") % window).alias("rest")).first()
    known = np.zeros(max((r["term"] for r in found), default=0) + 1, np.int64)
    for r in found:
        known[r["term"]] = r["docs"]
    idf = np.log1p((total["docs"] - known + 0.5) / (known + 0.5))
    return idf, (total["tokens"] or 0) / max(1, total["docs"]), total["rest"] or 0


def pack(docs: DataFrame, keep: list[str], window: int = WINDOW, query_terms: int = 24, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: ``keep`` columns, PIECES, and the piece's ids (32-bit) if asked for."""
    coded = stored(encode(docs, keep, end_id), "encoded")
    idf, mean, rest = statistics(coded, window)
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    schema = extended(docs, keep, PIECES + (", ids binary" if with_ids else ""))

    def write(sequences: Iterator[Window], odd: int, fields: list[pa.Field]) -> Iterator[pa.RecordBatch]:
        """Numbers the sequences: by task, odd for full windows of one document."""
        number, out = TaskContext.get().partitionId() << 33, []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kept = [pa.array([row[f.name] for row in columns[0]], f.type) for f in fields]
            own = [pa.array(c, pa.int64()) for c in columns[1:7]]
            return pa.RecordBatch.from_arrays([*kept, *own, *([pa.array(columns[7], pa.binary())] if with_ids else [])], names=schema.names)

        for parts in sequences:
            offset = 0
            for doc, at, n in parts:
                ids = doc.ids[at : at + n].astype("<u4").tobytes()
                out.append((doc.row, doc.start + at, n, zlib.crc32(ids), doc.tokens, 2 * number + odd, offset, ids if with_ids else None))
                offset += n
            number += 1
            if len(out) >= (256 if with_ids else 4096):
                yield batch()
                out.clear()
        if out:
            yield batch()

    def documents(batches: Iterator[pa.RecordBatch], fields: list[pa.Field]) -> Iterator[Document]:
        for part in batches:
            fields[:] = [part.schema.field(c) for c in keep]
            for row, tokens, ids in zip(part.select(keep).to_pylist() if keep else [{}] * part.num_rows, part.column("_tokens").to_pylist(), part.column("_ids").to_pylist(), strict=True):
                ids = np.frombuffer(ids, "<u2")
                yield Document(row, tokens, tokens - len(ids), ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields: list[pa.Field] = []
        whole = ([(d, a, window)] for d in documents(batches, fields) for a in range(0, len(d.ids) - window + 1, window))
        yield from write(whole, 1, fields)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields: list[pa.Field] = []
        yield from write(pack_partition(documents(batches, fields), shared.value, mean, window, query_terms), 0, fields)

    rows = coded.filter("_row is not null")
    full = rows.filter(F.col("_tokens") >= window).select(*keep, "_tokens", "_ids").mapInArrow(cut, schema)
    left = F.col("_tokens") % window
    rests = rows.filter(left > 0).withColumn("_ids", F.substring(F.col("_ids"), 2 * (F.col("_tokens") - left) + 1, 2 * left))
    parts = max(1, math.ceil(rest / PART_TOKENS))
    spread = rests.repartitionByRange(parts, "_sign", "_row").sortWithinPartitions("_sign", "_row")
    return full.unionByName(spread.select(*keep, "_tokens", "_ids").mapInArrow(packed, schema))
