"""Ranked lexical search with MaxScore, its bounds tightened by lists of term pairs.

A document's score is the sum, over a query's distinct terms, of weight x impact, all in integers: the weight is
floor(1000 ln((2N + 2) / (2 df + 1))), the impact (10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L; N documents
have a term, they have L terms in all, this one has n, and df documents hold the term tf times or more than none.

1. ``postings`` cuts the documents into shards of bounded size and inverts each in one task, all terms of all documents.
2. ``weights`` adds up df, N and L over all shards.
3. ``impact_index`` stores each wanted term's list of impacts by shard, with its largest score, and for pairs of terms that
   queries hold together (neighbours in a query's text, and in its order of weights) the list of documents with both, the
   largest joint score and the k-th best one.
4. ``search`` takes a query's terms apart into pairs, first those whose list lowers the bound most. A pair adds no more than
   the largest of its joint score and its two single ones, less than the sum of the single ones that plain MaxScore allows.
   From the pair or term with the largest bound on, scores are added up; once the bounds of the rest together fall below
   the k-th best score, no further document can enter. Each remaining candidate then gets a bound of its own: of a pair, the
   joint maximum if the pair's list has it, else the larger single one. The rest is looked up for the candidates alone,
   fewer after each step. The k-th best joint score of a list, and that of the task's earlier shards, are where the bar starts.

Queries go to the shards as rows, in blocks of bounded size, through a shuffle; nothing of them passes the driver. A task
holds one shard and one block.

Defined results: null texts and texts without terms match nothing; an item without a term that any document holds has no
rows; equal scores go by the document's id, nulls last; rows that repeat an id are documents each; items are the distinct
rows (id, text) and are ranked one by one, also where they share an id; other columns are ignored; terms stand as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import SHARDS_PER_TASK, array_of, by_shard, pieces, rows_of, stored, utf8
from refnet.llm.words import ALNUM, word_hashes

TOP = 50
SHARD_DOCS, SHARD_BYTES = 1 << 14, 16 << 20
BLOCK = 256  # queries of a block, about
QUERY_TERMS = 1 << 16  # terms of one row of queries; a longer text is cut into rows that share its number

POSTINGS = "shard long, term long, df long, docs binary, tfs binary, n_docs long, n_words long"
INDEX = "shard long, kind int, term long, other long, w long, docs binary, impacts binary, most long, kth long"


def cut_binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values: the parts of an array between the offsets."""
    offsets = (at * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def postings(docs: DataFrame) -> DataFrame:
    """The inverted shards of ``docs`` (doc_id, text): a row for each term, and one without a term that has the documents' ids
    and lengths (``tfs``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * SHARDS_PER_TASK
        number = 0

        def shard(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            words, at = word_hashes(part.column("_utf8"), ALNUM)
            lengths = np.diff(at)
            terms, term = np.unique(words, return_inverse=True)
            key, tf = np.unique(term * len(lengths) + np.repeat(np.arange(len(lengths)), lengths), return_counts=True)
            of, doc = np.divmod(key, len(lengths)) if len(key) else (key, key)
            cut = np.searchsorted(of, np.arange(len(terms) + 1))
            name = first + number

            def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
                ids = columns.pop("ids", pa.nulls(n, pa.list_(part.schema.field("doc_id").type)))
                empty = {"shard": pa.array(np.full(n, name)), "term": pa.nulls(n, pa.int64()), "df": pa.nulls(n, pa.int64()), "docs": pa.nulls(n, pa.binary())}
                empty |= {"tfs": pa.nulls(n, pa.binary()), "n_docs": pa.nulls(n, pa.int64()), "n_words": pa.nulls(n, pa.int64())}
                every = empty | columns | {"ids": ids}
                return pa.RecordBatch.from_arrays(list(every.values()), names=list(every))

            yield rows(
                1,
                ids=pa.array([part.column("doc_id").to_pylist()], pa.list_(part.schema.field("doc_id").type)),
                tfs=pa.array([lengths.astype(np.int32).tobytes()], pa.binary()),
                n_docs=pa.array([int((lengths > 0).sum())], pa.int64()),
                n_words=pa.array([int(lengths.sum())], pa.int64()),
            )
            for a in range(0, len(terms), 1 << 14):
                own = cut[a : a + (1 << 14) + 1]
                inside = slice(own[0], own[-1])
                yield rows(
                    len(own) - 1,
                    term=pa.array(terms[a : a + len(own) - 1].view(np.int64)),
                    df=pa.array(np.diff(own).astype(np.int64)),
                    docs=cut_binary(doc[inside].astype(np.uint16), own - own[0]),
                    tfs=cut_binary(tf[inside].astype(np.int32), own - own[0]),
                )

        def whole() -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for part in pieces(batches, "_utf8"):
                more = part.column("_utf8").nbytes
                if held and (size + more > SHARD_BYTES or sum(p.num_rows for p in held) + part.num_rows > SHARD_DOCS):
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
                for a in range(0, part.num_rows, SHARD_DOCS):
                    held.append(part.slice(a, SHARD_DOCS))
                    if part.num_rows > SHARD_DOCS:
                        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                        held = []
                size += more if held else 0
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for part in whole():
            yield from shard(part)
            number += 1

    return docs.select("doc_id", utf8("text").alias("_utf8")).mapInArrow(invert, f"{POSTINGS}, ids array<{kind}>")


def query_terms(items: DataFrame) -> DataFrame:
    """(item, part, terms): the distinct terms of each row of ``items`` (item, text), in order."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "_utf8"):
            words, at = word_hashes(part.column("_utf8"), ALNUM)
            item, number, terms = [], [], []
            for i, a, b in zip(part.column("item").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own, first = np.unique(words[a:b], return_index=True)
                own = own[np.argsort(first)].view(np.int64)
                for n in range(0, len(own), QUERY_TERMS):
                    item.append(i), number.append(n // QUERY_TERMS), terms.append(own[n : n + QUERY_TERMS])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(number, pa.int32()), pa.array(terms, pa.list_(pa.int64()))], names=["item", "part", "terms"])

    return items.select("item", utf8("text").alias("_utf8")).mapInArrow(split, "item long, part int, terms array<long>")


def weights(found: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, int, int]:
    """(term, w) of the terms of ``vocabulary`` that occur, N and L."""
    sums = found.filter("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("l")).first()
    n, length = sums["n"] or 0, sums["l"] or 0
    df = found.filter("term is not null").join(vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")
    return df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")), n, length


def query_blocks(terms: DataFrame, weighed: DataFrame) -> DataFrame:
    """(block, queries): queries of about BLOCK items with their weighed terms, in the order of their texts."""
    count = terms.select("item").distinct().count()
    known = terms.select("item", "part", F.posexplode("terms").alias("pos", "term")).join(weighed, "term")
    whole = known.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("part", "pos", "term", "w"))).alias("t"))
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-count // BLOCK)))).alias("block")
    query = F.struct("item", F.col("t.term").alias("terms"), F.col("t.w").alias("weights"))
    return whole.select(block, query.alias("query")).groupBy("block").agg(F.collect_list("query").alias("queries"))


def term_pairs(terms: list[int], weights: list[int]) -> set[tuple[int, int]]:
    """Neighbours in the query's text and in its order of weights, the smaller term first."""
    order = [t for _, t in sorted(zip(weights, terms, strict=True), reverse=True)]
    both = [*zip(terms, terms[1:]), *zip(order, order[1:])]
    return {(min(x), max(x)) for x in both}


def impact_index(found: DataFrame, weighed: DataFrame, blocks: DataFrame, n: int, length: int, k: int) -> DataFrame:
    """The lists of the weighed terms (kind 1) and of the pairs of terms that queries of ``blocks`` hold (kind 2), each with
    its largest score and its ``k``-th best (0: it has fewer)."""
    heads = found.filter("term is null").select("shard", F.lit(0).alias("kind"), "tfs")
    lists = found.filter("term is not null").join(weighed, "term").select("shard", F.lit(1).alias("kind"), "tfs", "term", "w", "docs")
    rows = by_shard(heads.unionByName(lists, allowMissingColumns=True), blocks, heads)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        shard = None
        m = np.zeros(0, np.int64)
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        done: set[tuple[int, int]] = set()

        def sent() -> pa.RecordBatch:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else [()] * len(types)
            names = ["shard", "kind", "term", "other", "w", "docs", "impacts", "most", "kth"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            out.clear()
            return batch

        def put(kind: int, term: int, other: int | None, w: int | None, docs: np.ndarray, impacts: np.ndarray | None, scores: np.ndarray) -> None:
            nonlocal size
            kth = int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0
            held = None if impacts is None else impacts.astype(np.int32).tobytes()  # an impact is a million at most
            out.append((shard, kind, term, other, w, docs.astype(np.uint16).tobytes(), held, int(scores.max(initial=0)), kth))
            size += 100 + 6 * len(docs)

        for row in rows_of(batches):
            if row["shard"].as_py() != shard:
                shard, lists, done = row["shard"].as_py(), {}, set()
                m = np.zeros(0, np.int64)
            kind = row["kind"].as_py()
            if kind == 0:
                m = 50 + 50 * array_of(row["tfs"], np.int32).astype(np.int64) * n // length if length else m
            elif kind == 1:
                docs, tf = array_of(row["docs"], np.uint16).astype(np.int64), array_of(row["tfs"], np.int32).astype(np.int64)
                impacts, w = 1_000_000_000 * tf // (1000 * tf + 20 * m[docs]), row["w"].as_py()
                lists[row["term"].as_py()] = docs, w * impacts
                put(1, row["term"].as_py(), None, w, docs, impacts, w * impacts)
            elif lists:
                wanted = {p for q in row["queries"].as_py() for p in term_pairs(q["terms"], q["weights"])} - done
                done |= wanted
                place, held = np.full(len(m), -1), None
                for a, b in sorted(p for p in wanted if p[0] in lists and p[1] in lists):
                    docs, scores = lists[a]
                    if a != held:
                        if held is not None:
                            place[lists[held][0]] = -1
                        place[docs], held = np.arange(len(docs)), a
                    others, more = lists[b]
                    at = place[others]
                    both = at >= 0
                    put(2, a, b, None, others[both], None, scores[at[both]] + more[both])
                    if size > 4 << 20:
                        yield sent()
                        size = 0
            if size > 4 << 20:
                yield sent()
                size = 0
        yield sent()

    return rows.mapInArrow(score, INDEX)


class Shard:
    """The lists of one shard, and the search in them."""

    def __init__(self, size: int, order: np.ndarray):
        self.size = size
        self.order = order  # the rank of each document's id
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int, int]] = {}  # documents, scores, the largest, the k-th best
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, int, int]] = {}  # documents with both, their largest score, the k-th best
        self._scratch = np.zeros(size, np.int64)

    def groups(self, terms: list[int], weights: list[int]) -> list[tuple[int, tuple[int, ...]]]:
        """(bound, terms): the query's terms in pairs and alone, the largest bound first."""
        have = {t for t in terms if t in self.lists}
        single = {t: self.lists[t][2] for t in have}
        saved = []
        for a, b in term_pairs(terms, weights):
            if a in have and b in have and (a, b) in self.pairs:
                bound = max(self.pairs[a, b][1], single[a], single[b])
                saved.append((single[a] + single[b] - bound, bound, a, b))
        groups, free = [], set(have)
        for gain, bound, a, b in sorted(saved, reverse=True):
            if gain > 0 and a in free and b in free:
                groups.append((bound, (a, b)))
                free -= {a, b}
        return sorted(groups + [(single[t], (t,)) for t in free], reverse=True)

    def bounds(self, group: tuple[int, ...], docs: np.ndarray) -> np.ndarray | int:
        """What a group can add to each of some documents."""
        if len(group) == 1:
            return self.lists[group[0]][2]
        both, joint, _ = self.pairs[group]
        self._scratch[both] = 1
        inside = self._scratch[docs] == 1
        self._scratch[both] = 0
        return np.where(inside, joint, max(self.lists[t][2] for t in group))

    def scores_of(self, term: int, docs: np.ndarray) -> np.ndarray:
        """What the term adds to some documents."""
        have, scores, *_ = self.lists[term]
        if len(docs) * 16 < len(have):
            at = np.searchsorted(have, docs)
            at[at == len(have)] = 0
            return np.where(have[at] == docs, scores[at], 0)
        self._scratch[have] = scores
        found = self._scratch[docs]
        self._scratch[have] = 0
        return found

    def search(self, terms: list[int], weights: list[int], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best of at least ``bar`` and above 0, fewer if there are fewer."""
        groups = self.groups(terms, weights)
        bar = max(bar, 1)
        for _, group in groups:  # k documents have that much at least
            bar = max(bar, self.pairs[group][2] if len(group) == 2 else 0, *(self.lists[t][3] for t in group))
        rest = sum(bound for bound, _ in groups)
        total = np.zeros(self.size, np.int64)
        at = 0
        while at < len(groups) and rest >= bar:
            for t in groups[at][1]:
                docs, scores, *_ = self.lists[t]
                total[docs] += scores
            rest -= groups[at][0]
            at += 1
            if rest < total.max(initial=0) and self.size >= k:
                bar = max(bar, int(np.partition(total, self.size - k)[self.size - k]))
        docs = np.flatnonzero(total + rest >= bar)
        sums = total[docs]
        own = [self.bounds(group, docs) for _, group in groups[at:]]
        rests = sum(own, np.zeros(len(docs), np.int64))
        for n, (_, group) in enumerate(groups[at:]):
            left = sums + rests >= bar
            docs, sums, rests, own = docs[left], sums[left], rests[left], [b if isinstance(b, int) else b[left] for b in own]
            for t in group:
                sums = sums + self.scores_of(t, docs)
            rests = rests - own[n]
            if len(docs) > k:
                bar = max(bar, int(np.partition(sums, len(docs) - k)[len(docs) - k]))
        left = sums >= bar
        docs, sums = docs[left], sums[left]
        best = np.lexsort((self.order[docs], -sums))[:k]
        return docs[best], sums[best]


def search(found: DataFrame, index: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): the best documents of every shard for every query; the k best of all are among them."""
    heads = found.filter("term is null").select("shard", F.lit(0).alias("kind"), "ids")
    rows = by_shard(heads.unionByName(index, allowMissingColumns=True), blocks, heads)
    kind = found.schema["ids"].dataType.elementType.simpleString()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # of each query, the scores of this task's earlier shards
        own, name, ids = Shard(0, np.zeros(0, np.int64)), None, None
        for row in rows_of(batches):
            if row["shard"].as_py() != name:
                name, own, ids = row["shard"].as_py(), Shard(0, np.zeros(0, np.int64)), None
            kind = row["kind"].as_py()
            if kind == 0:
                ids = row["ids"].values
                order = np.empty(len(ids), np.int64)
                order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                own = Shard(len(ids), order)
            elif kind == 1:
                docs, scores = array_of(row["docs"], np.uint16).astype(np.int64), row["w"].as_py() * array_of(row["impacts"], np.int32).astype(np.int64)
                own.lists[row["term"].as_py()] = docs, scores, row["most"].as_py(), row["kth"].as_py()
            elif kind == 2:
                own.pairs[row["term"].as_py(), row["other"].as_py()] = array_of(row["docs"], np.uint16).astype(np.int64), row["most"].as_py(), row["kth"].as_py()
            elif own.lists:
                items, docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for q in row["queries"].as_py():
                    before = best.get(q["item"], np.zeros(0, np.int64))
                    hits, sums = own.search(q["terms"], q["weights"], k, int(before.min()) if len(before) == k else 0)
                    items.append(np.full(len(hits), q["item"])), docs.append(hits), scores.append(sums)
                    best[q["item"]] = np.sort(np.r_[before, sums])[-k:]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"])

    return rows.mapInArrow(rank, f"item long, doc_id {kind}, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score, item): the ``k`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id,
    text); ``item`` tells items of one id apart."""
    asked = items.select("item_id", "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    asked = stored(asked.groupBy("item").agg(F.first("item_id").alias("item_id"), F.first("text").alias("text")), "items")
    found = stored(postings(docs), "postings")
    terms = stored(query_terms(asked), "query-terms")
    weighed, n, length = weights(found, terms.select(F.explode("terms").alias("term")).distinct())
    weighed = stored(weighed.filter("w > 0"), "weights")
    blocks = stored(query_blocks(terms, weighed), "query-blocks")
    index = stored(impact_index(found, weighed, blocks, n, length, k), "impacts")
    hits = search(found, index, blocks, k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = hits.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = asked.select(F.col("item").alias("_item"), "item_id")
    return top.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score", "item")
