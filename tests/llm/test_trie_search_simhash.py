"""Prefix trie, ranked lexical search and SimHash against brute force: odd rows, ties, copies, hot groups, empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

from refnet.llm import lexical, prefixtrie, simhash
from refnet.llm.common import ship
from refnet.llm.queries import QUERIES


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# --- prefix trie ---------------------------------------------------------------------------------------------------


def base_of(c):
    return c - int(math.fmod(c, 5))


def trie(rows):
    """Rows (conv_id, turn, role, text) -> the rows of the trie."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(base_of(c), [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, saved = Counter(), Counter()
    for s in members:
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (
            (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), leaves[s], saved[s], digest([c for c in m if rebuilt[c] == s]))
            for s, m in members.items()
        ),
        key=repr,
    )


def trie_of(turns):
    found = prefixtrie.prefix_trie(turns, F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9, 8).drop("node")
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(f.dataType.simpleString() == ("string" if f.name == "ends_sha256" else "bigint") for f in found.schema)
    return sorted((tuple(r) for r in found.collect()), key=repr)


TURNS = "conv_id long, turn long, role string, text string, depth string, node string, rep long, _base string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], TURNS).repartition(3)


def test_trie_of_odd_conversations(spark):
    rng = random.Random(5)
    rows = [(None, 0, "user", "no id"), (0, None, None, None), (0, 1, "user", "é"), (7, 1, "user", "tie b"), (7, 1, "user", "tie a"), (7, 1, "user", "tie a"), (-3, 0, "user", "x"), (-5, 0, "user", "y"), (-9, 2, None, "z" * 5000)]
    rows += [(c, t, "user", f"hello {rng.randrange(2)}") for c in range(10, 60) for t in range(rng.randrange(1, 12))]  # bases and many that share turns
    rows += [(c, t, "ab", "c") for c in range(100, 130) for t in range(3)] + [(c, 0, "a", "bc") for c in range(131, 135)]  # base 130 is absent
    assert trie_of(frame(spark, rows)) == trie(rows)


def test_trie_with_hot_prefixes_and_copies(spark):
    rows = [(5 * c, 0, "user", "hi") for c in range(3000)] + [(5 * c, 1, "assistant", f"reply {c}") for c in range(0, 3000, 2)]
    assert trie_of(frame(spark, rows)) == trie(rows)


def test_trie_of_one_long_conversation(spark):
    """Each node once, however long the conversation: not a row for each node and ancestor."""
    n = 70_000
    turns = spark.range(n).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    other = spark.range(3).select(F.lit(10).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    found = prefixtrie.prefix_trie(turns.union(other), F.col("conv_id"), F.lit(0), 0)
    top = found.filter("depth <= 4").orderBy("depth").collect()
    assert found.count() == n + 1 and [r["n_convs"] for r in top] == [2, 2, 2, 2, 1] and [r["n_leaves"] for r in top] == [1] * 5
    assert [r["saved_tokens"] for r in top] == [3, 3, 2, 1, 0]


def test_trie_of_no_conversations(spark):
    empty = frame(spark, [(1, 0, "user", "x")]).limit(0)
    assert trie_of(empty) == []
    assert trie_of(frame(spark, [(1, 0, "user", "x")])) == trie([(1, 0, "user", "x")]) != []  # its base is absent


# --- ranked lexical search -----------------------------------------------------------------------------------------


def rankings(docs, items, k):
    """[(item_id, rank, doc_id, score)] by scoring every document."""
    terms = [Counter(brute.words(t)) for _, t in docs]
    n, length = sum(bool(t) for t in terms), sum(t.total() for t in terms)
    df = Counter(w for t in terms for w in t)
    out = []
    for item, text in set(items):
        asked, scored = set(brute.words(text)), []
        for (doc, _), t in zip(docs, terms, strict=True):
            m = 50 + 50 * t.total() * n // length if length else 0
            s = sum(math.floor(1000 * math.log((2.0 * n + 2) / (2 * df[w] + 1))) * (10**9 * t[w] // (1000 * t[w] + 20 * m)) for w in asked if t[w])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def ranked(docs, items, k):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.ranked(docs, items, k).collect()), key=repr)


DOCS = "doc_id long, text string, shard string, term string, item string, ids string"


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["THE", "the", "of", "naïve"]
    weight = [1 / (i + 1) for i in range(60)] + [8, 8, 8, 1]
    return [(i, " ".join(rng.choices(words, weight, k=rng.choice([1, 5, 20, 60])))) for i in range(n)]


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(2)
    docs = corpus(rng, 700)
    docs += [(i, "the of w3 w4 w5 same copies") for i in range(2000, 2200)]  # ties
    docs += [(None, "w3 w4 no id"), (5, "w1 again"), (None, None), (3000, ""), (3001, " .. "), (3002, "w9 " * 20_000), (3003, "x" * 50_000)]
    items = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)] + ["the", "of", "unknown"], k=rng.choice([1, 2, 8, 30])))) for i in range(40)]
    items += [(50, "w3 w4 w5 The OF same"), (51, None), (52, "!!"), (53, "nowhere"), (54, "w1 w1 w1"), (54, "w2"), (54, "w2"), (None, "w7")]
    return docs, items


def test_ranking_of_odd_rows(spark, searched):
    docs, items = searched
    expect = rankings(docs, items, 20)
    a = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, doc_id long, item string")
    assert ranked(a, b, 20) == expect and ranked(a, b, 1) == rankings(docs, items, 1)


def test_ranking_over_many_shards_and_blocks(spark, searched, monkeypatch):
    docs, items = searched
    monkeypatch.setattr(lexical, "BLOCK", 5)
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(30)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.postings(a).filter("term is null").count() > 1
    assert ranked(a, b, 7) == rankings(docs, items, 7)


def test_a_pair_lowers_the_bound_and_keeps_the_ranking():
    """Two terms that never meet: the pair's bound is the larger of the two, not their sum."""
    rng = np.random.default_rng(3)
    shard, kth = lexical.Shard(400, np.arange(400)), lambda s: int(np.sort(s)[-10]) if len(s) >= 10 else 0
    for t in range(12):
        docs = np.flatnonzero(rng.random(400) < 0.3)
        scores = rng.integers(1, 1000, len(docs))
        shard.lists[t] = docs, scores, int(scores.max()), kth(scores)
    terms, weights = list(range(12)), [12 - t for t in range(12)]
    plain = sum(b for b, _ in shard.groups(terms, weights))
    for a, b in lexical.term_pairs(terms, weights):
        one, two = (dict(zip(*map(np.ndarray.tolist, shard.lists[t][:2]), strict=True)) for t in (a, b))
        both = np.array([d for d in one if d in two], np.int64)
        joint = np.array([one[d] + two[d] for d in both.tolist()], np.int64)
        shard.pairs[a, b] = both, int(joint.max(initial=0)), kth(joint)
    assert sum(b for b, _ in shard.groups(terms, weights)) < plain
    total = np.zeros(400, np.int64)
    for docs, scores, *_ in shard.lists.values():
        total[docs] += scores
    order = np.lexsort((np.arange(400), -total))[:10]
    for bar in (0, int(total[order[-1]])):
        docs, sums = shard.search(terms, weights, 10, bar)
        assert docs.tolist() == order.tolist() and sums.tolist() == total[order].tolist()


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked(docs, items, 5) == rankings([(1, "a b")], [(1, "a")], 5) != []
    assert ranked(docs.limit(0), items, 5) == ranked(docs, items.limit(0), 5) == ranked(docs.limit(0), items.limit(0), 5) == []


# --- SimHash -------------------------------------------------------------------------------------------------------


def fingerprint(text, k=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def near(docs, radius=4):
    """[(doc_id, fingerprint, component)], all pairs of distinct fingerprints compared."""
    prints = [fingerprint(t) for _, t in docs]
    distinct = np.unique(np.array(prints, np.uint64))
    roots = np.arange(len(distinct))
    i, j = np.nonzero(np.triu(np.bitwise_count(distinct[:, None] ^ distinct[None, :]) <= radius, 1))
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        parent[find(a)] = find(b)
    roots = [find(int(np.searchsorted(distinct, np.uint64(p)))) for p in prints]
    least = defaultdict(list)
    for (doc, _), r in zip(docs, roots, strict=True):
        least[r].append(doc)
    return sorted(((doc, f"{p:016x}", min((x for x in least[r] if x is not None), default=None)) for (doc, _), p, r in zip(docs, prints, roots, strict=True)), key=repr)


def near_of(docs, **kw):
    return sorted((tuple(r) for r in simhash.near_components(docs, **kw).collect()), key=repr)


def test_fingerprints():
    texts = ["", None, "a", " A b\t c  d e É x ", "a b c d", "x y z", "one two three four five six " * 3, "  ", *(f"w{i} " * 9 + "z\x0b" for i in range(30)), "ab " * 90_000]
    got = simhash.simhash(pa.array([t if t is None else t.encode() for t in texts], pa.binary()))
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]
    assert len(simhash.simhash(pa.array([], pa.binary()))) == 0


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
@pytest.mark.parametrize("sizes", [(1 << 12, 1 << 13), (150, 300)])
def test_bit_planes_find_every_close_pair(radius, sizes, monkeypatch):
    """Cells of two parts, small and large cells, against an exclusive or of all pairs."""
    monkeypatch.setattr(simhash, "CHUNK", sizes[0])
    monkeypatch.setattr(simhash, "SEGMENT", sizes[1])
    rng = np.random.default_rng(radius)
    cells, tables, second, prints, n = [], [], [], [], 0
    cuts = simhash.parts(radius)
    pairs = [(a, b) for a in range(len(cuts)) for b in range(a + 1, len(cuts))]
    for cell, size in enumerate([1, 2, 2, 3, 64, 65, 130, 700, 5]):
        table = cell % len(pairs)
        fixed = sum(((1 << w) - 1) << at for at, w in (cuts[x] for x in pairs[table]))
        base = int(rng.integers(0, 2**63))
        own = []
        while len(own) < size:
            x = base
            for _ in range(int(rng.integers(0, 12))):
                bit = 1 << int(rng.integers(64))
                x ^= bit if not bit & fixed else 0
            own.append(x)
        side = np.sort(rng.random(size) < 0.4) if cell % 2 else np.zeros(size, bool)
        cells += [cell] * size
        tables += [table] * size
        second += side.tolist()
        prints += own
    cells, tables, second, prints = np.array(cells), np.array(tables), np.array(second), np.array(prints, np.uint64)
    a, b = simhash.linked(cells, tables, second, prints, radius)
    want = np.arange(len(prints))
    two = {c for c in cells.tolist() if second[cells == c].any()}
    for i in range(len(prints)):
        for j in range(i):
            if cells[i] == cells[j] and (cells[i] not in two or second[i] != second[j]) and int(prints[i] ^ prints[j]).bit_count() <= radius:
                simhash.merge(want, np.array([i]), np.array([j]))
    moved = np.flatnonzero(want != np.arange(len(want)))
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(prints[moved].tolist(), prints[want[moved]].tolist()))


def test_simhash_of_odd_documents(spark):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(300)]
    docs = [(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (5, "ONE"), (None, "one"), (None, "alone in its own words here"), (6, "y" * 100_000), (7, "long text " * 30_000)]
    for d in range(60):
        own = rng.choices(words, k=120)
        docs.append((100 + 10 * d, " ".join(own)))
        for c in range(rng.randrange(4)):
            own[rng.randrange(120)] = "changed"
            docs.append((101 + 10 * d + c, "  ".join(own)))
    schema = "doc_id long, text string, fp string, block string, i string, j string, label string, node string"
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in docs], schema).repartition(3)
    expect = near(docs)
    assert near_of(frame) == expect and len({c for *_, c in expect}) < len(docs) - 30
    assert near_of(frame, shares=10_000) == expect  # every block is dealt over cells
    assert near_of(frame, radius=7) == near(docs, 7) and near_of(frame, radius=0) == near(docs, 0)
    assert near_of(frame.limit(0)) == []


def test_simhash_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_simhash_bit_sliced"](spark, SF_SMALL).collect()), key=repr)
    assert got == near(docs)
