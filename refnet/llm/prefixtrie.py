"""The trie of all prefixes that conversations share, from whole sequences of turns.

A node is a distinct sequence of turns (role, text), named by a chain of hashes: a turn's SHA-256 is hashed with the name of
the node before it. Identical conversations collapse into one weighted sequence with the list of conversations that end
there, so copies cost nothing further on. Sequences that are no proper prefix of another (an anti-join with all parents) are
the leaves. Prefixes of the distinct sequences are then added up by weight.

What a subtree saves is summed without listing each node's ancestors: every node counts with the smallest leaf below it; on
a leaf's path those are the nodes from some depth on. So the sums from each depth of each leaf's path downwards, added up by
node, are the subtree's sums: one row for each turn of the distinct sequences.

A conversation's turns stream through a task in order, and so do the parts of a node's end list; nothing grows with a
conversation, a node's members or its children. Nodes with very many children are dealt out (``balanced_join``).

Defined results: null role or text is empty; turns of one number go by role and text, null numbers first; repeated rows are
turns each; rows without a conversation id belong to none and are left out; an empty table has no node at all; other columns
are ignored. ``%`` keeps the sign of a negative id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import stored
from refnet.plans.skew import balanced_join

ROOT = b"\0" * 16
ENDS = 10  # conversation ids that differ in so many low bits alone stand together


def rebuilt_rows(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """(conv_id, depth, node, parent, bytes, last): a row for the root and each turn of every rebuilt conversation, its first
    ``heads`` turns (``most`` at most) taken from conversation ``base``; both are expressions of conv_id."""
    turn = F.sha2(F.concat_ws("", F.length(F.col("_role")).cast("string"), F.lit(":"), F.col("_role"), F.col("_text")), 256)
    rows = turns.filter("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("_role"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.withColumn("_base", base)
    # The base conversation is the first of its group; only its hashed turns are kept, none of the others' are.
    order = ["_base", F.col("conv_id") != F.col("_base"), "conv_id", F.col("turn").asc_nulls_first(), "_role", "_text"]
    sorted_ = rows.repartition("_base").sortWithinPartitions(*order)
    hashed = sorted_.select("_base", "conv_id", heads.cast("int").alias("_heads"), F.unhex(turn).alias("_turn"), F.octet_length("_text").cast("long").alias("_bytes"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = conv = node = None
        heads: list[tuple[bytes, int]] = []
        depth = seen = skipped = 0
        out: tuple[list, ...] = ([], [], [], [], [], [])

        def put(turn: bytes, size: int) -> None:
            nonlocal depth, node
            parent, depth = node, depth + 1
            node = hashlib.sha256(parent + turn).digest()[:16]
            for column, value in zip(out, (conv, depth, node, parent, size, False), strict=True):
                column.append(value)

        def sent() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
            names = ["conv_id", "depth", "node", "parent", "bytes", "last"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)
            for column in out:
                column.clear()
            return batch

        def ended() -> None:
            if conv is not None:
                out[5][-1] = True

        for batch in batches:
            for g, c, h, turn, size in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if c != conv or g != group:
                    ended()
                    if len(out[0]) >= 1 << 14:
                        yield sent()
                    if g != group:
                        group, heads = g, []
                    conv, node, depth, seen, skipped = c, ROOT, 0, 0, h
                    for column, value in zip(out, (conv, 0, ROOT, None, 0, False), strict=True):
                        column.append(value)
                    if c != g:
                        for t, s in heads[:h]:
                            put(t, s)
                if c == g:
                    if seen < most:
                        heads.append((turn, size))
                    put(turn, size)  # its own first turns are its base's
                elif seen >= skipped:
                    put(turn, size)
                seen += 1
                if len(out[0]) >= 1 << 16:  # a very long conversation; its newest row may be its last
                    held = [column.pop() for column in out]
                    yield sent()
                    for column, value in zip(out, held, strict=True):
                        column.append(value)
        ended()
        if out[0]:
            yield sent()

    return hashed.mapInArrow(chain, "conv_id long, depth long, node binary, parent binary, bytes long, last boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, digest) of (node, conv_id): SHA-256 of the conversation ids in order, comma-joined. Ids that share their upper
    bits are joined first, so a node's part is a stream of such strings."""
    runs = ends.groupBy("node", F.shiftright("conv_id", ENDS).alias("run")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = runs.repartition("node").sortWithinPartitions("node", "run").select("node", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        nodes: list[bytes] = []
        digests: list[str] = []
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        nodes.append(node), digests.append(state.hexdigest())
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "digest"])
            nodes, digests = [], []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "digest"])

    return ordered.mapInArrow(digest, "node binary, digest string")


def collapsed(rows: DataFrame) -> DataFrame:
    """(seq, rep, weight) of :func:`rebuilt_rows`: each distinct whole sequence, its smallest conversation and how many there are."""
    return rows.filter("last").groupBy(F.col("node").alias("seq")).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"))


def prefix_trie(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node) of every node; the
    conversations are those of :func:`rebuilt_rows`."""
    rows = stored(rebuilt_rows(turns, base, heads, most), "prefix-rows")
    sequences = stored(collapsed(rows), "sequences")
    # A distinct sequence is known by its smallest conversation from here on.
    paths = stored(rows.join(sequences, F.col("conv_id") == F.col("rep")).select("rep", "weight", "depth", "node", "parent", "bytes"), "paths")

    # Leaves: sequences that are nobody's parent.
    inner = paths.filter("parent is not null").select("parent").distinct()
    leaves = sequences.join(inner, F.col("seq") == F.col("parent"), "left_anti").select(F.col("rep").alias("leaf"))
    marked = stored(paths.join(leaves, F.col("rep") == F.col("leaf"), "left"), "marked-paths")

    nodes = marked.groupBy("node", "depth", "parent", "bytes").agg(
        F.min("rep").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.min("leaf").alias("owner"),
    )
    nodes = stored(nodes, "nodes")

    own = nodes.select(F.col("owner").alias("_leaf"), F.col("depth").alias("_depth"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("_saved"))
    on_leaves = marked.filter("leaf is not null").select("leaf", "depth", "node")
    scored = on_leaves.join(own, (F.col("leaf") == F.col("_leaf")) & (F.col("depth") == F.col("_depth")), "left")
    below = F.sum(F.coalesce("_saved", F.lit(0))).over(Window.partitionBy("leaf").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))
    saved = scored.select("node", below.alias("below")).groupBy("node").agg(F.sum("below").alias("saved_tokens"))

    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    digests = end_digests(rows.filter("last").select("node", "conv_id"))
    known = stored(nodes.join(saved, "node", "left").join(children, "node", "left").join(digests, "node", "left"), "known-nodes")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = balanced_join(known, parents, ["parent"], "left", left_salt=["node"])
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        "node",
    )
