"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refnet.llm import chat, covertree, decontam, language, lengths, lexical, licenses, ngramjoin, oracles, packing, prefixtrie, secrets, simhash, warc
from refnet.llm.common import ship, table


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def op2_license_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_phrases").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op3_token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = lengths.suffix_sums(lengths.histogram(table(spark, sf_dir, "documents").select("text")))
    # The share of documents within each length: the first length that has a share is its quantile.
    return sums.withColumn("quantile_share", (F.col("total_docs") - F.col("docs_over")) / F.col("total_docs"))


def op4_ngram_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_components(table(spark, sf_dir, "documents")).drop("text_hash", "label")


def op5_warc_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op6_secret_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = joined(F.filter("spans", lambda s: s["kind"] != "random"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("random")
    )


def op7_decontamination_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_matches(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


def op8_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digest(turns.unionByName(own))


def op9_language_hypervectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, ["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op10_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = covertree.quantized(table(spark, sf_dir, "embeddings"))
    return covertree.top_k(data, F.col("vec_id") % 20 == 0, k=20)


def op11_prefix_trie_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("conv_id") - F.col("conv_id") % 5
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"), base, heads, 8).drop("node")


def op12_pair_bound_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item")


def op13_simhash_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _shipped(f) for name, f in sorted(globals().items()) if name.startswith("op")}

#: In ``oracles``; the others' models, tokens or battery are beyond SQL, tests hold them against brute force.
ORACLES: dict[str, str] = oracles.ORACLES
