"""From raw documents to packed training sequences, in stages that each write a table for the next one.

Each stage takes (spark, docs, sf_dir) and judges its own input alone. All but the last return the columns of documents:

* language_id drops documents without any letter, and those that resemble no learned language at all;
* near_duplicates keeps one document of each group of near copies (five-word Jaccard of 0.8 or more), that with the
  smallest id;
* decontamination drops documents a twentieth of whose words are benchmark passages;
* secrets keeps every document and replaces what is secret in its text;
* packing cuts what is left into full training sequences.

Defined results: of equal rows one remains after near_duplicates; rows of a null doc_id go if they are near copies of one
with an id, and of near copies that all have none one stays; other columns than those of documents are left behind; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refnet.llm import decontam, language, ngramjoin, packing, secrets
from refnet.llm.common import ship, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_K, NEAR_PERCENT = 5, 80  # op4's query has its own, 4 and 85


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops a document if its text is null or has no letter, or has no positive cosine with any learned language. ``lang``
    stays as given."""
    ship(spark)
    found = language.identify(docs.select(*COLUMNS), COLUMNS)
    return found.filter((F.col("lang_pred") != language.UND) & (F.col("score") > 0)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents stays: that with the smallest id (null ids last), then the smallest
    hash of its text. Documents without words are components of their own; of those with one id and text one stays."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    found = ngramjoin.join_components(docs, k=NEAR_K, percent=NEAR_PERCENT)
    found = stored(found.select("doc_id", "text_hash", "label"), "labelled")  # read twice below
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_null"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    linked = found.filter("label is not null").groupBy("label").agg(least.alias("_least")).select("_least._id", "_least._hash")
    stay = linked.union(found.filter("label is null").select("doc_id", "text_hash"))
    hashed = docs.withColumn("_text", F.xxhash64("text"))
    kept = hashed.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_text"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark window of which at least a twentieth of their words is hit."""
    ship(spark)
    return decontam.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced in ``text``; ``n_chars`` of changed documents follows the new text."""
    ship(spark)
    docs = docs.select(*COLUMNS).withColumn("_before", F.char_length("text"))
    clean = secrets.redact(docs)
    length = F.char_length("text").cast("long")
    return clean.withColumn("n_chars", F.when(length != F.col("_before"), length).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents by sequence, with their source and ids."""
    ship(spark)
    return packing.pack(docs.select(*COLUMNS), ["doc_id", "source"], with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Language models, tokens and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
