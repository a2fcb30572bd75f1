"""Helpers shared by the operators of this package: tables, the shared work folder, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refnet.session import work_dir

#: Bytes of text that one step inside a task works on at a time (a longer single text is a step of its own).
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Send this library to the executors, once for each Spark context, so that tasks can import it anywhere."""
    sc = spark.sparkContext
    if not getattr(sc, "_refnet_shipped", False):
        top = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="refnet-")) / "refnet.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(top.rglob("*.py")):
                z.write(file, file.relative_to(top.parent))
        sc.addPyFile(str(archive))
        sc._refnet_shipped = True
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, the folder that the driver and all executors share."""
    return work_dir(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Shard numbers that one task may give: a shard is its task times this, plus a running number.
SHARDS_PER_TASK = 1 << 20


def by_shard(rows: DataFrame, blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """``rows`` (shard, kind, ...) in one task a shard, in order of kind, and after each shard's rows every block of queries
    (kind 9). Blocks reach the shards as rows of a shuffle; a block of a shard number that no shard has stands alone."""
    last = shards.agg(F.max(F.expr(f"shard div {SHARDS_PER_TASK}")).alias("task"), F.max(F.col("shard") % SHARDS_PER_TASK).alias("n")).first()
    names = f"flatten(transform(sequence(0L, {last['task'] or 0}L), t -> transform(sequence(0L, {last['n'] or 0}L), n -> t * {SHARDS_PER_TASK} + n)))"
    asked = blocks.withColumn("shard", F.explode(F.expr(names))).withColumn("kind", F.lit(9))
    return rows.unionByName(asked, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "kind")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    """One row after another."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}


def array_of(value: pa.Scalar, kind: type) -> np.ndarray:
    """The numbers of a binary value, without a copy."""
    return np.frombuffer(value.as_buffer(), kind)


def extended(df: DataFrame, keep: list[str], ddl: str) -> StructType:
    """The schema of the ``keep`` columns and further fields."""
    return StructType(df.select(*keep).schema.fields + StructType.fromDDL(ddl).fields)


def carried(docs: DataFrame) -> tuple[DataFrame, list[str], list[Column]]:
    """``docs`` as ``text`` and all columns under names that clash with none; those names; and the columns as they were."""
    names = [f"_kept_{i}" for i in range(len(docs.columns))]
    inner = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)), F.col("text"))
    return inner, names, [F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)]


def utf8(text: str | Column) -> Column:
    """Text as UTF-8 bytes, null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES, rows: int = 1 << 31) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of the binary or string ``column`` and ``rows`` rows at most, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > limit or i - start == rows:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)
