"""Readers and the dataset sink (survey rows A1-A6, A8).

Paths are plain Hadoop-FS URIs (``hdfs://``, ``s3a://``, ``gs://``, local), so an object store works through the
connector configured on the cluster; nothing here is hard-wired to one.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refnet.schema import FOCAL_EDGE_SCHEMA, RAW_LOG_SCHEMA


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    header: bool = True,
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    fmt: str = "csv",
    **options: str,
) -> DataFrame:
    """Delimited text (or any ``fmt``) with header and separator options.

    Give ``schema`` whenever it is known: inference costs an extra pass over the input before any query runs and
    guesses types (``... UTC`` text becomes a timestamp). ``infer_schema=True`` reproduces inference when wanted.
    """
    reader = spark.read.format(fmt).option("header", str(bool(header)).lower()).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    if options:
        reader = reader.options(**options)
    return reader.load(path)


def read_with_schema(spark: SparkSession, schema: StructType | str, path: str | list[str], header: bool = False) -> DataFrame:
    """Comma-separated text with an explicit schema (no inference pass)."""
    return read_delimited(spark, path, sep=",", header=header, schema=schema)


def read_pipe_delimited(spark: SparkSession, path: str | list[str], header: bool = True, schema=None) -> DataFrame:
    """``|``-separated text with a header."""
    return read_delimited(spark, path, sep="|", header=header, schema=schema, infer_schema=schema is None)


def read_activity_log(spark: SparkSession, path: str | list[str], fmt: str = "csv", sep: str = ",", schema: StructType = RAW_LOG_SCHEMA) -> DataFrame:
    """The raw activity log, by column name (in any case and order).

    CSV is read as text by its header, so nothing is inferred; the columns of ``schema`` are cast to its types (text that
    isn't of its type is null) and come first. All other columns are kept, as text: full-row de-duplication needs them. A
    missing column is an error, and so are files whose headers differ. Columnar formats keep their own types.
    """
    if fmt == "csv":
        raw = spark.read.option("header", "true").option("sep", sep).option("enforceSchema", "false").csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    have = {c.lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"the log has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    known = {f.name.lower() for f in schema.fields}
    cast = (lambda f: F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType)) if fmt == "csv" else (lambda f: F.col(f"`{have[f.name.lower()]}`"))
    return raw.select(*(cast(f).alias(f.name) for f in schema.fields), *(F.col(f"`{c}`") for c in raw.columns if c.lower() not in known))


def file_headers(spark: SparkSession, path: str | list[str], suffix: str = "") -> dict[str, list[str]]:
    """The files under ``path`` by their first line. Only that line of each file is read, on the driver as Spark does for a
    header, several files at a time. Empty files and names that start with ``_`` or ``.`` are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = []
    for one in [path] if isinstance(path, str) else path:
        root = jvm.org.apache.hadoop.fs.Path(one)
        fs = root.getFileSystem(conf)
        for status in fs.globStatus(root) or []:
            listed = fs.listFiles(status.getPath(), True)
            while listed.hasNext():
                found = listed.next()
                if found.getLen() and not found.getPath().getName().startswith(("_", ".")) and found.getPath().getName().endswith(suffix):
                    files.append((fs, found.getPath()))

    def first(file) -> str:
        fs, at = file
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(at), "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    headers: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for (_, at), line in zip(files, pool.map(first, files), strict=True):
            headers.setdefault(line, []).append(at.toString())
    return headers


def _columns(header: str, sep: str) -> list[str]:
    """The names of a header line; a name that is empty or comes again gets its number."""
    names, seen = [], set()
    for n, name in enumerate(next(csv.reader([header], delimiter=sep), [])):
        name = name.strip() or f"_c{n}"
        names.append(f"{name}_{n}" if name.lower() in seen else name)
        seen.add(names[-1].lower())
    return names


def read_drifting_log(spark: SparkSession, path: str | list[str], sep: str = ",", schema: StructType = RAW_LOG_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """The raw activity log from CSV files whose headers differ, and what could not be read.

    Files are read by their own headers, those of one header together. The log has the columns of ``schema`` with its types,
    then all other columns of any file, as text (null where a file hasn't got them). The quarantine, (file, reason,
    record), has the rows of a wrong number of fields (``fields``), those with a text that isn't of its column's type (the
    column's name), and all rows of a file that lacks a column (``no `` and its name). So every row is in one of the two. A time that
    doesn't parse is no broken row: ``created_at`` is text here.
    """
    logs, quarantines = [], []
    extra: dict[str, str] = {}
    for header, files in file_headers(spark, path).items():
        names = _columns(header, sep)
        lower = {n.lower(): n for n in names}
        rows_schema = StructType([StructField(n, StringType()) for n in names] + [StructField("_corrupt", StringType())])
        reader = spark.read.schema(rows_schema).option("header", "true").option("sep", sep).option("enforceSchema", "true")
        raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", "false").csv(files)
        raw = raw.withColumn("_file", F.col("_metadata.file_path"))
        own = lambda f: F.col(f"`{lower[f.name.lower()]}`")  # noqa: B023, E731
        missing = [f.name for f in schema.fields if f.name.lower() not in lower]
        reason = F.when(F.col("_corrupt").isNotNull(), "fields")
        if missing:
            reason = F.lit(f"no {missing[0]}")
        else:
            for f in schema.fields:
                reason = reason.when(own(f).isNotNull() & own(f).try_cast(f.dataType).isNull(), f.name)
        judged = raw.withColumn("_reason", reason)
        whole = F.to_csv(F.struct(*(F.col(f"`{n}`") for n in names)), {"sep": sep})
        quarantines.append(judged.filter("_reason is not null").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.coalesce("_corrupt", whole).alias("record")))
        if not missing:
            known = {f.name.lower() for f in schema.fields}
            others = [n for n in names if n.lower() not in known]
            extra |= {n.lower(): extra.get(n.lower(), n) for n in others}
            logs.append(judged.filter("_reason is null").select(*(own(f).try_cast(f.dataType).alias(f.name) for f in schema.fields), *(F.col(f"`{n}`").alias(extra[n.lower()]) for n in others)))
    log = spark.createDataFrame([], schema)
    for part in logs:
        log = log.unionByName(part, allowMissingColumns=True)
    quarantine = spark.createDataFrame([], "file string, reason string, record string")
    for part in quarantines:
        quarantine = quarantine.unionByName(part)
    return log, quarantine


def read_edges(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = FOCAL_EDGE_SCHEMA) -> DataFrame:
    """Re-read an edge set written by :func:`write_dataset` (the stage hand-off), with its declared types."""
    if fmt == "csv":
        return read_delimited(spark, path, schema=schema)
    return spark.read.format(fmt).schema(schema).load(path)


def write_dataset(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    few_files: bool = False,
    records_per_file: int | None = None,
    partition_by: list[str] | None = None,
    header: bool = True,
    sep: str = ",",
) -> None:
    """Write ``df``; CSV always carries a header.

    ``few_files`` lets Spark rebalance the rows to files of about its advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a small result becomes one file, a large one as many as its size
    asks for, each written by a task of its own; no stage before it runs in fewer tasks. ``records_per_file`` bounds the
    rows of a file.
    """
    if few_files:
        df = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", str(bool(header)).lower()).option("sep", sep)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
