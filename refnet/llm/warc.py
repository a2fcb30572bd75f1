r"""WARC archives: write, read, and resolve revisits by payload digest.

``write_archive`` writes one record per row as Spark text files whose lines end in the blank lines that end a WARC
record, so writing is distributed, committed and repeatable like any Spark output; files are gzip streams of at most
``records_per_file`` records, or of one long record, so their bytes are bounded. ``read_archive`` parses them record by record through Content-Length, so payloads may hold
anything, and checks each payload against its digest.

``deduplicate`` reads an archive twice: headers alone are shuffled by payload digest, after partial aggregation, to find
each payload's original (smallest id), and are joined to the originals. The decisions on the records of a file, at most
``records_per_file``, are then joined to the file, still compressed, whose records are written with fresh headers as
responses, or as revisits without payload that name the original's record. Copies of one payload never meet in one task.

Defined results: null html is an empty payload; a null url has no WARC-Target-URI; control characters in urls are
percent-encoded; null page ids sort last and have no Page-Id; among rows of the same smallest page_id one is the
response and the others revisit it; other columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refnet.llm.common import stored, utf8, workspace
from refnet.plans.skew import balanced_join

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
LARGE = 256 << 10  # bytes of a record with a file of its own
FIELDS = "type string, record_id string, page_id long, target_uri string, payload_digest string, payload_bytes long, refers_to string"


def base32(hex40: Column) -> Column:
    """A hex SHA-1 in upper-case base32: each 5 hex digits are 4 symbols."""
    parts = [F.lpad(F.conv(F.substring(hex40, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _clean(url: Column) -> Column:
    for c in ("\r", "\n", "\t", "\0", "\x0b", "\x0c"):
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def records(pages: DataFrame) -> DataFrame:
    """A response record for each row of (page_id, url, html), with a record id of its own."""
    body = utf8("html")
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), _clean(F.col("url").cast("string")).alias("target_uri"), body.alias("payload"), F.monotonically_increasing_id().alias("row"))
    own = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("target_uri"), F.col("row").cast("string")).cast("binary"))
    uuid = F.concat_ws("-", *(F.substring(own, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return page.select(
        F.lit("response").alias("type"),
        F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")).alias("record_id"),
        "page_id",
        "target_uri",
        base32(F.sha1("payload")).alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to"),
        "payload",
    )


def write_archive(rows: DataFrame, path: str, records_per_file: int = 1000, large: int = LARGE) -> None:
    """Rows of (type, record_id, page_id, target_uri, payload_digest, refers_to, payload); revisits leave the payload out.

    A file has ``records_per_file`` records of ``large`` bytes at most; a longer one has a folder and file of its own. So the
    bytes of a file are bounded, and a reader may hold one.
    """
    is_response = F.col("type") == "response"
    block = F.concat(F.lit(HTTP), F.when(is_response, F.col("payload").cast("string")).otherwise(F.lit("")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.col("type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Profile", F.when(~is_response, F.lit(PROFILE))),
        _field("Page-Id", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    alone = F.pmod(F.xxhash64("record_id"), F.lit((1 << 62) - 1)) + 1
    own = rows.select(F.concat(head, block).alias("value"), F.when(F.octet_length(block) > large, alone).otherwise(0).alias("alone"))
    writer = own.write.partitionBy("alone").option("lineSep", END).option("maxRecordsPerFile", records_per_file)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(header fields, block) of each record of an archive that comes in chunks."""
    held = bytearray()

    def more() -> bool:
        for chunk in chunks:
            held.extend(chunk)
            return True
        return False

    while True:
        while (stop := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends within a record's header")
                return
        lines = held[:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        while len(held) < stop + 4 + size + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        yield head, bytes(held[stop + 4 : stop + 4 + size])
        del held[: stop + 4 + size + 4]


def _unzipped(raw: bytes) -> Iterator[bytes]:
    """The content of one or more gzip members, in chunks."""
    while raw:
        z = zlib.decompressobj(31)
        for i in range(0, len(raw), 1 << 18):
            if z.eof:
                break
            yield z.decompress(raw[i : i + (1 << 18)])
            used = i + (1 << 18) - len(z.unused_data)
        yield z.flush()
        raw = raw[used:] if z.eof else b""


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_archive(spark: SparkSession, path: str, payload: bool = True, revisits: DataFrame | None = None) -> DataFrame:
    """All records below ``path``: FIELDS, file and number in it, and ``payload`` (null for revisits) if asked for.

    ``revisits`` (file, copies: array<struct<number,refers_to>>) makes those records revisits on the way.
    """
    schema = FIELDS + ", file string, number int" + (", payload binary" if payload else "")
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for file, raw, copies in zip(files.column("path"), files.column("content"), files.column("copies"), strict=True):
                refers = {c["number"]: c["refers_to"] for c in copies.as_py() or ()}
                for number, (head, block) in enumerate(parse(_unzipped(raw.as_py()))):
                    body = block[block.index(b"\r\n\r\n") + 4 :]
                    kind, to = head["WARC-Type"], head.get("WARC-Refers-To")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"{head['WARC-Record-ID']}: the payload isn't that of its digest")
                    if number in refers:
                        kind, to = "revisit", refers[number]
                    page, response = head.get("Page-Id"), kind == "response"
                    row = (kind, head["WARC-Record-ID"], None if page is None else int(page), head.get("WARC-Target-URI"), digest, len(body) if response else None, to, file.as_py(), number)
                    rows.append((*row, body if response else None) if payload else row)
                    size += 300 + len(body) * (payload and response)
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    copies = "array<struct<number:int,refers_to:string>>"
    files = _files(spark, path)
    if revisits is None:
        files = files.withColumn("copies", F.lit(None).cast(copies))
    else:
        files = files.join(revisits, F.col("path") == F.col("file"), "left").select("path", "content", F.col("copies").cast(copies).alias("copies"))
    return files.mapInArrow(read, schema)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(file, number, refers_to) of the revisits: of records with equal payloads of at least ``min_bytes`` that with the smallest id is
    the response, the others refer to its record."""
    order = F.struct(F.col("page_id").isNull().alias("last"), F.col("page_id"), F.col("record_id"))
    firsts = headers.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(F.min(order).alias("first"))
    # As a table of its own, so that the join below is one of two plain sides and a payload of many copies can be split.
    firsts = stored(firsts.select(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes"), F.col("first.record_id").alias("original")), "originals")
    found = headers.join(firsts, (headers["payload_digest"] == firsts["digest"]) & (headers["payload_bytes"] == firsts["bytes"]), "left")
    copy = F.col("original").isNotNull() & (F.col("original") != F.col("record_id"))
    return found.filter(copy).select("file", "number", F.col("original").alias("refers_to"))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Write the archive at ``source``, whose records are all responses, to ``target`` with copies as revisits."""
    copies = resolve(read_archive(spark, source, payload=False), min_bytes)
    by_file = copies.groupBy("file").agg(F.collect_list(F.struct("number", "refers_to")).alias("copies"))  # a file's records at most
    write_archive(read_archive(spark, source, revisits=by_file), target)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record: a revisit has its original's size and page."""
    rows = stored(read_archive(spark, path, payload=False), "headers")
    responses = rows.filter(F.col("type") != "revisit")
    originals = rows.filter(F.col("type") == "response").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"))
    # Revisits alone are joined, those of a payload of very many copies in several tasks.
    revisits = rows.filter(F.col("type") == "revisit").select("page_id", "payload_digest", "refers_to", "file", "number")
    found = balanced_join(revisits, originals, ["refers_to"], "left", left_salt=["file", "number"])
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    one = responses.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return one.unionByName(found.select("page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", F.lit("revisit").alias("record_type"), F.col("_page").alias("refers_to"))).select(*names)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, deduplicate and read back ``pages``; both archives lie in the shared folder."""
    spark = pages.sparkSession
    first, second = workspace(spark, "archive"), workspace(spark, "archive-deduplicated")
    write_archive(records(pages), first)
    deduplicate(spark, first, second, min_bytes)
    return read_resolved(spark, second)
