"""Tables that the stages of a run hand on, each written once, counted while it is written, and marked when it is whole.

A :class:`Store` writes every table to a folder of its own attempt and then a marker, a small file that names the folder, the
number of rows and the schema. A table without a marker does not exist: what a killed run has left of it is never read. A
store that resumes takes the marked tables as they are and makes the others, so a run goes on after its last whole stage.
Outputs are moved to their own name when they are whole (one rename; on an object store that is a copy, and the marker
follows it). Row counts are observed on the rows that are written, at no extra job.

With ``buckets`` a table that names a column is bucketed and sorted by it, so joins and aggregations on that column don't
shuffle it again. Such tables stand in the session's catalog under the store's prefix (``drop`` takes them out; files stay).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refnet.sources.delimited import write_dataset


class Folder:
    """Small files and renames on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def read(self, name: str) -> str | None:
        if not self._files.exists(self._at(name)):
            return None
        stream = self._files.open(self._at(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        part = f"{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._at(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(part, name)

    def move(self, name: str, to: str) -> None:
        self._files.delete(self._at(to), True)
        self._files.mkdirs(self._at(to).getParent())
        if not self._files.rename(self._at(name), self._at(to)):
            raise OSError(f"cannot move {self.root}/{name} to {to}")


class Store:
    """Tables under ``root``. ``signature`` tells runs apart: a store doesn't resume what another run has left."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, resume: bool = False, signature: str = "", after: Callable[[str], None] | None = None):
        self.spark, self.root, self.buckets, self.resume, self.signature = spark, root.rstrip("/"), buckets, resume, signature
        self.after = after or (lambda name: None)
        self.counts: dict[str, int] = {}
        self.made: list[str] = []  # what this store has written itself
        self.tables: list[str] = []
        self._folder: Folder | None = None
        self._prefix = f"refnet_{uuid.uuid4().hex}"

    @property
    def folder(self) -> Folder:
        self._folder = self._folder or Folder(self.spark, self.root)
        return self._folder

    def _marked(self, name: str) -> dict | None:
        text = self.folder.read(f"_markers/{name}.json") if self.resume else None
        if text is None:
            return None
        marker = json.loads(text)
        if marker["signature"] != self.signature:
            raise ValueError(f"{self.root} has {name} of a run over another log or with other settings; resume=False starts anew")
        return marker

    def _mark(self, name: str, marker: dict) -> dict:
        self.folder.write(f"_markers/{name}.json", json.dumps(marker | {"signature": self.signature}))
        self.made.append(name)
        return marker

    def _written(self, name: str, marker: dict) -> None:
        self.counts[name] = marker["rows"]
        if name in self.made:
            self.after(name)

    def keep(self, name: str, build: Callable[[], DataFrame], by: str | None = None, counted: str | None = None) -> DataFrame:
        """The table ``name``, made by ``build`` unless it is there. ``counted`` names a column whose sum is counted
        instead of rows."""
        marker = self._marked(name) or self._made(name, build(), by if self.buckets else None, counted)
        self._written(name, marker)
        schema = StructType.fromJson(marker["schema"])
        if not marker["by"]:
            return self.spark.read.schema(schema).parquet(marker["path"])
        table = f"{self._prefix}_{name}"
        if table not in self.tables:  # of an earlier run; its bucketed files are read as they are
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({marker['by']}) SORTED BY ({marker['by']}) INTO {marker['buckets']} BUCKETS LOCATION '{marker['path']}'")
            self.tables.append(table)
        return self.spark.table(table)

    def _made(self, name: str, df: DataFrame, by: str | None, counted: str | None) -> dict:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        seen = Observation()
        rows = df.observe(seen, (F.sum(counted) if counted else F.count(F.lit(1))).alias("rows"))
        if by:
            table = f"{self._prefix}_{name}"
            rows.repartition(self.buckets, by).sortWithinPartitions(by).write.format("parquet").bucketBy(self.buckets, by).sortBy(by).option("path", path).saveAsTable(table)
            self.tables.append(table)
        else:
            rows.write.parquet(path)
        return self._mark(name, {"path": path, "rows": seen.get["rows"] or 0, "schema": df.schema.jsonValue(), "by": by, "buckets": self.buckets})

    def publish(self, name: str, build: Callable[[], DataFrame], fmt: str) -> None:
        """Writes ``name`` to ``root/name``, unless that is there and whole."""
        marker = self._marked(f"out-{name}")
        if marker is None:
            seen, attempt = Observation(), f"_attempts/{uuid.uuid4().hex}/{name}"
            write_dataset(build().observe(seen, F.count(F.lit(1)).alias("rows")), f"{self.root}/{attempt}", fmt=fmt, mode="errorifexists")
            self.folder.move(attempt, name)
            marker = self._mark(f"out-{name}", {"path": f"{self.root}/{name}", "rows": seen.get["rows"]})
        self.counts[name] = marker["rows"]
        if f"out-{name}" in self.made:
            self.after(f"out-{name}")

    def drop(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
