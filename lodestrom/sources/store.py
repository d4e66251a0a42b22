"""Versioned Parquet tables: overwrite and upsert without reading and writing one path, and without a lake format.

A table is ``root/name/v=<n>/`` plus numbered pointer documents (:mod:`lodestrom.sources.versions`), of which the highest names
the current version with its row count and the last batch applied. A write makes version n+1 and then adds a pointer, which
is one creation of a new file: readers see the old or the new version, never a mixture and never nothing, also where a file
system cannot rename over an existing file, and also after a crash in between. Paths go through Hadoop's file system, so any
storage that Spark writes to will do.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom.sources.versions import Versions


class Store:
    """Tables under one root."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, path: str) -> tuple[Any, Any]:
        p = self._hadoop.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write_text(self, path: str, text: str) -> None:
        """A report for people; what later runs read back is kept by ``versions``."""
        target, fs = self._path(path)
        out = fs.create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    def versions(self, name: str) -> Versions:
        """Numbered documents beside the tables, such as manifests."""
        return Versions(self.spark, f"{self.root}/{name}")

    def pointer(self, table: str) -> dict[str, Any] | None:
        return self.versions(f"{table}/_pointers").latest()

    def exists(self, table: str) -> bool:
        """Whether the table's current version can be read: its pointer and its files are there."""
        now = self.pointer(table)
        if now is None:
            return False
        p, fs = self._path(self.location(table))
        return fs.exists(p) and any(s.getPath().getName().startswith(("part-", "_SUCCESS")) or s.isDirectory() for s in fs.listStatus(p))

    def location(self, table: str) -> str:
        """The folder of the current version."""
        return f"{self.root}/{table}/v={self.pointer(table)['version']}"

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version; an empty frame of ``schema`` if there is none."""
        now = self.pointer(table)
        if now is None:
            if schema is None:
                raise FileNotFoundError(f"no table {table} under {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(T.StructType.fromJson(now["schema"]))
        return reader.parquet(f"{self.root}/{table}/v={now['version']}")

    def overwrite(self, df: DataFrame, table: str, files: int | None = None, partition_by: list[str] | None = None, batch_id: int | None = None, **metrics: Any) -> dict[str, Any]:
        """Write the next version and return its pointer with the row count (and ``metrics``, aggregate columns) observed
        while writing, so that nothing is scanned twice. A batch at or before the last one applied is skipped."""
        now = self.pointer(table) or {"version": 0, "batch_id": -1}
        if batch_id is not None and batch_id <= now["batch_id"]:
            return now
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items()))
        if files:
            out = out.coalesce(files)
        pointers = self.versions(f"{table}/_pointers")
        version = pointers.next_number()
        writer = out.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{table}/v={version}")
        pointer = {"version": version, "batch_id": now["batch_id"] if batch_id is None else batch_id, "schema": df.schema.jsonValue()} | seen.get
        pointers.publish(pointer, version)
        for old in range(max(1, version - self.keep - 1), version - self.keep + 1):
            p, fs = self._path(f"{self.root}/{table}/v={old}")
            fs.delete(p, True)
        return pointer
