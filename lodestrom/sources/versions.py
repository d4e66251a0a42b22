"""Numbered, immutable documents: the atomic pointer of stores, manifests and indexes.

A new state is a new file, created only if no file of that name exists; nothing is renamed or replaced. Readers take the
highest number whose text is whole, so a writer that dies in the middle leaves the state before it in force.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Versions:
    """The documents of one folder, on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 3):
        self.spark, self.folder, self.keep = spark, folder, keep
        self._fs = spark._jvm.org.apache.hadoop.fs

    def _at(self, path: str) -> tuple[Any, Any]:
        p = self._fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        p, fs = self._at(self.folder)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted((int(n[2:-5]) for n in names if n.startswith("_v") and n.endswith(".json")), reverse=True)

    def _name(self, number: int) -> str:
        return f"{self.folder}/_v{number:012}.json"

    def latest(self) -> dict[str, Any] | None:
        """The current document, or None."""
        for n in self._numbers():
            p, fs = self._at(self._name(n))
            source = fs.open(p)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
            source.close()
            try:
                return json.loads(text)
            except ValueError:
                continue  # its writer died
        return None

    def next_number(self) -> int:
        return (self._numbers() or [0])[0] + 1

    def publish(self, document: dict[str, Any], number: int | None = None) -> int:
        """Make ``document`` the current one; fails if another writer took the number."""
        number = number or self.next_number()
        p, fs = self._at(self._name(number))
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(document, default=str).encode()))
        out.close()
        for old in self._numbers()[self.keep :]:
            target, _ = self._at(self._name(old))
            fs.delete(target, False)
        return number
