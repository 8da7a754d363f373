"""Versioned manifests on a shared folder: which parts of a table count, told by one small file.

A version is a JSON file named by its number. It is written under another name and renamed into place; a rename onto
a file that is there fails, so of two writers one loses and reads again. Readers take the highest version, see the parts
that it names and nothing else; parts that no version names (a failed writer's) don't count.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifest:
    def __init__(self, spark: SparkSession, folder: str):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path, self.jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self.folder = folder.rstrip("/")
        self.fs = self.path(self.folder).getFileSystem(conf)

    def latest(self) -> tuple[int, dict]:
        """(version, content); (0, {}) before the first."""
        place = self.path(self.folder)
        names = [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []
        versions = [int(n) for n in names if n.isdigit()]
        if not versions:
            return 0, {}
        stream = self.fs.open(self.path(f"{self.folder}/{max(versions):08d}"))
        try:
            return max(versions), json.loads(str(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def publish(self, version: int, content: dict) -> None:
        """Make ``content`` version ``version``; FileExistsError when that is there already."""
        target = self.path(f"{self.folder}/{version:08d}")
        written = self.path(f"{self.folder}/.{version:08d}-{uuid.uuid4().hex}")
        out = self.fs.create(written, False)
        try:
            out.write(json.dumps(content, sort_keys=True).encode())
        finally:
            out.close()
        if self.fs.exists(target) or not self.fs.rename(written, target):
            self.fs.delete(written, False)
            raise FileExistsError(str(target))
