"""Small files on any filesystem that Spark reaches, through its Hadoop client.

Used by the driver for commit records of a few kilobytes; data goes through
``spark.read`` and ``df.write``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from hopscope.plans.session import checkpoint_dir


class Folder:
    """A folder, given by its URI."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._new = jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def uri(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self) -> list[str]:
        at = self._new(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._new(self.uri(name)))

    def read_json(self, name: str):
        lines = self.spark.read.text(self.uri(name), wholetext=True).first()
        return json.loads(lines[0])

    def commit_json(self, name: str, value) -> None:
        """Write the record under another name, then rename it: readers see all of it or nothing."""
        staged = self._new(self.uri(f".{uuid.uuid4().hex}.tmp"))
        out = self._fs.create(staged)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        if not self._fs.rename(staged, self._new(self.uri(name))):
            self._fs.delete(staged, False)
            raise FileExistsError(f"{self.uri(name)} is there already")

    def delete(self, name: str) -> None:
        self._fs.delete(self._new(self.uri(name)), True)

    def size(self, name: str) -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._new(self.uri(name))).getLength()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path in the session's checkpoint folder, which all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
