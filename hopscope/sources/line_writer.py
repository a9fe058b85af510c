"""Adjacency lists as text, one line a vertex whatever its degree.

A Python data source with a committing writer. Rows (vertex, part, neighbors)
come to a task sorted by vertex and part; the task streams them into a file, and
the parts of a hub go one after the other into the same line, so no more than one
part is held. Files are written under ``_staged-...``; the driver's commit moves
them to their places, writes ``_SUCCESS`` and, in overwrite mode, deletes what
was there before. A job that breaks off leaves no file in the folder itself.

Files are reached through pyarrow's filesystems (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "adjacency-lines"
#: Neighbours that a task sorts and writes, hubs apart.
PER_TASK = 500_000


@dataclass
class Written(WriterCommitMessage):
    name: str
    lines: int


def _place(path: str):
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class LineWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staged = f"_staged-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        files, folder = _place(self.path)
        files.create_dir(f"{folder}/{self.staged}", recursive=True)
        name = f"part-{uuid.uuid4().hex}.txt"
        lines, open_vertex = 0, None
        with files.open_output_stream(f"{folder}/{self.staged}/{name}") as out:
            for row in rows:
                text = ",".join(row["neighbors"]).encode()
                if row["vertex"] == open_vertex:
                    out.write(b"," + text)
                    continue
                out.write((b"\n" if lines else b"") + row["vertex"].encode() + b"\t" + text)
                open_vertex, lines = row["vertex"], lines + 1
            if lines:
                out.write(b"\n")
        return Written(name, lines)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, folder = _place(self.path)
        before = [f for f in files.get_file_info(fs.FileSelector(folder)) if f.base_name != self.staged]
        if self.overwrite:
            for f in before:
                files.delete_dir(f.path) if f.type == fs.FileType.Directory else files.delete_file(f.path)
        for m in messages:
            if m is not None and m.lines:
                files.move(f"{folder}/{self.staged}/{m.name}", f"{folder}/{m.name}")
        files.delete_dir(f"{folder}/{self.staged}")
        with files.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, folder = _place(self.path)
        if files.get_file_info(f"{folder}/{self.staged}").type == fs.FileType.Directory:
            files.delete_dir(f"{folder}/{self.staged}")


class AdjacencyLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "vertex string, part int, neighbors array<string>"

    def writer(self, schema, overwrite: bool) -> LineWriter:
        return LineWriter(self.options["path"], overwrite)


def write_adjacency_lines(adjacency: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write (vertex, part, neighbors) rows as ``vertex<TAB>n1,n2,...`` lines.

    Rows are dealt by vertex, so a hub's list passes through one task, part by
    part; neighbours are in the order of parts."""
    spark = adjacency.sparkSession
    spark.dataSource.register(AdjacencyLines)
    listed = adjacency.agg(F.sum(F.size("neighbors"))).first()[0]
    rows = adjacency.select("vertex", "part", "neighbors").repartition(max(1, math.ceil((listed or 0) / PER_TASK)), "vertex").sortWithinPartitions("vertex", "part")
    rows.write.format(FORMAT).mode(mode).save(path)
