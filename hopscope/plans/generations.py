"""A traversal's rounds kept as files that any later session can take up.

A log is a folder with one committed record per generation, and the layers the
records name:

    sources/             the sources, one column
    layers/<name>/       (source, vertex, dist), ids as strings
    sums/<name>/         (source, lsp, rows) of a layer, where sources are many
    generation-000007.json

A round adds one layer, the rows that it reached, and then one record, written
under another name and renamed, so a generation is whole or not there at all.
Layers are merged when more than ``MAX_LAYERS`` have gathered: the newest ones,
as far back as those of at most twice their rows (:func:`tail_to_merge`), so a
row is written again at most as often as the state doubles. The last two records
are kept; layers and sums that neither names are deleted, those of a round
that broke off too.

A record holds each layer's rows and, up to ``LISTED`` sources, its largest
distance per source, so a summary reads records alone
(:func:`stored_longest_paths`).
"""

from __future__ import annotations

import functools
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.plans.files import Folder

MAX_LAYERS = 8
ROWS_PER_FILE = 2_000_000
#: Sources whose figures are written into the record itself.
LISTED = 1000
KEPT_RECORDS = 2
STATE = "source string, vertex string, dist int"
SUMS = "source string, lsp int, rows long"


def tail_to_merge(rows: list[int], most: int) -> int:
    """From which layer on the newest ones are merged; ``len(rows)`` for none.

    Only if there are more than ``most``. A layer joins the merge while it has at
    most twice the rows of all newer ones; a larger one stays as it is, so each
    time a row is written again its layer has grown by half at least.
    """
    if len(rows) <= most:
        return len(rows)
    at, total = len(rows) - 1, rows[-1]
    while at and (rows[at - 1] <= 2 * total or at == len(rows) - 1):
        at -= 1
        total += rows[at]
    return at


@dataclass
class Generation:
    """The last whole generation of a log."""

    spark: SparkSession
    path: str
    record: dict

    @property
    def stats(self) -> list[tuple[int, int]]:
        return [tuple(x) for x in self.record["stats"]]

    @property
    def rounds(self) -> int:
        return len(self.record["stats"])

    @property
    def converged(self) -> bool:
        return self.record["converged"]

    def state(self) -> DataFrame:
        """(source, vertex, dist) of all layers; several rows of a pair only in a warm start."""
        return self.spark.read.schema(STATE).parquet(*[f"{self.path}/layers/{x['name']}" for x in self.record["layers"]])

    def sources(self) -> DataFrame | list[str]:
        if self.record["sources"] is not None:
            return self.record["sources"]
        return self.spark.read.schema("source string").parquet(f"{self.path}/sources")


class GenerationLog:
    """The writing side; one traversal writes to a log."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = Folder(spark, path)
        self.record: dict | None = None
        self.number = -1
        self.rows_rewritten = 0
        if numbers := _numbers(self.folder):
            self.number = numbers[-1]
            self.record = self.folder.read_json(_name(self.number))

    def begin(self, sources: DataFrame, values: list[str] | None, **told) -> None:
        """Start anew; what an earlier traversal left at the path goes."""
        for name in self.folder.names():
            self.folder.delete(name)
        listed = values if values is not None and len(values) <= LISTED else None
        sources.select("source").write.mode("overwrite").parquet(self.folder.uri("sources"))
        self.number = -1
        self.record = {"layers": [], "stats": [], "converged": False, "sources": listed, **told}

    def append(self, reached: DataFrame | None, rows: int, stats: list[tuple[int, int]], **told) -> None:
        """Commit a generation: the rows (ids as strings) that a round reached, if any."""
        layers = list(self.record["layers"])
        if reached is not None and rows:
            layers.append(self._write(reached, rows))
        at = tail_to_merge([x["rows"] for x in layers], MAX_LAYERS)
        if at < len(layers):
            layers[at:] = [self._merged(layers[at:])]
        self.record = {**self.record, "layers": layers, "stats": [list(x) for x in stats], **told}
        self.number += 1
        self.folder.commit_json(_name(self.number), self.record)
        self._drop_superseded()

    def _files(self, rows: int) -> int:
        return max(1, math.ceil(rows / ROWS_PER_FILE))

    def _write(self, frame: DataFrame, rows: int) -> dict:
        name = uuid.uuid4().hex
        frame.select("source", "vertex", "dist").coalesce(self._files(rows)).write.parquet(self.folder.uri(f"layers/{name}"))
        sums = frame.groupBy("source").agg(F.max("dist").alias("lsp"), F.count("*").alias("rows"))
        if self.record["sources"] is not None:
            return {"name": name, "rows": rows, "lsp": {r["source"]: r["lsp"] for r in sums.collect()}}
        sums.write.parquet(self.folder.uri(f"sums/{name}"))
        return {"name": name, "rows": rows, "lsp": None}

    def _merged(self, layers: list[dict]) -> dict:
        name, rows = uuid.uuid4().hex, sum(x["rows"] for x in layers)
        self.rows_rewritten += rows
        frame = self.spark.read.schema(STATE).parquet(*[self.folder.uri(f"layers/{x['name']}") for x in layers])
        frame.coalesce(self._files(rows)).write.parquet(self.folder.uri(f"layers/{name}"))
        if any(x["lsp"] is None for x in layers):
            sums = self.spark.read.schema(SUMS).parquet(*[self.folder.uri(f"sums/{x['name']}") for x in layers])
            sums = sums.groupBy("source").agg(F.max("lsp").alias("lsp"), F.sum("rows").alias("rows"))
            sums.write.parquet(self.folder.uri(f"sums/{name}"))
            return {"name": name, "rows": rows, "lsp": None}
        lsp: dict[str, int] = {}
        for layer in layers:
            for source, far in layer["lsp"].items():
                lsp[source] = max(far, lsp.get(source, far))
        return {"name": name, "rows": rows, "lsp": lsp}

    def _drop_superseded(self) -> None:
        numbers = _numbers(self.folder)
        kept = numbers[-KEPT_RECORDS:]
        named = {x["name"] for n in kept for x in (self.record if n == self.number else self.folder.read_json(_name(n)))["layers"]}
        for n in numbers[:-KEPT_RECORDS]:
            self.folder.delete(_name(n))
        for part in ("layers", "sums"):
            for name in Folder(self.spark, self.folder.uri(part)).names():
                if name not in named:
                    self.folder.delete(f"{part}/{name}")


def _name(number: int) -> str:
    return f"generation-{number:06d}.json"


def _numbers(folder: Folder) -> list[int]:
    return sorted(int(x[len("generation-") : -len(".json")]) for x in folder.names() if x.startswith("generation-") and x.endswith(".json"))


def open_generation(spark: SparkSession, path: str) -> Generation:
    """The last whole generation of the log at ``path``."""
    folder = Folder(spark, path)
    numbers = _numbers(folder)
    if not numbers:
        raise FileNotFoundError(f"no whole generation at {path}")
    return Generation(spark, folder.path, folder.read_json(_name(numbers[-1])))


def stored_longest_paths(spark: SparkSession, path: str) -> DataFrame:
    """(source, lsp) of the stored state: from the record alone, or for many
    sources from the layers' sums; no layer is opened."""
    made = open_generation(spark, path)
    layers = made.record["layers"]
    frames = []
    listed = [(s, far) for x in layers if x["lsp"] is not None for s, far in x["lsp"].items()]
    if listed or not layers:
        frames.append(spark.createDataFrame(listed, "source string, lsp int"))
    if summed := [f"{path.rstrip('/')}/sums/{x['name']}" for x in layers if x["lsp"] is None]:
        frames.append(spark.read.schema(SUMS).parquet(*summed).select("source", "lsp"))
    return functools.reduce(DataFrame.unionByName, frames).groupBy("source").agg(F.max("lsp").cast("int").alias("lsp"))
