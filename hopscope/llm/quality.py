"""Quality by a logistic regression over hashed word n-grams.

A text's words and pairs of words are hashed, and so are the shapes of words
(capitals, small letters, digits and other characters, runs shortened), pairs
and triples of shapes, and whether a word repeats the one before. A feature's
value is the square root of its count, scaled to length one over the text. The
weights are learned by follow-the-regularised-leader updates, row by row, and
a text scores as the sparse dot product of its values and the weights.

The fit uses at most ``FIT_ROWS`` labelled rows, chosen by a hash of their ids;
their order is a hash too. Only their sparse rows go to the driver. Scoring
covers whole texts of all rows, in Arrow batches.

Defined results: a null text counts as empty; a text without words scores by
the intercept alone; repeated rows score each; a label row that repeats counts
once per document row and null labels are ignored; without labels the score is
0.5; an empty table gives no rows; other columns pass through and are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.llm.toxicity import labelled

BITS = 18
FIT_ROWS = 12_000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.05

RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return RUNS.sub(r"\1\1", kinds)[:12]


class Rows:
    """Sparse rows (feature numbers, values) of texts."""

    KEPT = 300_000

    def __init__(self):
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        known = self.known
        if len(known) > self.KEPT:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = zlib.crc32(w), zlib.crc32(b"\0" + shape(w.decode("utf-8", "replace")).encode("utf-8", "replace"))
        both = np.array([known[w] for w in words], np.uint64)
        w, s = both[:, 0], both[:, 1]
        mul = np.uint64(0x9E3779B97F4A7C15)
        again = np.array([11, 13], np.uint64)[(w[1:] == w[:-1]).astype(np.int64)]
        parts = [w, (w[:-1] * mul) ^ w[1:], s, (s[:-1] * mul) ^ s[1:], ((s[:-2] * mul) ^ s[1:-1]) * mul ^ s[2:], again]
        mixed = np.concatenate([(p + np.uint64(i)) * mul for i, p in enumerate(parts)]) >> np.uint64(64 - BITS)
        ids, counts = np.unique(mixed.astype(np.int64), return_counts=True)
        values = np.sqrt(counts)
        return ids, values / np.sqrt(counts.sum())


class Leader:
    """Follow the regularised leader, a learning rate for each coordinate."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.zb = self.nb = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def intercept(self) -> float:
        return -self.zb / ((BETA + self.nb**0.5) / ALPHA)

    def learn(self, ids: np.ndarray, values: np.ndarray, y: float) -> None:
        z, n = self.z[ids], self.n[ids]
        w, b = self.weights(z, n), self.intercept()
        miss = 1 / (1 + np.exp(-np.clip(w @ values + b, -30, 30))) - y
        g = miss * values
        more = np.sqrt(n + g * g)
        self.z[ids] = z + g - (more - np.sqrt(n)) / ALPHA * w
        self.n[ids] = n + g * g
        more_b = (self.nb + miss * miss) ** 0.5
        self.zb += miss - (more_b - self.nb**0.5) / ALPHA * b
        self.nb += miss * miss

    def model(self) -> tuple[np.ndarray, float]:
        return self.weights(self.z, self.n).astype(np.float32), float(self.intercept())


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: Column | None = None, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights and intercept. ``train_rows``: a condition on ``__id``, the ids
    whose labels may be used."""
    rows, share = labelled(docs, labels, label, F.lit(True) if train_rows is None else train_rows, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Rows()
        for batch in batches:
            made = [of(x.as_py()) for x in batch.column(0)]
            ids = pa.array([m[0].astype(np.int32) for m in made], pa.list_(pa.int32()))
            values = pa.array([m[1].astype(np.float32) for m in made], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), ids, values], ["y", "ids", "v"])

    got = rows.mapInArrow(run, "y int, ids array<int>, v array<float>").toArrow()
    y = got.column(0).to_pylist()
    ids, values = (got.column(i).combine_chunks() for i in (1, 2))
    every = [(np.asarray(a.values).astype(np.int64), np.asarray(v.values).astype(np.float64)) for a, v in zip(ids, values, strict=True)]
    # A mixed order that Spark's order of rows doesn't change.
    order = sorted(range(len(y)), key=lambda i: (zlib.crc32(every[i][0].tobytes()), y[i], every[i][1].tobytes()))
    leader = Leader()
    for _ in range(PASSES):
        for i in order:
            leader.learn(*every[i], float(y[i]))
    weights, b = leader.model()
    if y:  # the sample holds more of the rarer label than the rows do
        had = (sum(y) + 0.5) / (len(y) + 1)
        b += float(np.log(share / (1 - share)) - np.log(had / (1 - had)))
    return weights, b


def score(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "score") -> DataFrame:
    """The documents, all columns as they were, with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, (weights, b) = Rows(), shared.value
        for batch in batches:
            z = [float(weights[ids] @ values) + b for ids, values in (of(x.as_py()) for x in batch.column(batch.num_columns - 1))]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p, pa.float64())], [*batch.schema.names[:-1], column])

    ready = docs.select(*[c for c in docs.columns if c != column], F.col("text").alias("__scored"))
    schema = docs.select(*[c for c in docs.columns if c != column]).schema.add(column, "double")
    return ready.mapInArrow(run, schema)
