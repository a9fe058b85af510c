"""Toxicity by a counterfactually regularised classifier.

A text's features are the hashed words it holds, and their first four, five and
six letters, each once however often it occurs. A logistic regression is fitted
on labelled texts. For each labelled sentence that names a group, a copy is made
with each identity term swapped for the next of its kind, and the change of
score is penalised, so that naming a group neutrally doesn't raise the score.
The kinds of terms are a parameter; ``Model.n_pairs`` tells how many sentence
pairs the penalty saw (equal changes within a text count once).

The strength of the L1 penalty is chosen from ``STRENGTHS`` by the log loss over
``FOLDS`` folds of at most ``FOLD_ROWS`` of the fitted rows, each fit a Spark
task; rows with equal features share a fold. Held-out rows play no part in it.

The fit uses at most ``FIT_ROWS`` labelled rows, half of them toxic if there
are so many, chosen by a hash of their ids; the intercept is set back to the
share of all labelled rows. Only their feature numbers go to the driver.
Scoring covers whole texts of all rows, in Arrow batches.

Defined results: a null text counts as empty; a text without words scores by
the intercept alone; repeated rows score each; a label row that repeats counts
once per document row and null labels are ignored; without labels of both kinds
the score is the smoothed share of toxic labels; an empty table gives no rows;
other columns pass through and are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopscope.llm.common import lean

BITS = 18
FIT_ROWS = 8_000
#: Fewest fitted texts with a feature.
MIN_TEXTS = 4
ROUNDS = 120
RATE = 0.5
#: Strength of the L1 penalty, times one by the root of the number of fitted rows:
#: without a choice, and what is chosen from.
L1 = 0.04
STRENGTHS = (0.01, 0.02, 0.04, 0.08, 0.16)
FOLDS = 3
FOLD_ROWS = 3_000
#: Feature numbers, of whole texts, that a step of a fit takes in at once.
PIECE = 1 << 18
#: Weight of the squared change of score between a text and its swapped copy.
SWAP_PENALTY = 1.0

#: Terms that name groups, by kind; a term is swapped within its kind.
IDENTITY = (
    ("women", "men", "girls", "boys", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "sikhs"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "african", "latino", "arab", "indigenous"),
    ("immigrants", "refugees", "migrants", "foreigners", "citizens"),
    ("american", "french", "german", "spanish", "mexican", "chinese", "russian", "turkish"),
    ("blind", "deaf", "disabled", "autistic"),
    ("femmes", "hommes"), ("musulmans", "juifs", "chrétiens"), ("frauen", "männer"), ("muslime", "juden", "christen"),
    ("mujeres", "hombres"), ("musulmanes", "judíos", "cristianos"),
)


def swaps(kinds: Sequence[Sequence[str]]) -> dict[str, str]:
    """Each term's successor within its kind."""
    return {t: kind[(i + 1) % len(kind)] for kind in kinds for i, t in enumerate(kind)}


SWAP = swaps(IDENTITY)

MARKS = re.compile(r"[^\w]+")
SENTENCES = re.compile(r"(?<=[.!?\n])")


class Features:
    """Feature numbers of texts, with what it has met of words kept at hand."""

    KEPT = 300_000

    def __init__(self):
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, raw: bytes) -> tuple[int, ...]:
        out: list[int] = []
        for w in MARKS.split(raw.decode("utf-8", "replace")):
            if w:
                names = ["w" + w, *(f"{n}{w[:n]}" for n in (4, 5, 6) if len(w) >= n)]
                out += [zlib.crc32(x.encode("utf-8", "replace")) & ((1 << BITS) - 1) for x in names]
        return tuple(out)

    def __call__(self, text: str | None) -> set[int]:
        out: set[int] = set()
        if len(self.known) > self.KEPT:
            self.known.clear()
        for raw in set((text or "").lower().encode("utf-8", "surrogatepass").split()):
            got = self.known.get(raw)
            if got is None:
                got = self.known[raw] = self.of_word(raw)
            out.update(got)
        return out


def swapped(text: str | None, swap: dict[str, str] = SWAP) -> str | None:
    """The text with its identity terms swapped; None if it names none."""
    found = False

    def one(m: re.Match) -> str:
        nonlocal found
        other = swap.get(m[0].lower())
        found |= other is not None
        return m[0] if other is None else other

    out = re.sub(r"\w+", one, text or "")
    return out if found else None


#: Features that a swap takes from a sentence, and those that it adds.
Pair = tuple[np.ndarray, np.ndarray]


def sentence_pairs(text: str | None, of: Features, swap: dict[str, str] = SWAP) -> list[Pair]:
    """What the swap changes in each sentence that names a group, each change once."""
    out = {}
    for sentence in SENTENCES.split(text or ""):
        copy = swapped(sentence, swap)
        if copy is not None:
            before, after = of(sentence), of(copy)
            out[tuple(sorted(before - after)), tuple(sorted(after - before))] = None
    return [(np.array(lost, np.int64), np.array(gained, np.int64)) for lost, gained in out if lost or gained]


def pieces(parts: Sequence[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of parts with ``PIECE`` entries or one part."""
    ends = np.cumsum([len(p) for p in parts])
    lo = 0
    while lo < len(parts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, "right")))
        yield lo, hi
        lo = hi


class Matrix:
    """The columns of each part's features, four bytes each; sums run over a few
    parts at a time, in the order of the entries."""

    def __init__(self, parts: Sequence[np.ndarray], place: np.ndarray):
        self.held: list[tuple[int, np.ndarray, np.ndarray]] = []
        for lo, hi in pieces(parts):
            row = np.repeat(np.arange(hi - lo), [len(p) for p in parts[lo:hi]])
            col = place[np.concatenate(parts[lo:hi])]
            self.held.append((lo, np.bincount(row[col >= 0], minlength=hi - lo), col[col >= 0]))
        self.rows = len(parts)

    def by_row(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.rows)
        for lo, sizes, col in self.held:
            out[lo : lo + len(sizes)] = np.bincount(np.repeat(np.arange(len(sizes)), sizes), w[col], len(sizes))
        return out

    def by_column(self, v: np.ndarray, columns: int) -> np.ndarray:
        out = np.zeros(columns)
        for lo, sizes, col in self.held:
            np.add.at(out, col.astype(np.intp), np.repeat(v[lo : lo + len(sizes)], sizes))
        return out


def fit(
    rows: list[np.ndarray],
    copies: list[np.ndarray | None],
    labels: np.ndarray,
    share: float,
    penalty: float = SWAP_PENALTY,
    strength: float = L1,
    pairs: Sequence[Pair] = (),
) -> tuple[np.ndarray, float]:
    """Weights and intercept. ``rows``: each text's features; ``copies``: those
    of a swapped copy of the whole text, or None; ``pairs``: the changes that
    swaps make to sentences; ``share``: of label 1 among all labelled rows."""
    weights = np.zeros(1 << BITS, np.float32)
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if not len(labels) or labels.min() == labels.max():
        return weights, prior
    held = np.zeros(1 << BITS, np.int64)
    for lo, hi in pieces(rows):
        held += np.bincount(np.concatenate(rows[lo:hi]), minlength=1 << BITS)
    used = np.flatnonzero(held >= MIN_TEXTS)
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))

    texts = Matrix(rows, place)
    # The difference of two feature sets is all that the penalty sees.
    pairs = [*pairs, *((np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in zip(rows, copies, strict=True) if b is not None)]
    plus, minus = Matrix([p for p, _ in pairs], place), Matrix([m for _, m in pairs], place)
    n, w, b = len(labels), np.zeros(len(used)), float(np.log(labels.mean() / (1 - labels.mean())))
    sparse = strength / np.sqrt(n)
    seen, seen_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = texts.by_row(w) + b
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        grad = texts.by_column(miss, len(used)) / n
        if pairs:
            gap = plus.by_row(w) - minus.by_row(w)
            grad += 2 * penalty / n * (plus.by_column(gap, len(used)) - minus.by_column(gap, len(used)))
        seen += grad * grad
        step = RATE / np.sqrt(seen)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
        g = float(miss.mean())
        seen_b += g * g
        b -= RATE / np.sqrt(seen_b) * g
    weights[used] = w
    return weights, b + prior - float(np.log(labels.mean() / (1 - labels.mean())))


def fold_loss(rows: list[np.ndarray], pairs: list[list[Pair]], labels: np.ndarray, folds: np.ndarray, fold: int, strength: float, penalty: float) -> float:
    """Log loss over one fold's rows of a model that the other folds fit."""
    inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
    if not len(inside) or not len(outside):
        return 0.0
    y, known = labels[outside], labels[inside]
    share = (known.sum() + 0.5) / (len(known) + 1)
    weights, b = fit([rows[i] for i in inside], [None] * len(inside), known, share, penalty, strength, [p for i in inside for p in pairs[i]])
    z = np.array([weights[rows[i]].sum(dtype=np.float64) for i in outside]) + b
    return float(np.logaddexp(0, np.where(y == 1, -z, z)).sum())


def choose(spark: SparkSession, rows: list[np.ndarray], pairs: list[list[Pair]], labels: np.ndarray, penalty: float, strengths: Sequence[float] = STRENGTHS) -> float:
    """The strength with the least log loss over the folds, of equals the largest;
    ``L1`` if there are fewer rows of a label than folds."""
    if min((labels == 0).sum(), (labels == 1).sum()) < FOLDS:
        return L1
    mark = np.array([zlib.crc32(r.tobytes()) for r in rows])
    some = np.argsort(mark, kind="stable")[:FOLD_ROWS]
    shared = spark.sparkContext.broadcast(([rows[i].astype(np.int32) for i in some], [pairs[i] for i in some], labels[some], mark[some] % FOLDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, k = (batch.column(i).to_pylist() for i in range(2))
            loss = [fold_loss(*shared.value, fold, strengths[i], penalty) for i, fold in zip(s, k, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(loss, pa.float64())], ["strength", "fold", "loss"])

    jobs = spark.range(0, len(strengths) * FOLDS, 1, len(strengths) * FOLDS)
    jobs = jobs.select(F.expr(f"CAST(id DIV {FOLDS} AS INT)").alias("strength"), F.expr(f"CAST(id % {FOLDS} AS INT)").alias("fold"))
    told = sorted(tuple(r) for r in jobs.mapInArrow(lean(run), "strength int, fold int, loss double").collect())
    shared.destroy()
    sums = [sum(loss for i, _, loss in told if i == s) for s in range(len(strengths))]
    return strengths[min(range(len(strengths)), key=lambda s: (sums[s], -strengths[s]))]


def labelled(docs: DataFrame, labels: DataFrame, label: str, train: Column, fit_rows: int) -> tuple[DataFrame, float]:
    """(text, y) of at most ``fit_rows`` labelled ids, half of each label if
    there are so many, and the share of label 1 among all of them.

    The choice goes by a hash of the ids: those under a bound that lets a few more
    than are wanted through, so that few are sorted. An id with several label rows
    has label 1 if one of them has; an id with several texts gives the one whose
    hash is smallest.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).where("__id IS NOT NULL AND y IS NOT NULL")
    known = known.where(train).groupBy("__id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    place = F.shiftrightunsigned(F.xxhash64("__id"), 1) / float(1 << 63)
    mine = None
    for y in (0, 1):
        other, n = counts.get(1 - y, 0), counts.get(y, 0)
        take = max(fit_rows // 2, fit_rows - other)
        part = known.where(F.col("y") == y)
        if n > take:
            part = part.where(place < (take + 8 * take**0.5 + 20) / n).orderBy(place, "__id").limit(take)
        mine = part if mine is None else mine.unionByName(part)
    texts = docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(mine), F.col("__doc") == F.col("__id")).groupBy("__id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return rows.select("text", "y"), (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)


class Model(NamedTuple):
    weights: np.ndarray
    intercept: float
    strength: float
    n_pairs: int


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    train_rows: Column | None = None,
    fit_rows: int = FIT_ROWS,
    penalty: float = SWAP_PENALTY,
    kinds: Sequence[Sequence[str]] = IDENTITY,
) -> Model:
    """``train_rows``: a condition on ``__id``, the ids whose labels may be used;
    ``kinds``: terms in lower case that name groups, those of a kind together."""
    rows, share = labelled(docs, labels, label, F.lit(True) if train_rows is None else train_rows, fit_rows)
    swap = swaps(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            feats = [sorted(of(t)) for t in texts]
            pairs = [sentence_pairs(t, of, swap) for t in texts]
            lost, gained = (pa.array([[p[i] for p in ps] for ps in pairs], pa.list_(pa.list_(pa.int32()))) for i in range(2))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(feats, pa.list_(pa.int32())), lost, gained], ["y", "f", "lost", "gained"])

    got = rows.mapInArrow(lean(run), "y int, f array<int>, lost array<array<int>>, gained array<array<int>>").toArrow()
    y, f = got.column(0).to_pylist(), got.column(1).combine_chunks()
    lost, gained = got.column(2).to_pylist(), got.column(3).to_pylist()
    arrays = [np.asarray(x.values) for x in f]
    order = sorted(range(len(y)), key=lambda i: (y[i], arrays[i].tobytes(), lost[i]))  # Spark's order of rows is not fixed
    feats, known = [arrays[i] for i in order], np.array([y[i] for i in order], float)
    pairs = [[(np.array(a, np.int64), np.array(b, np.int64)) for a, b in zip(lost[i], gained[i], strict=True)] for i in order]
    strength = choose(docs.sparkSession, feats, pairs, known, penalty)
    every = [p for ps in pairs for p in ps]
    return Model(*fit(feats, [None] * len(feats), known, share, penalty, strength, every), strength, len(every))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The documents, all columns as they were, with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model[:2]))
    kept = [c for c in docs.columns if c != column]
    # Columns are numbered on their way, so that any names may pass. Texts are sent
    # once: they are read from their own column, unless the score takes its name.
    own = docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate([*kept, *([] if "text" in kept else ["text"])])])
    at = kept.index("text") if "text" in kept else len(kept)
    fields = T.StructType([*own.schema.fields[: len(kept)], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, (weights, b) = Features(), shared.value
        for batch in batches:
            z = [b + float(weights[np.fromiter(s, np.int64, len(s))].sum(dtype=np.float64)) for s in map(of, (x.as_py() for x in batch.column(at)))]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(p, pa.float64())], fields.names)

    return own.mapInArrow(lean(run), fields).toDF(*kept, column)
