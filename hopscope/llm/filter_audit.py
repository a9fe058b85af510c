"""Audit of filters that overlap: what each order of them removes, and what each is worth.

A document's failures are a mask of filters, so a part of the corpus is a table
of counts by mask: 32 for five filters. It sets a removal game: a coalition of
filters is worth the documents that at least one of its members fails. The
Hart-Mas-Colell potential of a coalition is

    P(S) = (v(S) + sum of P(S without i) over its members i) / |S|,  P(none) = 0

worked out once for each of the 32 coalitions; the Shapley value of filter i is
P(all) - P(all without i). A step of an order goes from the coalition of the
filters before it to that with it, so every figure of every step of all 120
orders is a difference of two coalitions' worths. Potentials are kept times 120,
which makes them whole numbers, and 120 times a Shapley value is the filter's
removals summed over all orders.

Exact copies: a document fails if its text is that of a row with a smaller
doc_id, wherever that row is and whatever removes it. What a text fails
otherwise depends on the text alone, so rows are counted by (text, part, labels)
before copies meet; a text with a third of all rows costs a row for each part
and task.

Defined results: a null text counts as empty, a null part as an empty string;
a row without doc_id neither fails as a copy nor makes others fail; repeated
rows of one doc_id do not make each other fail; a doc_id with several label rows
has a label if one of them has it, a row without label none; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm.arrow_words import pieces, word_codes
from hopscope.llm.common import attach, lean

FILTERS = "ABCDE"
#: The filter that fails copies; the others depend on the text alone.
COPIES = 4
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
MARKS = b"#$%&*|"
#: Bytes of a labelled id in a broadcast, as measured: 13 MB for 102,239.
LABEL_BYTES = 128


def text_failures(texts: pa.Array) -> np.ndarray:
    """Masks of what each text fails by itself: A (bit 0) has under 50 words, B
    too few distinct ones, C too many capitals, D a mark."""
    texts = pc.fill_null(texts, "")
    codes, begin, held = word_codes(texts)
    words = np.diff(begin)
    row = np.repeat(np.arange(len(texts)), words)
    pairs = np.sort(row * max(1, len(held)) + codes)
    first = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
    distinct = np.bincount(pairs[first] // max(1, len(held)), minlength=len(texts))

    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[ord("A") : ord("Z") + 1] = 1
    kind[np.frombuffer(MARKS, np.uint8)] = 2
    told = kind[raw]

    def count(hits: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(hits)
        return np.diff(np.searchsorted(at, ends))

    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    failures = (words < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * words, 100 * count(told == 1) > MAX_UPPER_PERCENT * chars, count(told == 2) > 0)
    return sum(f.astype(np.int64) << i for i, f in enumerate(failures))


def _failing(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, key (of the text) and mask (of what the text fails by itself)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                keys = [hashlib.md5(t or b"").digest() for t in piece.column(2).cast(pa.binary()).to_pylist()]
                columns = [piece.column(0), piece.column(1), pa.array(keys, pa.binary()), pa.array(text_failures(piece.column(2)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "key", "mask"])

    slim = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    return slim.mapInArrow(lean(run), f"doc_id {dict(slim.dtypes)['doc_id']}, part string, key binary, mask long")


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: documents that fail exactly those filters."""
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = attach(_failing(docs, part), told, ["doc_id"], labels.count(), LABEL_BYTES, F.xxhash64("key", "doc_id", "part"))
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    rows = rows.select("doc_id", "part", "key", "mask", *flags)
    # Rows of one id first, so that the rows with a text's smallest id can be counted by min_by.
    same = rows.groupBy("key", "mask", "part", "good", "toxic", "doc_id").agg(F.count("*").alias("n"))
    of_text = same.groupBy("key", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("doc_id").alias("low"),
        F.min_by("n", "doc_id").alias("n_low"),
    )
    lowest = of_text.groupBy(F.col("key").alias("k")).agg(F.min("low").alias("lowest"))
    met = of_text.join(lowest, F.col("key") == F.col("k"))
    first = F.col("no_id") + F.when(F.col("low") == F.col("lowest"), F.col("n_low")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask"), first.alias("n")),
        F.struct((F.col("mask") + (1 << COPIES)).alias("mask"), (F.col("n") - first).alias("n")),
    )
    counted = met.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    of = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def worths(counts: list[int]) -> list[int]:
    """Of each coalition: what it removes, from counts by failure mask."""
    return [sum(n for mask, n in enumerate(counts) if mask & s) for s in range(len(counts))]


def potentials(worth: list[int]) -> list[int]:
    """120 times the Hart-Mas-Colell potential of each coalition (up to five players)."""
    found = [0] * len(worth)
    for s in range(1, len(worth)):  # a coalition's subsets are smaller numbers
        members = [i for i in range(len(FILTERS)) if s >> i & 1]
        found[s] = (120 * worth[s] + sum(found[s ^ 1 << i] for i in members)) // len(members)
    return found


def steps(n: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) of a part from its counts by mask."""
    total, last = sum(n), len(n) - 1
    worth, good, toxic = worths(n), worths(good), worths(toxic)
    of = potentials(worth)
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = worth[after] - worth[before]
            yield (
                "".join(FILTERS[j] for j in order), step, total - worth[after], removed, worth[1 << i] - removed,
                worth[last] - worth[last ^ 1 << i], good[after] - good[before], toxic[after] - toxic[before], of[last] - of[last ^ 1 << i],
            )
            before = after


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """A row for each part (a value of column ``part``), filter_order and step."""
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tables = [[0] * (1 << len(FILTERS)) for _ in range(3)]
                for x in row["counts"]:
                    for table, c in zip(tables, ("n", "good", "toxic"), strict=True):
                        table[x["mask"]] = x[c]
                made = list(steps(*tables))
                columns = [[row["part"]] * len(made), *zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    # At most 32 rows of a part are gathered.
    parts = failure_counts(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
