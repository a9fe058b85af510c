"""Benchmark decontamination by the q-gram lemma.

Each benchmark item, normalised, is one segment, or overlapping segments of
``SEGMENT`` characters if it is longer. A segment of m characters leaks into a
document if some region of the document is within ``k = floor(budget * m)``
edits of it. Such a region shares at least ``m - q + 1 - k*q`` q-grams with the
segment (the q-gram lemma), on diagonals that differ by k at most. So shared
q-grams are counted in diagonal bands of width 2k+2 that overlap by k+1; bands
that meet the bound are verified by banded alignment.

The benchmark is a stated query set: it is cut into blocks of at most
``BLOCK_CHARS`` characters, each is broadcast, and the documents stream past it
in Arrow batches. The documents are never shuffled and no pairs of documents
are made. A text is worked through in pieces of ``PIECE`` characters, and in
stretches that share ``ENTRIES`` q-grams with the block at most, so that memory
does not grow with a text or with a q-gram that text or block repeat; pieces and
stretches overlap by as much as a band may span, so each band is counted whole.

Found for sure: a whole item of up to 160 normalised characters within its
budget, and of a longer one any verbatim excerpt of 191 characters, which holds a
whole segment. Shorter excerpts, and parts of items up to 160, may pass.

Defined results: texts are compared in lower case with each run of white space
as one space; a null or empty text, document or item, matches nothing; a
segment shorter than q must occur exactly; each row of a repeated document
gives its own result rows and repeated items count as one each; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm.common import SMALL_BATCHES, lean, stored
from hopscope.plans.session import scoped_conf

Q = 10
#: Edits per character of a segment.
BUDGET = 0.06
SEGMENT = 128
BLOCK_CHARS = 4_000_000
#: Characters of a text, and q-grams shared with a block, that are looked at together.
PIECE = 1 << 20
ENTRIES = 1 << 19

HITS = "doc_id long, item_id long, n_regions long, min_edits long, start long, end long"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of each q-gram, by doubling."""
    with np.errstate(over="ignore"):
        have, width = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
        out, done = None, 0
        while width <= q:
            if q & width:
                n = len(code) - q + 1
                part = have[done : done + n]
                out = part if out is None else out * np.uint64(pow(0x100000001B3, width, 1 << 64)) + part
                done += width
            have = have[:-width] * np.uint64(pow(0x100000001B3, width, 1 << 64)) + have[width:] if width * 2 <= q else have
            width *= 2
    return out ^ (out >> np.uint64(29))


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The whole text, or windows at half steps, the last one at its end."""
    if len(text) <= size + size // 4:
        return [text] if text else []
    starts = [*range(0, len(text) - size, size // 2), len(text) - size]
    return [text[i : i + size] for i in dict.fromkeys(starts)]


def align(pattern: np.ndarray, text: np.ndarray, diagonal: int, half: int, budget: int) -> tuple[int, int, int] | None:
    """Least edits of ``pattern`` against any stretch of ``text`` whose path stays
    within ``half`` of ``diagonal`` (text minus pattern position): (edits, start,
    end), or None beyond ``budget``. Columns of the table are diagonals."""
    width, big = 2 * half + 1, 1 << 20
    offsets = np.arange(width)
    first = diagonal - half
    lo, m = max(first, 0), len(pattern)
    near = text[lo : max(lo, first + width - 1 + m)]
    if len(near) >= m:  # a stretch without edits needs no table
        exact = (np.lib.stride_tricks.sliding_window_view(near, m) == pattern).all(axis=1)
        if exact.any():
            at = lo + int(exact.argmax())
            return 0, at, at + m
    row = np.where((first + offsets >= 0) & (first + offsets <= len(text)), 0, big)
    origin = first + offsets
    for i, c in enumerate(pattern):
        at = first + i + offsets
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == c
        step = row + ~same
        step[~inside] = big
        up = np.append(row[1:], big) + 1  # pattern character left out
        up_origin = np.append(origin[1:], -1)
        take = up < step
        best, start = np.where(take, up, step), np.where(take, up_origin, origin)
        reach = np.minimum.accumulate(best - offsets)  # text characters added
        source = np.maximum.accumulate(np.where(best - offsets == reach, offsets, 0))
        end_at = at + 1
        row = np.where((end_at >= 0) & (end_at <= len(text)), reach + offsets, big)
        origin = start[source]
        if row.min() > budget:
            return None
    k = int(row.argmin())
    return (int(row[k]), int(origin[k]), first + len(pattern) + k) if row[k] <= budget else None


class Index:
    """The q-grams of a block of segments."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, budget: float = BUDGET):
        self.q, self.items, self.codes, self.budget = q, [], [], []
        for item, text in items:
            for s in segments(normalise(text)):
                self.items.append(item)
                self.codes.append(codes(s))
                self.budget.append(min(int(budget * len(s)), max(0, (len(s) - q) // q)))
        self.short = [i for i, c in enumerate(self.codes) if len(c) < q]
        long = [i for i, c in enumerate(self.codes) if len(c) >= q]
        hashed = [grams(self.codes[i], q) for i in long]
        gram = np.concatenate([*hashed, np.zeros(0, np.uint64)])
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.segment = np.repeat(np.array(long, np.int64), [len(h) for h in hashed])[order]
        self.position = np.concatenate([*[np.arange(len(h)) for h in hashed], np.zeros(0, np.int64)])[order]
        self.bounds = np.array([self.bound(s) for s in range(len(self.items))], np.int64)
        # A band is two steps wide, so any k+1 neighbouring diagonals lie within one.
        self.steps = np.array(self.budget, np.int64) + 1
        # More than the places of a band's q-grams span.
        self.reach = max((len(c) + 2 * (k + 1) for c, k in zip(self.codes, self.budget, strict=True)), default=0)
        # The entries of one q-gram stand in the order of their segments.
        self.rank = np.cumsum(np.append(0, self.gram[1:] != self.gram[:-1])) if len(self.gram) else np.zeros(0, np.int64)
        self.key = self.rank * len(self.items) + self.segment
        self.bits = 22
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.gram >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def bound(self, s: int) -> int:
        return max(1, len(self.codes[s]) - self.q + 1 - self.budget[s] * self.q)

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of verified regions of a document."""
        norm = normalise(text)
        if not norm or not self.items:
            return []
        found = []
        for s in self.short:
            at = norm.find("".join(map(chr, self.codes[s])))
            if at >= 0:
                found.append((self.items[s], 0, at, at + len(self.codes[s])))
        code = codes(norm)
        if len(code) < self.q or not len(self.gram):
            return found
        met = [np.zeros(0, np.int64)]
        for start in range(0, len(code), PIECE):
            piece = code[start : start + PIECE + self.reach + self.q]
            if len(piece) >= self.q:
                self._piece(grams(piece, self.q), start, met)
        met = np.unique(np.concatenate(met))
        for s in np.unique(met >> 32):
            found += self._regions(int(s), code, (met[met >> 32 == s] & 0xFFFFFFFF) - 512)
        return found

    def _piece(self, gram: np.ndarray, start: int, met: list[np.ndarray]) -> None:
        """Add to ``met`` the segments and bands, (segment << 32) + band + 512, that
        share enough of the q-grams of a text from ``start`` on."""
        at = np.flatnonzero(self.seen[(gram >> np.uint64(64 - self.bits)).astype(np.int64)])
        lo = np.searchsorted(self.gram, gram[at], "left")
        n = np.searchsorted(self.gram, gram[at], "right") - lo
        at, lo, n = at[n > 0] + start, lo[n > 0], n[n > 0]
        ends, i = np.cumsum(n), 0
        while i < len(at):
            j = max(np.searchsorted(ends, ends[i] - n[i] + ENTRIES, "right"), np.searchsorted(at, at[i] + 2 * self.reach))
            self._stretch(at[i:j], lo[i:j], n[i:j], 0, len(self.items), met)
            i = np.searchsorted(at, at[j] - self.reach) if j < len(at) else j

    def _stretch(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray, first: int, last: int, met: list[np.ndarray]) -> None:
        """The same for places ``at`` whose q-grams have ``n`` entries from ``lo`` on,
        of segments from ``first`` up to ``last``; halved while the entries are too many."""
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if n.sum() > ENTRIES and last - first > 1:
            middle = (first + last) // 2
            cut = np.searchsorted(self.key, self.rank[lo] * len(self.items) + middle)
            self._stretch(at, lo, cut - lo, first, middle, met)
            self._stretch(at, cut, lo + n - cut, middle, last, met)
            return
        # One entry for each shared q-gram: segment, its position there, its diagonal.
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        segment = self.segment[entry]
        enough = np.bincount(segment - first, minlength=last - first) >= self.bounds[first:last]
        kept = enough[segment - first]
        segment, position = segment[kept], self.position[entry[kept]]
        band = (np.repeat(at, n)[kept] - position) // self.steps[segment]
        band = (segment << 40) + ((band + 512) << 8) + position
        # A q-gram of the segment counts once in a band, and lies in two bands.
        ids, counts = np.unique(np.unique(np.concatenate([band, band - 256])) >> 8, return_counts=True)
        met.append(ids[counts >= self.bounds[ids >> 32]])

    def _regions(self, s: int, code: np.ndarray, bands: np.ndarray) -> list[tuple[int, int, int, int]]:
        k, step = self.budget[s], self.budget[s] + 1
        out = []
        for b in bands:
            if hit := align(self.codes[s], code, int(b) * step + k, k + 1 + k, k):
                if not out or hit[1] >= out[-1][3] - len(self.codes[s]) // 2:
                    out.append((self.items[s], *hit))
        return out


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items of at most ``limit`` characters (or one item), one at a time."""
    block, size = [], 0
    for item, text in benchmark.select("item_id", "text").where("text IS NOT NULL AND text != ''").toLocalIterator():
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def _hits(docs: DataFrame, benchmark: DataFrame, q: int = Q, budget: float = BUDGET, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``leaks`` with the md5 of the document's text, ``fp``."""
    spark = docs.sparkSession
    slim = docs.select("doc_id", "text")
    out = None
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(Index(block, q, budget))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    best: dict = {}
                    for item, edits, start, end in index.matches(text.as_py()):
                        n, *old = best.get(item, (0,))
                        best[item] = (n + 1, *min([(edits, start, end), *([tuple(old)] if old else [])]))
                    fp = hashlib.md5(text.as_py().encode()).hexdigest() if best else None
                    rows += [(doc, item, *found, fp) for item, found in best.items()]
                *cols, fps = list(zip(*rows, strict=True)) or [()] * 7
                names = ["doc_id", "item_id", "n_regions", "min_edits", "start", "end", "fp"]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(fps, pa.string())], names)

        part = slim.mapInArrow(lean(find), f"{HITS}, fp string")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"{HITS}, fp string")


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """A row for each document row and benchmark item that leaks into it:
    doc_id, item_id, n_regions, min_edits and the place of the best region,
    in characters of the normalised text."""
    return _hits(docs, benchmark, **options).drop("fp")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns as they were, into which no item leaks. All rows
    of a contaminated doc_id go; rows without a doc_id are documents of their own,
    so each goes by its own text. Contaminated documents are few beside the
    documents, but their number grows with them, so Spark chooses the join by
    their size."""
    own = lambda doc, fp: F.when(doc.isNull(), fp)
    with scoped_conf(docs.sparkSession, SMALL_BATCHES):
        found = _hits(docs, benchmark, **options)
        found = stored(found.select(F.col("doc_id").alias("leaked"), own(F.col("doc_id"), F.col("fp")).alias("leaked_fp")).distinct(), "leaks")
    mine = docs["doc_id"].eqNullSafe(found["leaked"]) & own(docs["doc_id"], F.md5(docs["text"])).eqNullSafe(found["leaked_fp"])
    return docs.join(found, mine, "left_anti")
