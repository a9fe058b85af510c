"""A language model whose n-gram counts live in a log-frequency Bloom filter.

Counts of words and of word pairs are quantised to levels (1, 2, 3, 4, 5, 6, 8,
10, 12, 15, ...: powers of ``BASE``, rounded up). An n-gram of level m is put
into the filter m times, as (n-gram, 1) .. (n-gram, m); its level is read back by
probing (n-gram, 1), (n-gram, 2), ... until one is missing. A false positive
lifts a level; no level is read too low.

A text is its words in lower case (A-Z only) and one end. With counts c read from
the filter, N training tokens and V different ones,

    p1(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h)  = L c(h w) / c(h) + (1 - L) p1(w)

where h is the word before, or the start. L depends on the level of c(h): it is
the mean, over all training tokens with such a context, of the pair's share in
an even mixture of both estimates, the token itself left out of the counts (one
step of deleted interpolation). ``score`` is the sum of log10 p over a text's
tokens; ``base_score`` is that of p1 with the exact counts, which are kept beside
the filter.

The filter is made in shards of ``SHARD_BYTES``, by the tokens' hashes. It has
``BITS`` bits for each level of a word and for each training token (levels of
pairs are at most their counts, so they are fewer than tokens), so it grows with
the corpus. Up to ``BROADCAST_BYTES`` in all, shards are broadcast one by one
and texts are scored in one pass. A larger filter stays a table: the different
n-grams of blocks of texts are sent to their shards, looked up there and sent
back to their block. Results are the same on either way.

Words are known by 64-bit hashes: two of a vocabulary of ten million have the
same one with a probability of about 1 in 100,000.

Defined results: a null text counts as empty, which has one token, the end; rows
for which the training condition is null are not learned from; repeated rows
count as often as they come; with nothing to learn from, each token has
probability 1; an empty table gives no rows. Other columns come back as they
are, those named like a result are replaced. Texts are worked on whole; memory
follows the longest.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.llm.arrow_words import pieces
from hopscope.llm.common import stored

BASE = 1.25
BITS = 6
PROBES = 4
SHARD_BYTES = 1 << 21
#: The most that is broadcast: filter and exact counts together.
BROADCAST_BYTES = 256 << 20
#: Tokens that a task counts before it passes counts on.
COUNTED = 4 << 20
#: Bytes of words that are hashed together, and of texts that are scored together.
HASHED = 1 << 20
PIECE_BYTES = 4 << 20
#: Rows of a batch of counts.
PASSED = 1 << 18
#: The most shards that are made without sorting the counts.
UNSORTED = 2000
#: Text of a block whose n-grams are looked up together if shards are not broadcast.
BLOCK_BYTES = 8 << 20

LEVELS = np.array(sorted({math.ceil(BASE**k) for k in range(int(63 / math.log2(BASE)))}), np.int64)
#: What a level stands for: the middle, in logarithms, of its counts; 0 for none.
VALUES = np.concatenate([[0.0], np.sqrt(LEVELS * (np.append(LEVELS[1:], LEVELS[-1] + 1) - 1.0))])

_rng = np.random.default_rng(13)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = 0x9E3779B97F4A7C15
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    return np.multiply.accumulate(out, out=out)


def _hashed(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of each word raw[lo:hi]: a polynomial in its bytes' random numbers,
    modulo 2^64, from sums over some ``HASHED`` bytes of words at once."""
    out = np.zeros(len(lo), np.uint64)
    size = min(int(hi[-1] - lo[0]), max(HASHED, int((hi - lo).max()))) if len(lo) else 0
    powers, back = _powers(_STEP, size), _powers(pow(_STEP, -1, 1 << 64), size)
    i = 0
    while i < len(lo):
        j = max(i + 1, int(np.searchsorted(hi, lo[i] + size, "right")))
        base, sums = lo[i], np.zeros(hi[j - 1] - lo[i] + 1, np.uint64)
        np.cumsum(_BYTE[raw[base : hi[j - 1]]] * powers[: len(sums) - 1], out=sums[1:])
        out[i:j] = (sums[hi[i:j] - base] - sums[lo[i:j] - base]) * back[lo[i:j] - base]
        i = j
    return mixed(out)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and where each text's
    begin (one entry more than texts).

    """
    held = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = held.buffers()
    off = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    ink = ~_SPACE[raw]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1] | cut[1:n]
    last[:-1] &= ~ink[1:] | cut[1:n]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = _hashed(raw, lo, hi)

    begin = np.searchsorted(lo, off)
    rows = np.arange(len(held))
    out = np.full(len(words) + len(held), END, np.uint64)
    out[np.arange(len(words)) + np.repeat(rows, np.diff(begin))] = words
    return out, begin + np.arange(len(held) + 1)


def pairs(toks: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each token and the one before it."""
    before = np.roll(toks, 1)
    before[begin[:-1]] = START
    return mixed(before * np.uint64(0xC2B2AE3D27D4EB4F) + toks)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[at], np.diff(np.append(at, len(keys)))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(shards)).astype(np.int32)


def _drawn(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and step of an entry's bits."""
    h = mixed(keys + np.uint64(level * _STEP & (1 << 64) - 1))
    return h, (h >> np.uint64(32)) | np.uint64(1)


def _place(h: np.ndarray, step: np.ndarray, i: int) -> np.ndarray:
    return ((h + step * np.uint64(i)) & np.uint64(8 * SHARD_BYTES - 1)).astype(np.int64)


def filled(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A shard's bits with the keys in it, each as often as its level."""
    bits = np.zeros(8 * SHARD_BYTES, bool)
    level = np.searchsorted(LEVELS, counts, "right")
    for j in range(1, int(level.max(initial=0)) + 1):
        keys, level = keys[level >= j], level[level >= j]
        h, step = _drawn(keys, j)
        for i in range(PROBES):
            bits[_place(h, step, i)] = True
    return np.packbits(bits, bitorder="little")


def _there(bits: np.ndarray, h: np.ndarray, step: np.ndarray, i: int) -> np.ndarray:
    at = _place(h, step, i)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def probed(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The level of each key in a shard, by probes until one is missing: level by
    level, and for the last few keys some levels at once."""
    level = np.zeros(len(keys), np.uint8)
    left = np.arange(len(keys))
    j = 0
    while len(left) and j < len(LEVELS):
        if len(left) > 200:
            j += 1
            h, step = _drawn(keys[left], j)
            for i in range(PROBES):
                there = _there(bits, h, step, i)
                left, h, step = left[there], h[there], step[there]
            level[left] = j
            continue
        wide = min(32, len(LEVELS) - j)
        h = mixed(keys[left][:, None] + np.arange(j + 1, j + wide + 1, dtype=np.uint64) * np.uint64(_STEP))
        step = (h >> np.uint64(32)) | np.uint64(1)
        there = functools.reduce(np.logical_and, (_there(bits, h, step, i) for i in range(PROBES)))
        run = np.where(there.all(axis=1), wide, there.argmin(axis=1))
        level[left] = j + run
        left, j = left[run == wide], j + wide
    return level


class Block:
    """The tokens of some texts and what is to be looked up for them."""

    def __init__(self, texts: pa.Array):
        self.tokens, self.begin = tokens(texts)
        order = np.argsort(self.tokens, kind="stable")
        ranked = self.tokens[order]
        new = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
        self.words = ranked[new]
        self.word = np.empty(len(order), np.int64)  # of each token: its place in words
        self.word[order] = np.cumsum(new) - 1
        self.pairs = pairs(self.tokens, self.begin)


@dataclass
class Shard:
    bits: np.ndarray
    words: np.ndarray  # in order
    counts: np.ndarray

    def exact(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.counts[at].astype(np.int64), 0)


def _shard(bits: bytes, words: bytes, counts: bytes) -> Shard:
    words = np.frombuffer(words, "<u8")
    # Four bytes a count, eight if there are larger ones.
    return Shard(np.frombuffer(bits, np.uint8), words, np.frombuffer(counts, "<i8" if len(counts) == 8 * len(words) else "<u4"))


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    of = shard_of(keys, shards)
    of = of.astype(np.uint16) if shards <= 1 << 16 else of  # sorted by digits
    order = np.argsort(of, kind="stable")
    edge = np.searchsorted(of[order], np.arange(shards + 1))
    for s in range(shards):
        if edge[s] < edge[s + 1]:
            yield s, order[edge[s] : edge[s + 1]]


#: What is done with a batch whose texts are looked up: (batch, block, exact
#: counts of words, levels of words, levels of pairs) -> batch.
Work = Callable[[pa.RecordBatch, Block, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]


@dataclass
class Model:
    table: DataFrame  # shard, bits, words, counts
    shards: int
    n_tokens: int
    n_words: int  # different ones
    broadcast: list | None  # of the shards, if they are small enough
    weights: np.ndarray  # L by level of the context

    def first(self) -> Callable[[np.ndarray], np.ndarray]:
        """p1, a function of counts."""
        all_tokens = self.n_tokens + 0.5 * (self.n_words + 1)
        return lambda counts: (counts + 0.5) / all_tokens

    def work(self, docs: DataFrame, text: str, work: Work, schema: str) -> DataFrame:
        """``work`` on batches of ``docs`` (``text`` is its last column)."""
        return (self._work_here if self.broadcast is not None else self._work_by_shard)(docs, text, work, schema)

    def _work_here(self, docs: DataFrame, text: str, work: Work, schema: str) -> DataFrame:
        held, shards = self.broadcast, self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, batch.num_columns - 1, PIECE_BYTES):
                    block = Block(piece.column(batch.num_columns - 1))
                    exact, level = np.zeros(len(block.words), np.int64), np.zeros(len(block.words), np.uint8)
                    for s, at in _by_shard(block.words, shards):
                        shard = _shard(*held[s].value)
                        exact[at], level[at] = shard.exact(block.words[at]), probed(shard.bits, block.words[at])
                    pair = np.zeros(len(block.pairs), np.uint8)
                    for s, at in _by_shard(block.pairs, shards):
                        pair[at] = probed(_shard(*held[s].value).bits, block.pairs[at])
                    yield work(piece, block, exact, level, pair)

        return docs.mapInArrow(run, schema)

    def _work_by_shard(self, docs: DataFrame, text: str, work: Work, schema: str) -> DataFrame:
        shards, columns = self.shards, docs.columns
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(size // BLOCK_BYTES + 1))
        blocks = stored(docs.withColumn("__block", block), "lm-blocks")

        def ask(group: pa.Table) -> pa.Table:
            found = Block(group.column(columns[-1]).combine_chunks())
            keys = np.concatenate([found.words, counted(found.pairs)[0]])
            of_word = np.arange(len(keys)) < len(found.words)
            return pa.table({
                "__block": pa.array(np.full(len(keys), group.column("__block")[0].as_py(), np.int64)),
                "shard": pa.array(shard_of(keys, shards)), "key": pa.array(keys.view(np.int64)), "of_word": pa.array(of_word),
            })

        def answer(asked: pa.Table, shard: pa.Table) -> pa.Table:
            found = _shard(*(shard.column(c)[0].as_py() for c in ("bits", "words", "counts"))) if shard.num_rows else None
            keys = asked.column("key").to_numpy().view(np.uint64)
            words = asked.column("of_word").to_numpy()
            exact = np.zeros(len(keys), np.int64)
            if found and len(keys):
                exact[words] = found.exact(keys[words])
            level = probed(found.bits, keys) if found else np.zeros(len(keys), np.uint8)
            return pa.table({"__block": asked.column("__block"), "key": asked.column("key"), "of_word": asked.column("of_word"), "exact": pa.array(exact), "level": pa.array(level.astype(np.int32))})

        def finish(group: pa.Table, told: pa.Table) -> pa.Table:
            batch = group.select(columns).combine_chunks()
            batch = batch.to_batches()[0] if batch.num_rows else pa.RecordBatch.from_pylist([], batch.schema)
            found = Block(batch.column(len(columns) - 1))
            keys, of_word = told.column("key").to_numpy().view(np.uint64), told.column("of_word").to_numpy()
            exact, level = told.column("exact").to_numpy(), told.column("level").to_numpy().astype(np.uint8)
            got = []
            for mine, wanted in ((of_word, found.words), (~of_word, found.pairs)):
                order = np.argsort(keys[mine])
                got.append(np.flatnonzero(mine)[order][np.searchsorted(keys[mine][order], wanted)])
            return pa.Table.from_batches([work(batch, found, exact[got[0]], level[got[0]], level[got[1]])])

        asked = blocks.select("__block", columns[-1]).groupBy("__block").applyInArrow(ask, "__block long, shard int, key long, of_word boolean")
        told = asked.groupBy("shard").cogroup(self.table.groupBy("shard")).applyInArrow(answer, "__block long, key long, of_word boolean, exact long, level int")
        return blocks.groupBy("__block").cogroup(told.groupBy("__block")).applyInArrow(finish, schema)


def _counts(texts: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], shards: int = 1) -> DataFrame:
    """key, n, shard: n-grams of the texts (one column), counted within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> Iterator[pa.RecordBatch]:
            keys, n = counted(np.concatenate(held))
            held.clear()
            for lo in range(0, len(keys), PASSED):
                part = keys[lo : lo + PASSED]
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(n[lo : lo + PASSED], pa.int64()), pa.array(shard_of(part, shards))], ["key", "n", "shard"])

        held, size = [], 0
        for batch in batches:
            for piece in pieces(batch, 0, PIECE_BYTES):
                held.append(of(*tokens(piece.column(0))))
                size += len(held[-1])
                if size >= COUNTED:
                    yield from passed()
                    size = 0
        if held:
            yield from passed()

    return texts.mapInArrow(run, "key long, n long, shard int")


def _made_shards(words: DataFrame, texts: DataFrame, shards: int) -> DataFrame:
    """shard, bits, words, counts from the words' counts and the texts' pairs.

    Up to ``UNSORTED`` shards each is gathered in a task (some tasks get none,
    some a few); more are sorted within tasks and made one after the other.
    """
    unsorted = shards <= UNSORTED

    def made(shard: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        # Pairs come counted by task; words come once, with negative counts.
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, n = keys[at], np.add.reduceat(n, at)
        word = n < 0
        n = np.abs(n)
        row = [shard, filled(keys, n).tobytes(), keys[word].astype("<u8").tobytes(), n[word].astype("<u4" if n.max(initial=0) < 1 << 32 else "<i8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["shard", "bits", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            keys, n = batch.column("key").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            of = batch.column("shard").to_numpy()
            order = np.argsort(of, kind="stable")
            edge = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1])[: len(of)])
            for at in np.split(order, edge[1:]) if len(of) else []:
                held.setdefault(int(of[at[0]]), []).append((keys[at], n[at]))
            if not unsorted:
                for shard in sorted(held)[:-1]:
                    yield made(shard, held.pop(shard))
        for shard in sorted(held):
            yield made(shard, held.pop(shard))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = shard_of(batch.column(0).to_numpy().view(np.uint64), shards)
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.negate(batch.column(1)), pa.array(of)], ["key", "n", "shard"])

    schema = "key long, n long, shard int"
    both = words.mapInArrow(dealt, schema).unionByName(_counts(texts, pairs, shards))
    both = both.repartition(shards, "shard") if unsorted else both.repartition("shard").sortWithinPartitions("shard")
    return both.mapInArrow(run, "shard int, bits binary, words binary, counts binary")


RESULTS = ("n_tokens", "n_known", "base_score", "score")


def _looked_up(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with their last column, the text, replaced by n_tokens, n_known,
    base_score, and a byte for each token's level and for each pair's."""
    names, first = rows.columns, model.first()

    def run(batch: pa.RecordBatch, block: Block, exact: np.ndarray, level: np.ndarray, pair: np.ndarray) -> pa.RecordBatch:
        lo = block.begin[:-1]
        of_text = lambda x: np.add.reduceat(x, lo) if len(lo) else x[:0]
        columns = [pa.array(np.diff(block.begin), pa.int64()), pa.array(of_text((exact > 0)[block.word].astype(np.int64)), pa.int64()), pa.array(of_text(np.log10(first(exact))[block.word]))]
        for x in (level[block.word], pair):
            raw = x.tobytes()
            columns.append(pa.array([raw[i:j] for i, j in zip(block.begin[:-1], block.begin[1:], strict=True)], pa.binary()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names[:-1], "n_tokens", "n_known", "base_score", "levels", "pairs"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return model.work(rows, names[-1], run, f"{kept}n_tokens long, n_known long, base_score double, levels binary, pairs binary")


def _levels(levels: pa.Array, pairs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels of tokens, of contexts and of pairs, and where each text's begin."""
    begin = np.append(0, np.cumsum(pc.binary_length(levels).to_numpy(zero_copy_only=False).astype(np.int64)))
    level, pair = (np.frombuffer(b"".join(x.to_pylist()), np.uint8) for x in (levels, pairs))
    before = np.roll(level, 1)
    if len(level):
        before[begin[:-1]] = level[begin[1:] - 1]  # there are as many starts as ends
    return level, before, pair, begin


def _weights(model: Model, looked: DataFrame) -> np.ndarray:
    """L by level of the context, from all training tokens, each left out of its own counts."""
    first = model.first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, share = np.zeros(256, np.int64), np.zeros(256)
        for batch in batches:
            for piece in pieces(batch, 0, PIECE_BYTES):
                level, before, pair, _ = _levels(*piece.columns)
                rest = VALUES[before] - 1
                high = np.where(rest > 0, np.clip(VALUES[pair] - 1, 0, np.maximum(rest, 0)) / np.maximum(rest, 1e-9), 0)
                low = first(np.maximum(VALUES[level] - 1, 0))
                share += np.bincount(before, high / (high + low), 256)
                n += np.bincount(before, minlength=256)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(share[met])], ["level", "n", "share"])

    out = np.zeros(len(VALUES))
    sums = looked.select("levels", "pairs").mapInArrow(run, "level int, n long, share double")
    # One row a level at most reaches the driver.
    for r in sums.groupBy("level").agg(F.sum("n").alias("n"), F.sum("share").alias("share")).collect():
        out[r["level"]] = round(r["share"] / r["n"], 6) if r["level"] else 0
    return out


def _scored(looked: DataFrame, model: Model) -> DataFrame:
    """``looked`` with levels and pairs replaced by the score."""
    names, weights, first = looked.columns, model.weights, model.first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, len(names) - 1, PIECE_BYTES):
                level, before, pair, begin = _levels(*piece.columns[-2:])
                around, mix = VALUES[before], weights[before]
                high = np.where(around > 0, np.minimum(VALUES[pair], around) / np.maximum(around, 1), 0)
                told = np.log10(mix * high + (1 - mix) * first(VALUES[level]))
                total = np.add.reduceat(told, begin[:-1]) if len(told) else told
                yield pa.RecordBatch.from_arrays([*piece.columns[:-2], pa.array(total)], [*names[:-2], "score"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in looked.schema.fields[:-2])
    return looked.mapInArrow(run, f"{kept}score double")


def _counted_model(texts: DataFrame, text: str) -> Model:
    """The counts, without the weights."""
    spark = texts.sparkSession
    words = stored(_counts(texts, lambda t, begin: t).drop("shard").groupBy("key").agg(F.sum("n").alias("n")), "lm-words")
    levels = F.least(F.col("n"), 1 + F.floor(F.log("n") / math.log(BASE)))  # of a word, at most
    row = words.agg(F.sum("n").alias("all"), F.count("*").alias("v"), F.sum(levels).alias("levels")).first()
    n, v = row["all"] or 0, row["v"]
    shards = -(-BITS * (n + (row["levels"] or 0)) // (8 * SHARD_BYTES)) or 1
    table = stored(_made_shards(words, texts, shards), "lm-shards")
    held = None
    if shards * SHARD_BYTES + 16 * v <= BROADCAST_BYTES:
        none = spark.sparkContext.broadcast((bytes(SHARD_BYTES), b"", b""))
        held = [none] * shards
        for r in table.toLocalIterator():
            held[r["shard"]] = spark.sparkContext.broadcast((bytes(r["bits"]), bytes(r["words"]), bytes(r["counts"])))
    return Model(table, shards, n, v, held, np.zeros(len(VALUES)))


def train(docs: DataFrame, train_rows: Column, text: str = "text") -> Model:
    """The model of the texts of rows for which ``train_rows`` is true."""
    texts = docs.where(train_rows).select(text)
    model = _counted_model(texts, text)
    model.weights = _weights(model, _looked_up(texts, model))
    return model


def _packed(docs: DataFrame, text: str, *more: Column) -> tuple[list[str], DataFrame]:
    """The other columns in one, so that none of their names can clash, and the text."""
    others = [c for c in docs.columns if c != text and c not in RESULTS]
    return others, docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), *more, F.col(f"`{text}`").alias("text"))


def _unpacked(others: list[str], scored: DataFrame) -> DataFrame:
    return scored.select(*[F.col("row").getField(c).alias(c) for c in others], *RESULTS)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, and n_tokens, n_known (tokens met in training),
    base_score and score (log10 probabilities)."""
    others, rows = _packed(docs, text)
    return _unpacked(others, _scored(_looked_up(rows, model), model))


def train_and_score(docs: DataFrame, train_rows: Column, text: str = "text") -> tuple[Model, DataFrame]:
    """The model of some rows and the scores of all, as :func:`train` and
    :func:`score` give them; each text is looked up once, its levels kept."""
    others, rows = _packed(docs, text, F.coalesce(train_rows, F.lit(False)).alias("learned"))
    model = _counted_model(docs.where(train_rows).select(text), text)
    looked = stored(_looked_up(rows, model), "lm-levels")
    for shard in {id(b): b for b in model.broadcast or []}.values():
        shard.unpersist()  # executors drop their copies; the model can still be used
    model.weights = _weights(model, looked.where("learned"))
    return model, _unpacked(others, _scored(looked, model))
