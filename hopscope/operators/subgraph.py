"""Induced subgraph: the edges whose two ends both lie in a vertex set."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.operators.sampling import IdSample
from hopscope.plans.graph import normalize_edges
from hopscope.plans.session import broadcast_limit, fits_broadcast, materialize, row_bytes

#: Bits of the filter for each id, and bits that an id sets in its one word.
BITS_PER_ID, BITS_SET = 12, 4
#: Ids for each word above which the filter would let nearly all through.
CROWDED = 24


def induced_subgraph(edges: DataFrame, ids: DataFrame | IdSample, *, max_ids: int | None = None,
                     max_id_length: int = 20, id_col: str = "id") -> DataFrame:
    """Edges ``(src, dst)`` with ``src`` and ``dst`` both in ``ids``.

    ``ids`` as an :class:`IdSample` (a hash-ordered sample): membership is a
    per-row predicate, so both ends are tested map-side and the edge table
    is neither joined nor shuffled.

    ``ids`` as a frame: two semi-joins. When the caller knows a bound on the
    id count (``max_ids``) and the ids fit under the broadcast limit, both
    run map-side against one broadcast copy. Otherwise both ends are first
    tested where the edges are scanned, by a Bloom filter of the ids
    (:func:`id_filter`), so that only edges that are nearly sure to stay are
    shuffled to the semi-joins (adaptive execution splits skewed keys).

    Duplicate edges are kept.
    """
    e = normalize_edges(edges)
    if isinstance(ids, IdSample):
        return e.where(ids.contains(F.col("src")) & ids.contains(F.col("dst")))
    spark = edges.sparkSession
    v = ids.select(F.col(id_col).cast("string").alias("_id")).where(F.col("_id").isNotNull())
    if max_ids is not None and fits_broadcast(spark, max_ids, row_bytes(1, max_id_length)):
        v = F.broadcast(v)
    else:
        v, n = materialize(v.distinct())
        words = id_filter(v, "_id", n)
        if words is not None:
            e = may_hold(may_hold(e, words, "src"), words, "dst")
    e = e.join(v, e.src == v._id, "left_semi")
    return e.join(v, e.dst == v._id, "left_semi")


@dataclass
class IdFilter:
    table: DataFrame  # f_word, f_bits; at most ``words`` rows
    words: int


def _word_and_bits(c: str, words: int) -> tuple[Column, Column]:
    """The word of an id and the bits that it sets there: six bits of its hash for each."""
    h = F.xxhash64(c)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS_SET), F.lit(words)), mask


def id_filter(ids: DataFrame, column: str, n: int) -> IdFilter | None:
    """A Bloom filter of ``n`` ids as a table (word, bits) of 64-bit words, each
    id in one word; None if so many ids would crowd the largest filter that may
    be broadcast. Built by a grouped ``bit_or``, so ids are counted together
    within tasks and none reaches the driver."""
    most = broadcast_limit(ids.sparkSession) // row_bytes(0, 0, fixed_cols=2)
    words = min(most, 1 << max(4, math.ceil(math.log2(max(1, n) * BITS_PER_ID / 64))))
    if words < 1 or n > CROWDED * words:
        return None
    word, bits = _word_and_bits(column, words)
    made = ids.select(word.alias("f_word"), bits.alias("f_bits")).groupBy("f_word").agg(F.bit_or("f_bits").alias("f_bits"))
    return IdFilter(made, words)


def may_hold(rows: DataFrame, words: IdFilter, column: str) -> DataFrame:
    """The rows whose ``column`` may be one of the filter's ids: one broadcast
    join on the word, no shuffle."""
    word, bits = _word_and_bits(column, words.words)
    mine = rows.withColumns({"__word": word, "__bits": bits})
    held = (F.col("__word") == F.col("f_word")) & (F.col("__bits").bitwiseAND(F.col("f_bits")) == F.col("__bits"))
    return mine.join(F.broadcast(words.table), held, "left_semi").drop("__word", "__bits")
