"""Seeded, exact-size vertex samples.

A sample of ``k`` ids is the ``k`` smallest ids when ordered by
``md5('<seed>:<id>')`` and then by id. Every engine with md5 draws the same
sample, every node can redraw it, and it is uniform over the ids.

The ``k`` smallest of ``n`` rows are found without funnelling rows through
one task. A histogram of the first four hex digits of the hash (at most
65,536 counts, the only thing brought to the driver) locates the bucket
holding the ``k``-th row. Every row in an earlier bucket is in the sample.
The boundary bucket is refined on the next four digits, and so on, until it
holds at most ``FINAL_BUCKET_ROWS`` rows; those are ordered exactly and the
ids taken from them (a bounded list) are kept.

The result is a :class:`HashCut`: membership is "hash prefix below the cut,
or one of the boundary ids". That is a pure per-row predicate, so a sample
can filter an edge table map-side — every task decides on its own rows —
with no join, no broadcast of the sample and no shuffle of the edges.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.functions.expressions import DEFAULT_SAMPLE_SEED, sample_key
from hopscope.plans.graph import canonical_long

DIGITS_PER_LEVEL = 4
FINAL_BUCKET_ROWS = 10_000


@dataclass
class HashCut:
    """Rows whose hash starts below ``prefix`` (or at most ``prefix`` when
    ``inclusive``) are in; so are the ids in ``extra``. ``everything``
    marks a cut that takes every row."""

    prefix: str = ""
    inclusive: bool = False
    extra: list[str] = field(default_factory=list)
    everything: bool = False

    def predicate(self, h: Column, ident: Column) -> Column:
        if self.everything:
            return F.lit(True)
        cond = F.lit(False)
        if self.prefix:
            head = F.substring(h, 1, len(self.prefix))
            cond = head <= F.lit(self.prefix) if self.inclusive else head < F.lit(self.prefix)
        if self.extra:
            cond = cond | ident.isin(self.extra)
        return cond


def smallest_by_hash(df: DataFrame, k: int, hash_col: str = "h", id_col: str = "id") -> HashCut:
    """The cut that keeps the ``k`` rows of ``df`` with the smallest
    ``(hash_col, id_col)``. ``hash_col`` must be a fixed-width lowercase hex
    string (md5); ids are assumed distinct."""
    if k <= 0:
        return HashCut()
    prefix = ""
    remaining = k
    while True:
        depth = len(prefix)
        scope = df.where(F.col(hash_col).startswith(prefix)) if prefix else df
        bucket = F.substring(F.col(hash_col), depth + 1, DIGITS_PER_LEVEL)
        counts = sorted(
            (r["b"], r["n"])
            for r in scope.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        before = 0
        boundary, boundary_n = None, 0
        for b, n in counts:
            if before + n >= remaining:
                boundary, boundary_n = b, n
                break
            before += n
        if boundary is None:
            # Fewer rows than k left: at the top level that is every row;
            # deeper down it cannot happen (the bucket held >= k rows).
            return HashCut(everything=True) if not prefix else HashCut(prefix, inclusive=True)
        remaining -= before
        prefix = prefix + boundary
        if remaining == boundary_n:
            return HashCut(prefix, inclusive=True)
        if boundary_n <= FINAL_BUCKET_ROWS or len(prefix) >= 32:
            extra = [
                r[0]
                for r in df.where(F.col(hash_col).startswith(prefix))
                .orderBy(hash_col, id_col)
                .limit(remaining)
                .select(F.col(id_col).cast("string"))
                .collect()
            ]
            return HashCut(prefix, inclusive=False, extra=extra)


@dataclass
class IdSample:
    """``k`` ids drawn from ``start .. start + n - 1`` (or from a vertex
    table when ``n`` is None)."""

    k: int
    seed: int
    cut: HashCut
    start: int | None = None
    n: int | None = None

    def contains(self, ident: Column) -> Column:
        """Per-row membership test on a string id column."""
        s = ident.cast("string")
        inside = self.cut.predicate(sample_key(s, self.seed), s)
        if self.n is not None:
            v = s.try_cast("long")
            inside = canonical_long(s) & (v >= F.lit(self.start)) & (v < F.lit(self.start + self.n)) & inside
        return F.coalesce(inside, F.lit(False))


def draw_ids(spark: SparkSession, k: int, n: int, seed: int = DEFAULT_SAMPLE_SEED, start: int = 1) -> IdSample:
    """Draw ``k`` distinct ids from ``start .. start + n - 1``."""
    if k > n:
        raise ValueError(f"cannot draw {k} distinct ids from a range of {n}")
    ids = spark.range(start, start + n).select(F.col("id").cast("string").alias("id"))
    cut = smallest_by_hash(ids.withColumn("h", sample_key("id", seed)), k)
    return IdSample(k=k, seed=seed, cut=cut, start=start, n=n)


def sample_ids(spark: SparkSession, k: int, n: int, seed: int = DEFAULT_SAMPLE_SEED, start: int = 1) -> DataFrame:
    """Exactly ``k`` distinct ids drawn from ``start .. start + n - 1``
    (column ``id``, string). Ids that do not occur in the graph may be drawn."""
    draw = draw_ids(spark, k, n, seed=seed, start=start)
    ids = spark.range(start, start + n).select(F.col("id").cast("string").alias("id"))
    return ids.where(draw.contains(F.col("id")))


def draw_vertices(vertices: DataFrame, k: int, seed: int = DEFAULT_SAMPLE_SEED, id_col: str = "vertex") -> IdSample:
    """Draw ``min(k, distinct ids)`` of the ids present in ``vertices``."""
    ids = vertices.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
    cut = smallest_by_hash(ids.withColumn("h", sample_key("id", seed)), k)
    return IdSample(k=k, seed=seed, cut=cut)


def sample_vertices(vertices: DataFrame, k: int, seed: int = DEFAULT_SAMPLE_SEED, id_col: str = "vertex") -> DataFrame:
    """Exactly ``min(k, distinct ids)`` ids drawn from the ids present in
    ``vertices`` (column ``id``, string)."""
    draw = draw_vertices(vertices, k, seed=seed, id_col=id_col)
    ids = vertices.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
    return ids.where(draw.contains(F.col("id")))
