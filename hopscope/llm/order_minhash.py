"""Near-duplicate classes by Order MinHash.

A text's five-word shingles are labelled with their occurrence number. Each of
``SKETCHES`` hash orders picks the ``PICKED`` smallest labelled shingles and
keeps them in text order; their hash is a signature. Two texts share one with a
probability that follows their edit similarity. If m shingles of texts of n and
o match in order, it is C(m, PICKED) / C(n + o - m, PICKED) at least: for the
links below, whose Jaccard index may be 2/3, 0.296 in long texts, so all 33
signatures miss with 1 in 100,000. It is less for some short texts; those of
``SHORT`` shingles at most have ``SHORT_SKETCHES`` signatures, which miss with
less than 1 in a million. (A text of ``SHORT`` shingles is as large as one that
links to a text of 20 may be.)

Exact copies (same words, any case and white space) meet first, by a hash of
their words, so one text stands for each group. Texts with a common signature
are candidates. First the members of a bucket are compared with few centres,
drawn anew for each bucket, one or (large buckets) ``CENTRES``. Buckets whose
members are of different components then are compared further, small ones whole,
by a join. Members of large ones meet by an exact prefix filter: of two texts
that match to 0.8 each has n - 0.8 n + 1 shingles, the rarest in one order of
all, among which they share one. The order is by counts of shingles in
``SLOTS`` slots of a hash, then by the shingle, so it is the same for all texts;
a passage that many texts share comes last. Prefixes that meet with others of
different components are compared: few by a join, many in blocks inside tasks,
those outside the largest component against all. A task holds two blocks of
texts' shingles and returns only pairs that match but for three shingles at most;
a pair is met at its first common shingle. This join works on 32 bits of each
shingle, which can only add to what two texts share; its pairs are verified like
all others.
A sketch holds ``BINS`` binned minima of a text's shingles; a pair is dropped
early if they agree in fewer bins than four standard deviations below what
the bound would give for texts of their lengths.

Candidates are verified by banded alignment of their labelled shingles: those
that match in text order, in a band as wide as the bound allows, must be 0.8 or
more of the longer text's. Any pair with a shingle Jaccard index of 0.8 whose
common shingles stand in one order meets that. Classes are the connected
components of links.

Defined results: a null text counts as empty, and texts without words are
copies of each other; a text under five words has one shingle, all of it; a
class is named after its smallest doc_id (null ids come last); repeated rows
are copies; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm.common import SMALL_BATCHES, attach, lean, stored
from hopscope.plans.session import scoped_conf

SHINGLE = 5
SIMILARITY = 0.8
PICKED = 3
SKETCHES = 33
SHORT = 25
SHORT_SKETCHES = 66
CENTRES = 2
#: Members of a bucket that is joined with itself if it has to be.
SMALL = 8
#: Members outside and of all components that are compared in one group.
BLOCK, OTHERS = 256, 1024
#: Slots of shingle counts, four bytes each, that are broadcast.
SLOTS = 1 << 20
BINS = 128


def text_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def labelled_shingles(words: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """A hash of each k-word shingle and the number of its earlier occurrences."""
    ids = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    k = min(k, len(ids))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(ids) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ ids[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    if not new.all():
        at = np.arange(n)
        label = np.empty(n, np.uint64)
        label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        again = (h + label * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        again ^= again >> np.uint64(29)
        h = np.where(label > 0, again, h)  # a first occurrence is the same in texts with and without repeats
    return h


def signatures(words: list[bytes], picked: int = PICKED) -> list[int]:
    h = labelled_shingles(words)
    sketches = SKETCHES if len(h) > SHORT else SHORT_SKETCHES
    if not len(h):
        return [0] * sketches
    rng = np.random.default_rng(7)
    odd = rng.integers(1, 1 << 63, SHORT_SKETCHES, dtype=np.uint64)[:sketches] | np.uint64(1)
    xor = rng.integers(1, 1 << 63, SHORT_SKETCHES, dtype=np.uint64)[:sketches]
    out, take = [], min(picked, len(h))
    group = max(1, 500_000 // len(h))
    for lo in range(0, sketches, group):
        v = (h[None, :] ^ xor[lo : lo + group, None]) * odd[lo : lo + group, None]
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        at = np.argpartition(v, take - 1, axis=1)[:, :take] if take < len(h) else np.tile(np.arange(take), (len(v), 1))
        at.sort(axis=1)  # text order
        sig = np.zeros(len(v), np.uint64)
        for j in range(take):
            sig = (sig ^ h[at[:, j]]) * np.uint64(0xD6E8FEB86659FD93)
            sig ^= sig >> np.uint64(32)
        out += sig.view(np.int64).tolist()
    return out


def sketch(h: np.ndarray) -> bytes:
    """Smallest hash in each of ``BINS`` bins of a text's shingles, 15 bits of it plus one; 0: none."""
    mixed = (h ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0x9FB21C651E98DF25)
    mixed ^= mixed >> np.uint64(29)
    low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, (mixed % np.uint64(BINS)).astype(np.int64), mixed // np.uint64(BINS))
    held = np.where(low == np.iinfo(np.uint64).max, 0, (low & np.uint64(0x7FFF)) + np.uint64(1))
    return held.astype("<u2").tobytes()


def sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, BINS)


def likely(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether rows of sketches, of texts of n and m shingles, may be as similar as that."""
    need = similarity * np.maximum(n, m)
    jaccard = np.minimum(need / (n + m - need), 1)
    told = ((a > 0) | (b > 0)).sum(-1)
    agree = ((a == b) & (a > 0)).sum(-1)
    return agree >= jaccard * told - 4 * np.sqrt(jaccard * (1 - jaccard) * told) - 1


def banded_matches(x: np.ndarray, y: np.ndarray, band: int, need: int = 0) -> int:
    """Most elements of two sequences that match in order, no match further than
    ``band`` from the diagonal. No element repeats within a sequence, so each has
    one place at most to match, and the alignment is a longest increasing run
    of places. Returns 0 if fewer than ``need`` are common."""
    _, i, j = np.intersect1d(x, y, return_indices=True)
    inside = np.abs(i - j) <= band
    if inside.sum() < need:
        return 0
    places = j[inside][np.argsort(i[inside])]
    if (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []  # the smallest last place of a run of each length
    for p in places.tolist():
        at = bisect_left(ends, p)
        ends[at : at + 1] = [p]
    return len(ends)


def same(x: np.ndarray, y: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the labelled shingles that match in order are that share of the longer text's."""
    need = math.ceil(similarity * max(len(x), len(y)) - 1e-9)
    return need <= min(len(x), len(y)) and banded_matches(x, y, len(x) + len(y) - 2 * need, need) >= need


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, fp (of the text as it is), h (of its words), n_words, sigs, bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n, sigs, bins = [], [], [], []
            for text in batch.column(2):
                words = text_words(text.as_py())
                bins.append(sketch(labelled_shingles(words)))
                h.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                n.append(len(words))
                sigs.append(signatures(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(h, pa.binary()), pa.array(n, pa.int64()), pa.array(sigs, pa.list_(pa.int64())), pa.array(bins, pa.binary())],
                ["doc_id", "fp", "h", "n_words", "sigs", "bins"],
            )

    slim = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("fp"), "text")
    return slim.mapInArrow(lean(run), f"doc_id {dict(slim.dtypes)['doc_id']}, fp string, h binary, n_words long, sigs array<long>, bins binary")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) with ``ok``: their shingles align within the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2), batch.column(3), strict=True)
            ok = [same(*(labelled_shingles(text_words(t.as_py())) for t in pair)) for pair in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    left = texts.select(F.col("h").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("h").alias("b"), F.col("text").alias("tb"))
    # Aligning costs far more than its rows weigh, so the pairs are dealt out by number.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").repartition(tasks)
    return both.mapInArrow(lean(run), "a binary, b binary, ok boolean")


def n_shingles(words: str) -> str:
    return f"greatest({words} - {SHINGLE - 1}, 1)"


#: Sizes that a pair may have: the shorter text's shingles are 0.8 of the longer's, at least.
FITS = "least({0}, {1}) >= {2} * greatest({0}, {1})".format(n_shingles("n_words"), n_shingles("m_words"), SIMILARITY)


def _likely_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of met (h, n_words, bins; o, m_words, o_bins) whose sketches agree, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = (sketches(batch.column(k).to_pylist()) for k in (1, 4))
                ok = likely(*bins, *(batch.column(k).to_numpy() for k in (2, 5)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], ["h", "o"]).filter(pa.array(ok))

    size = lambda c: F.expr(n_shingles(c)).alias(c)
    pairs = met.select("h", "bins", size("n_words"), "o", "o_bins", size("m_words")).mapInArrow(lean(run), "h binary, o binary")
    return pairs.select(F.least("h", "o").alias("a"), F.greatest("h", "o").alias("b")).distinct()


def _near_centres(members: DataFrame) -> DataFrame:
    """Likely pairs of the members (band, sig, n, h, n_words, bins) and their buckets' centres."""
    part = F.when(F.col("n") > SMALL, F.pmod(F.xxhash64("h", "band", F.lit(-1)), F.lit(CENTRES))).otherwise(0)
    drawn = F.min(F.struct(F.xxhash64("h", "band").alias("draw"), "h", "n_words")).alias("c")
    heads = members.groupBy("band", "sig", part.alias("part")).agg(drawn)
    heads = heads.select("band", "sig", F.col("c.h").alias("o"), F.col("c.n_words").alias("m_words"))
    heads = heads.join(members.select("band", "sig", F.col("h").alias("o"), F.col("bins").alias("o_bins")), ["band", "sig", "o"])
    return _likely_pairs(members.join(heads, ["band", "sig"]).where(F.expr(FITS) & (F.col("h") != F.col("o"))))


def _open(members: DataFrame) -> DataFrame:
    """The members (also: root) of buckets that hold texts of two or more
    components: a link within a component would not change a class."""
    sizes = members.groupBy("band", "sig").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    return members.drop("n").join(sizes.where("lo != hi").drop("lo", "hi"), ["band", "sig"])


def _small_pairs(left: DataFrame) -> DataFrame:
    """Likely pairs of members of small buckets that are not of one component."""
    few = left.where(F.col("n") <= SMALL).drop("n")
    other = few.select("band", "sig", F.col("h").alias("o"), F.col("n_words").alias("m_words"), F.col("bins").alias("o_bins"), F.col("root").alias("o_root"))
    return _likely_pairs(few.join(other, ["band", "sig"]).where(F.expr(FITS) & (F.col("h") < F.col("o")) & (F.col("root") != F.col("o_root"))))


def prefix_size(n: int) -> int:
    """The rarest shingles of n of which a text that matches shares one."""
    return n - math.ceil(SIMILARITY * n - 1e-9) + 1


def slot_of(held: np.ndarray) -> np.ndarray:
    return ((held.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % SLOTS


def nearly_same(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two texts' 32-bit shingles match in order as :func:`same` asks, but
    for three at most, which may be alike in 32 bits in a long text."""
    need = math.ceil(SIMILARITY * max(len(x), len(y)) - 1e-9)
    band, need = len(x) + len(y) - 2 * need, need - min(3, need // 10)
    return banded_matches(x, y, band, need) >= need


def prefix(held: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A text's rarest shingles, in the order that all texts share."""
    return held[np.lexsort((held, counts[slot_of(held)]))[: prefix_size(len(held))]]


def _shingle_counts(held: DataFrame) -> np.ndarray:
    """Shingles by slot, capped at what four bytes hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(SLOTS, np.int64)
        for batch in batches:
            np.add.at(told, slot_of(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")), 1)
        met = np.flatnonzero(told)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(told[met])], ["slot", "n"])

    out = np.zeros(SLOTS, np.uint32)
    sums = held.select("held").mapInArrow(lean(run), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out[sums.column("slot").to_numpy()] = np.minimum(sums.column("n").to_numpy(), np.iinfo(np.uint32).max)
    return out


def _prefix_links(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links of members of large buckets that are not of one component."""
    spark = left.sparkSession

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [labelled_shingles(text_words(t.as_py())).astype("<u4").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary())], ["h", "root", "held"])

    many = left.where(F.col("n") > SMALL).select("h", "root").distinct()
    held = stored(many.join(texts, "h").select("h", "root", "text").mapInArrow(lean(shingled), "h binary, root binary, held binary"), "omh-held")
    counts = spark.sparkContext.broadcast(_shingle_counts(held))

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_held = [np.frombuffer(x, "<u4") for x in batch.column(2).to_pylist()]
            rarest = [prefix(x, counts.value) for x in all_held]
            row = pa.array(np.repeat(np.arange(len(rarest)), [len(x) for x in rarest]))
            words = pa.array([len(x) + SHINGLE - 1 for x in all_held], pa.int64())
            keys = np.concatenate([*rarest, np.zeros(0, np.uint32)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(row), batch.column(1).take(row), words.take(row)], ["key", "h", "root", "n_words"])

    rows = stored(held.mapInArrow(lean(prefixed), "key long, h binary, root binary, n_words long"), "omh-prefixes")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.mode("root", True).alias("main"))
    open_rows = stored(rows.join(sizes.where("lo != hi").drop("lo", "hi"), "key"), "omh-open")

    few = open_rows.where(F.col("n") <= SMALL).select("key", "h", "root", "n_words")
    other = few.select("key", F.col("h").alias("o"), F.col("root").alias("o_root"), F.col("n_words").alias("m_words"))
    pairs = few.join(other, "key").where(F.expr(FITS) & (F.col("h") < F.col("o")) & (F.col("root") != F.col("o_root")))
    pairs = pairs.select(F.col("h").alias("a"), F.col("o").alias("b"))
    pairs = stored(pairs.unionByName(_block_pairs(open_rows.where(F.col("n") > SMALL), held, counts)).distinct(), "omh-prefix-pairs")
    return stored(_verified(pairs, texts).where("ok").select("a", "b"), "omh-prefix-links")


def _block_pairs(crowded: DataFrame, held: DataFrame, counts) -> DataFrame:
    """Pairs, about to match, of the members (key, h, root, n, main) of a prefix shingle, those
    outside its main component in blocks against all members in blocks."""
    outside = F.col("root") != F.col("main")
    sizes = crowded.groupBy("key").agg(F.count_if(outside).alias("k"))
    crowded = crowded.join(sizes, "key").select("key", "h", "root", outside.alias("out"), F.ceil(F.col("k") / BLOCK).cast("int").alias("qs"), F.ceil(F.col("n") / OTHERS).cast("int").alias("rs"))
    own_q, own_r = F.pmod(F.xxhash64("h"), F.col("qs")).cast("int"), F.pmod(F.xxhash64("h", "key"), F.col("rs")).cast("int")
    mine = crowded.where("out").select("key", "h", "root", F.lit(True).alias("first"), own_q.alias("q"), F.explode(F.sequence(F.lit(0), F.col("rs") - 1)).alias("r"))
    others = crowded.select("key", "h", "root", F.lit(False).alias("first"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), own_r.alias("r"))
    dealt = mine.unionByName(others).join(held.select("h", "held"), "h")

    def run(group: pa.Table) -> pa.Table:
        key = np.uint32(group.column("key")[0].as_py())
        first = group.column("first").to_numpy()
        h, root = group.column("h").to_pylist(), group.column("root").to_pylist()
        held = [np.frombuffer(x, "<u4") for x in group.column("held").to_pylist()]
        n = np.array([len(x) for x in held])
        roots = np.unique(np.array([r.hex() for r in root]), return_inverse=True)[1]
        bins = sketches([sketch(x) for x in held])
        # A pair is met at its first common shingle: bits of the members' earlier ones, where two have them.
        earlier = [x[: np.flatnonzero(x == key)[0]] for x in (prefix(x, counts.value) for x in held)]
        found, place, many = np.unique(np.concatenate([*earlier, np.zeros(0, np.uint32)]), return_inverse=True, return_counts=True)
        column = np.cumsum(many > 1) - 1
        member = np.repeat(np.arange(len(held)), [len(x) for x in earlier])
        shared = many[place] > 1
        before = np.zeros((len(held), int((many > 1).sum())), bool)
        before[member[shared], column[place[shared]]] = True
        before = np.packbits(before, axis=1)
        right, links = np.flatnonzero(~first), []
        for i in np.flatnonzero(first):
            js = right[(roots[right] != roots[i]) & (np.minimum(n[i], n[right]) >= SIMILARITY * np.maximum(n[i], n[right]))]
            js = js[~(before[i] & before[js]).any(axis=1)]
            js = js[likely(bins[i], bins[js], n[i], n[js])]
            links += [sorted((h[i], h[j])) for j in js if nearly_same(held[i], held[j])]
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([x for _, x in links], pa.binary())})

    return dealt.groupBy("key", "q", "r").applyInArrow(run, "a binary, b binary")


def _links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) among the members of buckets."""
    known = stored(_verified(_near_centres(members), texts), "omh-verified")
    roots = stored(components(known.where("ok").select("a", "b")), "omh-roots")
    left = stored(_open(members.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))), "omh-left")
    more = stored(_small_pairs(left).join(known, ["a", "b"], "left_anti"), "omh-pairs")
    found = stored(_verified(more, texts).where("ok").select("a", "b"), "omh-small")
    return known.where("ok").select("a", "b").unionByName(found).unionByName(_prefix_links(left, texts))


def components(edges: DataFrame) -> DataFrame:
    """(h, root) for each end of an edge (a, b): root is the smallest of its
    component. Alternates large-star and small-star steps, each a grouped
    minimum joined back, until every component is a star around its root."""
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while True:
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        low = edges.unionByName(larger).groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("n"), F.bool_or(F.col("v") > F.col("u")).alias("also")
        )
        low = stored(low, "cc-low")
        if low.where("n > 1 OR (n > 0 AND also)").isEmpty():
            return low.select(F.col("u").alias("h"), F.col("m").alias("root"))
        low = low.select("u", "m")
        large = larger.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u != v"), "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"), F.col("u").alias("x"))
        small = small.select("u", "v").unionByName(small.select(F.col("x").alias("u"), "v")).where("u != v").distinct()
        edges = stored(small, "cc")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, fp (md5 of its text), class_id
    (smallest doc_id of its class) and class_fp (the fp of the class's first
    row by doc_id, fp)."""
    with scoped_conf(docs.sparkSession, SMALL_BATCHES):
        sketched = stored(_sketched(docs), "omh-sketch")
    texts_of = sketched.groupBy("h", "n_words").agg(F.min("fp").alias("fp"), F.min_by("sigs", "fp").alias("sigs"), F.min_by("bins", "fp").alias("bins"))
    texts_of = stored(texts_of, "omh-distinct")
    rows = stored(texts_of.select("h", "n_words", F.posexplode("sigs").alias("band", "sig")).where("n_words > 0"), "omh-rows")
    shared = rows.groupBy("band", "sig").agg(F.count("*").alias("n")).where("n > 1")
    members = rows.join(shared, ["band", "sig"])
    members = stored(members.join(texts_of.select("h", "bins"), "h"), "omh-members")
    wanted = texts_of.join(members.select("h").distinct(), "h", "left_semi").select("fp", "h")
    raw = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("fp"), "text")
    texts = stored(raw.join(wanted, "fp").dropDuplicates(["h"]).select("h", "text"), "omh-texts")
    with scoped_conf(docs.sparkSession, SMALL_BATCHES):
        roots = stored(components(_links(members, texts)), "omh-roots")
    keyed = attach(sketched.select("doc_id", "fp", "h"), roots, ["h"], roots.count(), 100, F.xxhash64("doc_id", "fp"))
    keyed = keyed.select("doc_id", "fp", F.coalesce("root", "h").alias("cls"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("first")
    classes = stored(keyed.groupBy("cls").agg(first, F.count("*").alias("n")).where("n > 1").drop("n"), "omh-classes")
    named = attach(keyed, classes, ["cls"], classes.count(), 150, F.xxhash64("doc_id", "fp"))
    alone = F.col("first").isNull()
    return named.select(
        "doc_id",
        "fp",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.col("fp")).otherwise(F.col("first.fp")).alias("class_fp"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they were, one of each class: its first by
    (doc_id, fp); of repeated rows of that, one."""
    keep = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("fp") == F.col("class_fp")))
    keep = keep.groupBy("doc_id", "fp").agg(F.count("*").alias("n"))
    # Whole rows in one column: no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    md5 = F.md5(F.coalesce(F.col("row.text"), F.lit("")))
    met = rows.join(keep, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (md5 == F.col("fp")))
    once = met.where("n = 1").select("row.*")
    # Repeated rows: partial minima first, so that no task gathers them.
    many = met.where("n > 1").groupBy("doc_id", "fp").agg(F.any_value("row").alias("row")).select("row.*")
    return once.unionByName(many)
