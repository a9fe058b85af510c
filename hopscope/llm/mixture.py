"""Mixing sources to target weights, in DataFrame functions only.

Sizes are words. Sources, by code point with null last, weigh 5, 2, 1,
repeating; their targets share the total of all sizes by weight, none above
``CAP`` times its source's size, the excess shared again by weight.

A source's documents are dealt by a hash into blocks: disjoint, random, in
random order. A target asks for whole passes over all blocks and a last pass
over the first blocks, whose end is cut inside one block so that the words come
near the target. The number of drawn blocks is each source's quota. A splitting
tree halves the output shards again and again; at each node the quotas go left
and right by a multivariate hypergeometric draw, so that every shard gets an
exact, fair share. Each shard then takes the next blocks of every source's
shuffled draws, and its documents are shuffled within it.

There are ``SHARD_BLOCKS`` blocks a shard, ``BLOCKS`` at least, and one more for
each source. Only sums per source and per block are ever brought together;
documents are met by a broadcast of checked size or a salted join. All draws hash ids, texts and the seed, so reruns agree.

Defined results: a null text has size 0 and is never drawn; null ids, repeated
ids and ties are told apart by text; repeated rows share a hash, so they are
drawn alike; a null source is a source of its own; an empty table gives no
rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hopscope.llm.common import WORD, attach, stored

WEIGHTS = (5, 2, 1)
CAP = 3
#: Fewest blocks of all sources together, and blocks for each output shard.
BLOCKS = 4096
SHARD_BLOCKS = 8
#: Words of an output shard.
SHARD_WORDS = 4_000_000
SEED = 20


def _with_keys(docs: DataFrame, seed: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "__size": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "__key": F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), text), 1),
        }
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target. The sources at
    their cap are the first in the order of cap per weight; the rest share what
    is left by weight."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    full = F.col("source_size") * F.lit(float(cap))
    ranked = sizes.withColumn("weight", weight).withColumn("full", full)
    w = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    open_ = F.when(F.col("full") >= F.col("share") * F.col("weight"), F.col("share"))
    level = F.coalesce(F.max("open").over(everything), F.lit(float("inf")))
    return (
        ranked.withColumn("share", share)
        .withColumn("open", open_)
        .withColumn("target", F.when(F.col("full") == 0, F.lit(0.0)).otherwise(F.least("full", level * F.col("weight"))))
        .drop("weight", "full", "share", "open")
    )


def _block(key: Column, blocks: Column) -> Column:
    return F.least(F.floor(key / F.lit(float(1 << 63)) * blocks), blocks - 1)


def _cut(slim: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """sources with: passes; last (block in which the last pass ends, null if
    there is none); upto (largest key that it takes there); extra (further keys
    that fill what is left)."""
    plan = sources.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = stored(plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-plan")
    dealt = attach(slim.where("size > 0"), plan.select("source", "blocks", "rest"), ["source"], n_sources, 200, F.col("key"))
    dealt = dealt.withColumn("block", _block(F.col("key"), F.col("blocks")))
    sums = dealt.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("block"))
    ends = sums.withColumn("upper", running).withColumn("room", F.col("rest") - (F.col("upper") - F.col("words")))
    ends = stored(ends.where("room > 0 AND upper > rest").select("source", F.col("block").alias("last"), "room"), "mix-ends")
    inside = attach(dealt.select("source", "block", "key", "size"), ends, ["source"], n_sources, 200, F.col("key")).where("block = last")
    # Read three times below; unstored, each would bring all joins above into the plan again.
    units = stored(inside.groupBy("source", "last", "room", "key").agg(F.sum("size").alias("size")), "mix-units")
    upper = F.sum("size").over(Window.partitionBy("source").orderBy("key"))
    units = units.withColumn("gap", F.col("room") - upper)
    head = units.where("gap >= 0").groupBy("source").agg(F.max("key").alias("upto"), F.min("gap").alias("gap"))
    tail = attach(units.where("gap < 0").drop("gap"), head, ["source"], n_sources, 100, F.col("key"))
    tail = tail.withColumn("gap", F.coalesce("gap", "room")).where("size <= gap")
    step = lambda acc, x: F.when(x["size"] <= acc["gap"], F.struct((acc["gap"] - x["size"]).alias("gap"), F.concat(acc["keys"], F.array(x["key"])).alias("keys"))).otherwise(acc)
    fill = F.aggregate(
        F.sort_array(F.collect_list(F.struct("size", "key")), asc=False),
        F.struct(F.first("gap").alias("gap"), F.array().cast("array<long>").alias("keys")),
        step,
        lambda acc: acc["keys"],
    )
    extra = tail.groupBy("source").agg(fill.alias("extra"))
    for more in (ends.select("source", "last"), head.select("source", "upto"), extra):
        plan = attach(plan, more, ["source"], n_sources, 200)
    return stored(plan, "mix-cut")


def _shards(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, shard, n): each source's quota of blocks dealt among the shards."""
    quota = F.col("passes") * F.col("blocks") + F.coalesce(F.col("last") + 1, F.lit(0))
    nodes = plan.select("source", quota.alias("n"), F.lit(0).alias("lo"), F.lit(shards).alias("hi")).where("n > 0")
    while shards > 1:
        arr = F.sort_array(F.collect_list(F.struct(F.coalesce(F.xxhash64("source"), F.lit(0)).alias("order"), "source", "n")))
        halves = nodes.groupBy("lo", "hi").agg(arr.alias("quotas")).withColumn("mid", F.floor((F.col("lo") + F.col("hi") + 1) / 2).cast("int"))
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        left = F.floor(total * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))

        # Hypergeometric draws: each block of a source goes left with the chance of the slots that are left.
        def draw(acc, q):
            chance = lambda i: F.pmod(F.xxhash64(F.lit(seed), F.col("lo"), F.col("hi"), q["source"], i), F.lit(1 << 52)) / float(1 << 52)
            goes = lambda a, i: (chance(i) * a["all"] < a["slots"]).cast("long")
            one = lambda a, i: F.struct((a["all"] - 1).alias("all"), (a["slots"] - goes(a, i)).alias("slots"))
            after = F.aggregate(F.sequence(F.lit(1).cast("long"), q["n"]), F.struct(acc["all"].alias("all"), acc["slots"].alias("slots")), one)
            return F.struct(after["all"].alias("all"), after["slots"].alias("slots"), F.concat(acc["out"], F.array(after["slots"])).alias("out"))

        start = F.struct(total.alias("all"), left.alias("slots"), F.array(left).alias("out"))
        split = halves.withColumn("slots", F.aggregate("quotas", start, draw, lambda a: a["out"]))
        each = split.select("lo", "hi", "mid", "slots", F.posexplode("quotas").alias("i", "q"))
        each = each.withColumn("l", F.get("slots", F.col("i")) - F.get("slots", F.col("i") + 1))
        done = each.where("hi - lo = 1").select("q.source", "q.n", "lo", "hi")
        rest = each.where("hi - lo > 1")
        nodes = done.unionByName(rest.select("q.source", F.col("l").alias("n"), "lo", F.col("mid").alias("hi"))).unionByName(
            rest.select("q.source", (F.col("q.n") - F.col("l")).alias("n"), F.col("mid").alias("lo"), "hi")
        )
        nodes = stored(nodes.where("n > 0"), "mix-tree")
        shards = (shards + 1) // 2
    return nodes.select("source", F.col("lo").alias("shard"), "n")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The documents, all columns as they were, with ``__size``, ``__source_size``,
    ``__target``, ``__key`` and ``__shards``: the shard of each copy that the
    mix takes (none: empty)."""
    keyed = _with_keys(docs, seed)
    slim = stored(keyed.select("source", F.col("__size").alias("size"), F.col("__key").alias("key")), "mix-sizes")
    sums = stored(slim.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    told = sums.agg(F.sum("source_size"), F.count("*")).first()
    total, n_sources = told[0] or 0, told[1]
    shards = max(1, -(-total // shard_words))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(max(1.0, total / max(BLOCKS, SHARD_BLOCKS * shards))))).cast("long")
    plan = _cut(slim, targets(sums, weights, cap).withColumn("blocks", blocks), n_sources)
    dealt = stored(_shards(plan, shards, seed), "mix-dealt")
    offset = F.sum("n").over(Window.partitionBy("source").orderBy("shard")) - F.col("n")
    slots = dealt.withColumn("from", offset).select("source", "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("j"))
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))
    drawn = plan.select("source", "passes", "blocks", "last", passes.alias("pass"))
    upto = F.when(F.col("pass") < F.col("passes"), F.col("blocks") - 1).otherwise(F.col("last"))
    drawn = drawn.where(upto.isNotNull()).select("source", "pass", F.explode(F.sequence(F.lit(0).cast("long"), upto)).alias("block"))
    mixed = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "pass", "block"), "pass", "block")
    drawn = drawn.withColumn("j", (F.row_number().over(mixed) - 1).cast("long"))
    slots = slots.select(F.col("source").alias("s"), F.col("j").alias("k"), "shard")
    drawn = drawn.join(slots, drawn["source"].eqNullSafe(slots["s"]) & (drawn["j"] == slots["k"]))
    where = stored(drawn.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws")), "mix-draws")

    table = plan.select(*[F.col(c).alias("source" if c == "source" else f"__{c}") for c in ("source", "source_size", "target", "passes", "blocks", "last", "upto", "extra")])
    out = attach(keyed, table, ["source"], n_sources, 400, F.col("__key"))
    out = out.withColumn("__block", _block(F.col("__key"), F.col("__blocks")))
    out = attach(out, where.select("source", F.col("block").alias("__block"), F.col("draws").alias("__draws")), ["source", "__block"], where.count(), 200, F.col("__key"))
    block, last, key = F.col("__block"), F.col("__last"), F.col("__key")
    partial = F.coalesce((block < last) | ((block == last) & (F.coalesce(key <= F.col("__upto"), F.lit(False)) | F.coalesce(F.array_contains("__extra", key), F.lit(False)))), F.lit(False))
    taken = F.filter("__draws", lambda d: (d["pass"] < F.col("__passes")) | partial)
    copies = F.when((F.col("__size") > 0) & F.col("__draws").isNotNull(), F.transform(taken, lambda d: d["shard"])).otherwise(F.array().cast("array<int>"))
    return out.withColumn("__shards", copies).drop("__passes", "__blocks", "__last", "__upto", "__extra", "__block", "__draws")


def mix(docs: DataFrame, shard_column: str | None = None, **options) -> DataFrame:
    """The mix: a row for each copy that it takes, all columns as they were, a
    shard's rows together and shuffled. ``shard_column`` adds its number."""
    seed = options.get("seed", SEED)
    # Whole rows in one column: no name of theirs can clash.
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = plan_mix(packed, **options).select("row", "__key", F.posexplode("__shards").alias("__copy", "__shard"))
    rows = rows.repartition("__shard").sortWithinPartitions("__shard", F.xxhash64(F.lit(seed + 1), "__key", "__copy"))
    return rows.select("row.*", *([F.col("__shard").alias(shard_column)] if shard_column else []))
