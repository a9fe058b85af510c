"""Rounds in which unreached vertices look for a parent.

On a dense round most out-edges of the frontier lead to vertices that were
reached before. Such a round can go the other way: each (source, vertex) not
reached yet looks among its in-edges for a vertex of the frontier. It does so in
two steps. First it looks at about ``PROBE`` of its in-edges, drawn by a hash;
only those that found no parent look at their other in-edges. So most in-edges
of a vertex that has a parent are never read out.

The direction follows counted edges. Each round's rows give, by one grouped sum,
the edges that leave them and the edges that enter them. A round goes bottom-up
if more edges leave the frontier than enter unreached vertices, the pairs
(source, unreached vertex) that have to be written first included. The rows are
the same either way.

The in-edges are laid out as the out-edges are: in-hubs salted, partitioned by
their target, never moved again. What moves are the unreached pairs and, unless
the frontier may be broadcast, the in-edges that are looked at; parents with many
out-edges are salted there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hopscope.functions.expressions import next_hop
from hopscope.plans.graph import HopGraph, salt_for
from hopscope.plans.session import fits_broadcast, materialize, row_bytes

#: In-edges of an unreached vertex that are looked at first, on average.
PROBE = 4


def _near(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df.sparkSession, rows, bytes_per_row) else df.hint("merge")


def _except(rows: DataFrame, reached: DataFrame) -> DataFrame:
    """The rows whose (source, vertex) is not among those reached."""
    r = reached.select(F.col("source").alias("r_source"), F.col("vertex").alias("r_vertex")).hint("merge")
    return rows.join(r, (rows["source"] == r["r_source"]) & (rows["vertex"] == r["r_vertex"]), "left_anti")


class BottomUp:
    """The counted edges of a traversal, and its unreached pairs once a round needs them.

    ``rounds``: (round, "down" or "up", candidates) of each round. A round that
    goes down makes as many candidates as edges leave its frontier, less those of
    sources that absorb; one that goes up as many as in-edges are looked at.
    """

    def __init__(self, graph: HopGraph, seeds: DataFrame, seed_rows: int, partitions: int):
        self.graph, self.partitions = graph, partitions
        # At most as many as the list of sources that was given.
        self.sources = [r["source"] for r in seeds.select("source").distinct().collect()]
        self.targets = graph.degrees().where("ins > 0").count()
        self.into = len(self.sources) * graph.num_edges
        self.leaving = 0
        self.open: DataFrame | None = None
        self.open_rows = 0
        self.layers: list[DataFrame] = []
        self.rounds: list[tuple[int, str, int]] = []
        self.reached(seeds, seed_rows)

    def reached(self, layer: DataFrame, rows: int) -> None:
        """Count the edges of a round's new rows."""
        met = layer.groupBy("vertex").agg(F.count(F.lit(1)).alias("n"))
        met = met.select(F.col("vertex").alias("m_vertex"), "n")
        both = self.graph.degrees().join(_near(met, rows, row_bytes(1, self.graph.max_id_length, fixed_cols=1)), F.col("vertex") == F.col("m_vertex"))
        sums = both.agg(F.sum(F.col("n") * F.col("outs")).alias("outs"), F.sum(F.col("n") * F.col("ins")).alias("ins")).first()
        self.leaving = int(sums["outs"] or 0)
        self.into -= int(sums["ins"] or 0)
        self.layers.append(layer)

    def pays(self) -> bool:
        written = 0 if self.open is not None else len(self.sources) * self.targets
        return self.leaving > self.into + written

    def _unreached(self) -> None:
        """Bring (source, vertex, ins) of the unreached pairs up to date."""
        rows = self.open
        if rows is None:
            sources = F.array(*[F.lit(s) for s in self.sources])
            rows = self.graph.degrees().where("ins > 0").select(F.explode(sources).alias("source"), "vertex", "ins")
            rows = rows.repartition(self.partitions, "source", "vertex").sortWithinPartitions("source", "vertex")
        for layer in self.layers:
            rows = _except(rows, layer)
        self.open, self.open_rows = materialize(rows)
        self.layers = []

    def _looked_at(self, rows: DataFrame, first: bool) -> DataFrame:
        """(source, vertex, parent) for the in-edges that are looked at in a step."""
        turned = self.graph.reversed()
        if turned.hot is not None:
            rows = rows.join(F.broadcast(turned.hot), F.col("vertex") == F.col("hot_vertex"), "left").select(
                "source", "vertex", "ins", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nsalt"), F.lit(1)) - 1)).alias("cell")
            )
        e = turned.aliased_edges()
        drawn = F.pmod(F.xxhash64("e.dst", "e.src"), F.col("ins"))
        on = (F.col("vertex") == F.col("e.src")) & (drawn < PROBE if first else drawn >= PROBE)
        if turned.hot is not None:
            on = on & (F.col("cell") == F.col("e.salt"))
        return rows.hint("merge").join(e, on).select("source", "vertex", F.col("e.dst").alias("parent"))

    def _found(self, rows: DataFrame, frontier: DataFrame, frontier_rows: int, first: bool) -> tuple[DataFrame, Observation]:
        """(source, vertex, dist) of the pairs that have a parent in the frontier."""
        counted = Observation()
        seen = self._looked_at(rows, first).observe(counted, F.count(F.lit(1)).alias("n"))
        f = frontier.select(F.col("source").alias("f_source"), F.col("vertex").alias("f_vertex"), F.col("dist").alias("f_dist"))
        on = (F.col("source") == F.col("f_source")) & (F.col("parent") == F.col("f_vertex"))
        width = row_bytes(2, self.graph.max_id_length, fixed_cols=1)
        if fits_broadcast(f.sparkSession, frontier_rows, width):
            met = seen.join(F.broadcast(f), on)
        else:
            if self.graph.hot is not None:
                hot = F.broadcast(self.graph.hot)
                salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nsalt"), F.lit(1)) - 1))
                f = f.join(hot, F.col("f_vertex") == F.col("hot_vertex"), "left").select("f_source", "f_vertex", "f_dist", salts.alias("f_salt"))
                seen = seen.join(hot, F.col("parent") == F.col("hot_vertex"), "left").select("source", "vertex", "parent", salt_for("vertex", "nsalt").alias("salt"))
                on = on & (F.col("salt") == F.col("f_salt"))
            met = seen.join(f.hint("merge"), on)
        dist: Column = F.min(next_hop(F.col("f_dist"))).cast("int").alias("dist")
        return met.groupBy("source", "vertex").agg(dist), counted

    def step(self, frontier: DataFrame, frontier_rows: int) -> tuple[DataFrame, list[Observation]]:
        """The new rows of a round, of which ``frontier`` expands, and what counts
        its candidates once the rows are computed."""
        self._unreached()
        hits, first = self._found(self.open, frontier, frontier_rows, True)
        hits, _ = materialize(hits)
        rest = _except(self.open.where(F.col("ins") > PROBE), hits)
        more, second = self._found(rest, frontier, frontier_rows, False)
        new = hits.unionByName(more).groupBy("source", "vertex").agg(F.min("dist").cast("int").alias("dist"))
        return new, [first, second]
