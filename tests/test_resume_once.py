"""What a resumed traversal reads is computed once."""

from pyspark.sql import functions as F

import hopscope as hs
from tests.conftest import edges_df, rows
from tests.test_properties import bfs


def test_the_stored_state_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def read(dist):
        seen.add(1)
        return dist

    e = [(i, i + 1) for i in range(6)]
    state = spark.createDataFrame([("0", "0", 0), ("0", "1", 1), ("0", "2", 2)], "source string, vertex string, dist int")
    state = state.select("source", "vertex", read.asNondeterministic()("dist").alias("dist"))
    t = hs.resume_shortest_paths(hs.prepare_graph(edges_df(spark, e)), state, sources=["0"])
    assert rows(t.distances) == bfs(e, ["0"])
    assert seen.value == 3
