"""Adjacency lists are made in tasks of a counted size."""

import hopscope.operators.adjacency as adj
from hopscope.sources import line_writer
from hopscope.sources.line_writer import write_adjacency_lines
from tests.conftest import edges_df


def test_tasks_follow_the_neighbours(spark, scratch, monkeypatch):
    monkeypatch.setattr(adj, "PER_TASK", 20)
    monkeypatch.setattr(line_writer, "PER_TASK", 20)
    e = [(i, j) for i in range(40) for j in range(100, 100 + i)]
    made = adj.to_adjacency(edges_df(spark, e), max_list=8)
    assert made.rdd.getNumPartitions() >= len(e) // 20
    write_adjacency_lines(made, f"{scratch}/lines")
    lines = spark.read.text(f"{scratch}/lines")
    want = sorted(f"{i}\t" + ",".join(str(j) for j in range(100, 100 + i)) for i in range(1, 40))
    assert sorted(r["value"] for r in lines.collect()) == want
    assert len(lines.inputFiles()) > 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
