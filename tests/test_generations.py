"""Rounds kept as generations: taken up by another session, merged, summed up."""

import pytest
from pyspark.sql import SparkSession

import hopscope as hs
import hopscope.plans.generations as gen
from hopscope.plans.files import Folder
from hopscope.plans.generations import open_generation, stored_longest_paths, tail_to_merge
from tests.conftest import edges_df, rows
from tests.test_properties import bfs, random_graph


def graph(spark, e):
    return hs.prepare_graph(edges_df(spark, e), partitions=2)


def lsp(found):
    return {r["source"]: r["lsp"] for r in found.collect()}


@pytest.mark.parametrize("absorbing", [False, True])
def test_killed_after_three_rounds_and_taken_up_elsewhere(spark, scratch, absorbing, monkeypatch):
    e = [(i, i + 1) for i in range(12)] + random_graph(3, n=30, m=25, hubs=0)
    srcs = ["0", "4", "20"]
    whole = hs.shortest_paths(graph(spark, e), srcs, stop_at_other_sources=absorbing)
    append, calls = gen.GenerationLog.append, []

    def killed(self, *args, **told):
        calls.append(args)
        if len(calls) == 5:  # the seeds and three rounds are committed
            raise KeyboardInterrupt
        append(self, *args, **told)

    monkeypatch.setattr(gen.GenerationLog, "append", killed)
    with pytest.raises(KeyboardInterrupt):
        hs.shortest_paths(graph(spark, e), srcs, stop_at_other_sources=absorbing, log=f"{scratch}/log")
    monkeypatch.undo()
    other = spark.newSession()
    assert isinstance(other, SparkSession)
    kept = open_generation(other, f"{scratch}/log")
    assert kept.rounds == 3 and not kept.converged and kept.stats == whole.stats[:3]
    t = hs.continue_paths(graph(other, e), f"{scratch}/log")
    assert rows(t.distances) == rows(whole.distances) and t.stats == whole.stats and t.converged
    done = open_generation(spark, f"{scratch}/log")
    assert done.converged and rows(done.state()) == rows(whole.distances)
    again = hs.continue_paths(graph(spark, e), f"{scratch}/log")
    assert again.stats == whole.stats and rows(again.distances) == rows(whole.distances)


def test_a_round_that_broke_off_leaves_nothing(spark, scratch):
    e = [(i, i + 1) for i in range(6)]
    hs.shortest_paths(graph(spark, e), ["0"], max_rounds=2, log=f"{scratch}/log")
    folder = Folder(spark, f"{scratch}/log")
    spark.range(3).write.parquet(folder.uri("layers/broken-off"))
    before = rows(open_generation(spark, f"{scratch}/log").state())
    assert before == [("0", "0", 0), ("0", "1", 1), ("0", "2", 2)]
    hs.continue_paths(graph(spark, e), f"{scratch}/log", max_rounds=3)
    assert not folder.exists("layers/broken-off")
    hs.bounded_relaxation(graph(spark, e), ["3"], log=f"{scratch}/log")  # a new traversal clears the folder
    assert rows(open_generation(spark, f"{scratch}/log").state()) == bfs(e, ["3"], seeds_at_in_neighbours=True)
    with pytest.raises(FileNotFoundError):
        open_generation(spark, f"{scratch}/none")


def test_files_stay_few_over_forty_rounds(spark, scratch):
    e = [(i, i + 1) for i in range(45)]
    g = graph(spark, e)
    counts = []
    for stop in (15, 27, 40, None):
        t = hs.shortest_paths(g, ["0"], max_rounds=stop, log=f"{scratch}/log") if not counts else hs.continue_paths(g, f"{scratch}/log", max_rounds=stop)
        folder = Folder(spark, f"{scratch}/log")
        assert len([n for n in folder.names() if n.startswith("generation")]) == 2
        counts.append(len(Folder(spark, folder.uri("layers")).names()))
    assert max(counts) <= gen.MAX_LAYERS + 2
    assert rows(t.distances) == bfs(e, ["0"]) and t.rounds == 46


def test_a_row_is_rewritten_a_logarithmic_number_of_times(spark):
    e = [(i, i + 1) for i in range(90)]
    t = hs.shortest_paths(graph(spark, e), ["0"])
    assert rows(t.distances) == bfs(e, ["0"])
    assert t.rows_rewritten <= 91 * 5  # merging all layers every eighth round writes over 500 rows again


def test_layers_to_merge():
    assert tail_to_merge([5, 1, 1], 3) == 3
    assert tail_to_merge([100, 1, 1, 1], 3) == 1
    assert tail_to_merge([3, 1, 1, 1], 3) == 0
    assert tail_to_merge([1000, 100, 10, 1], 3) == 2
    sizes, written = [], 0
    for _ in range(5000):
        sizes.append(1)
        at = tail_to_merge(sizes, 8)
        if at < len(sizes):
            written += sum(sizes[at:])
            sizes[at:] = [sum(sizes[at:])]
        assert len(sizes) <= 8
    assert written < 5000 * 14


@pytest.mark.parametrize("listed", [1000, 1])
def test_summary_from_the_record_or_the_sums(spark, scratch, monkeypatch, listed):
    monkeypatch.setattr(gen, "LISTED", listed)
    e = [(i, i + 1) for i in range(30)] + [(3, 20), (7, 7)]
    t = hs.shortest_paths(graph(spark, e), ["0", "3", "30"], log=f"{scratch}/log")
    found = stored_longest_paths(spark, f"{scratch}/log")
    assert lsp(found) == lsp(hs.longest_shortest_path(t.distances))
    assert not any("/layers/" in f for f in found.inputFiles())
    assert t.distances.count() == open_generation(spark, f"{scratch}/log").state().count()
