"""Headline timings.

Runs the main workloads on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line. Each workload is timed
from the call that builds it to the end of a full write of its result to
the ``noop`` sink, so graph derivation, layout, every traversal round and
the final result are all inside the timing. A warm-up pass on smaller
tables (not timed) keeps JVM start-up and JIT compilation out of the figures.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from hopscope.operators.summary import longest_shortest_path  # noqa: E402
from hopscope.workloads import (  # noqa: E402
    q_bounded_dense,
    q_mssp16,
    q_mssp_dense,
    q_sampled_adjacency,
    q_sampled_diameter,
)


def q_lsp_summary(spark, sf_dir):
    return longest_shortest_path(q_mssp_dense(spark, sf_dir))


BENCH = {
    "sampled_adjacency": q_sampled_adjacency,
    "mssp2": q_mssp_dense,
    "mssp16": q_mssp16,
    "bounded20": q_bounded_dense,
    "lsp_summary": q_lsp_summary,
    "sampled_diameter": q_sampled_diameter,
}


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hopscope-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hopscope-bench-"))
    return spark


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    # Untimed warm-up: every workload once on smaller tables, so the timings
    # below measure steady-state work rather than JVM class loading and JIT.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm):
        for fn in BENCH.values():
            run(spark, fn, warm)
    times = {name: round(run(spark, fn, sf_dir), 3) for name, fn in BENCH.items()}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
