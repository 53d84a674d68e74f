"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion (collected, or written to the no-op sink when its
result has many rows) after one untimed warm-up of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trisk.operators import triangles as TR  # noqa: E402
from trisk.plans import catalog as C  # noqa: E402
from trisk.plans import params as PR  # noqa: E402
from trisk.plans.catalog import QUERIES  # noqa: E402
from trisk.session import local_session  # noqa: E402

HEADLINE = [
    "edges_canonical",
    "triangles_exact",
    "triangles_color_median",
    "triangles_partition_estimate",
    "triangles_exact_colored",
    "triangle_report",
    "sketch_report",
    "sketch_tradeoff",
    "batch_partials_merge",
    "stream_histogram",
    "stream_sketch_cells",
    "stream_distinct",
    "stream_prefix_cutoff",
]
WIDE = {"edges_canonical"}
TIMED_RUNS = 3


def run(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    if name in WIDE:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 4 * int(cpus)))))
    spark = local_session(cpus, shuffle_partitions=parts, app="trisk-bench")
    only = sys.argv[1:] or HEADLINE
    run(spark, "triangles_exact", sf_dir)  # warm-up, untimed
    times = {}
    for name in only:
        t0 = time.perf_counter()
        run(spark, name, sf_dir)
        times[name] = round(time.perf_counter() - t0, 3)
    # The programs also print mean times over R runs: the colour estimate, and the exact count by
    # colour triples, one run per colouring on lists prepared once.
    lists = TR.prepare(C._graph(spark, sf_dir))
    means = {}
    for name, count in (("color_estimate", lambda ab: TR.color_estimates(lists, [ab], PR.COLORS, PR.P)),
                        ("exact_by_triples", lambda ab: TR.exact_by_color_triples(lists, *ab, PR.COLORS, PR.P))):
        runs = TR.timed_runs(count, PR.color_params()[:TIMED_RUNS])
        means[name] = {"elapsed_ms": [r.elapsed_ms for r in runs.orderBy("run").collect()],
                       **TR.timing_report(runs).first().asDict()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "shuffle_partitions": parts, "mean_over_runs": means}))


if __name__ == "__main__":
    main()
