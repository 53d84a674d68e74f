"""Fixed parameters of the registered queries (shared by the Spark side and the SQL oracle)."""

from __future__ import annotations

from trisk.functions.hashing import DEFAULT_PRIME, draw_color_params, draw_partition_params, draw_sketch_rows

P = DEFAULT_PRIME
SEED = 0

# graph programs
COLORS = 4
RUNS = 9

# stream programs: items are events.user_id, cut into batches of 1,250 events; the interval
# is that of interval_items and the reports, everything else covers all items
DEPTH = 5
WIDTH = 1000
LEFT = 10
RIGHT = 100
TOP_K = 20
THRESHOLD = 5000
BATCH_ROWS = 1250
# micro-batches that the streams get the table in
MICRO_BATCHES = 8

# space-accuracy grid, over lineitem.l_partkey
TRADEOFF_GRID = [(1, 50), (3, 50), (5, 50), (1, 200), (3, 200), (5, 200),
                 (1, 1000), (3, 1000), (5, 1000), (7, 1000), (4, 1000)]


def color_params() -> list[tuple[int, int]]:
    return draw_color_params(RUNS, SEED, P)


def partition_params() -> tuple[int, int]:
    return draw_partition_params(SEED, P)


def sketch_rows(depth: int = DEPTH):
    return draw_sketch_rows(depth, SEED, P)
