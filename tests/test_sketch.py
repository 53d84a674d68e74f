import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trisk.functions.hashing import draw_sketch_rows
from trisk.operators import sketch as S

ITEMS = [5, 5, 5, 5, 2, 2, 9, 9, 7, 1]


def items_df(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "item bigint")


def interval_hist(spark, xs, left, right):
    return S.histogram(items_df(spark, xs).where(S.in_interval(F.col("item"), left, right)))


def test_small_sketch_fixture_full_interval(spark):
    hist = interval_hist(spark, ITEMS, 0, 10)
    cells = {(r.row, r.col): r.c for r in S.sketch_cells(hist, 3, 4).collect()}
    assert cells == {(0, 0): -1, (0, 1): 1, (0, 2): 0, (0, 3): 4, (1, 0): -1, (1, 1): 2,
                     (1, 2): -1, (1, 3): 4, (2, 1): 2, (2, 2): 2, (2, 3): 0}
    est = {r.item: r.est for r in S.estimates(hist, S.sketch_cells(hist, 3, 4), 3, 4).collect()}
    assert est == {1: 0, 2: 0, 5: 4, 7: 1, 9: 2}
    rep = S.sketch_report(items_df(spark, ITEMS), 3, 4, 0, 10, 2).first()
    assert rep.items == 10 and rep.items_in_interval == 10 and rep.distinct_in_interval == 5
    assert rep.f2 == pytest.approx(0.26) and rep.f2_sketch == pytest.approx(0.18)
    assert rep.avg_error == pytest.approx(0.5)
    top = S.top_k_estimates(hist, S.sketch_cells(hist, 3, 4), 2, 3, 4).orderBy("rank").collect()
    assert [t.item for t in top] == [5, 2]


def test_small_sketch_fixture_sub_interval(spark):
    hist = interval_hist(spark, ITEMS, 2, 7)
    cells = {(r.row, r.col): r.c for r in S.sketch_cells(hist, 3, 4).collect()}
    assert cells == {(0, 1): 1, (0, 2): -2, (0, 3): 4, (1, 0): -1, (1, 2): -2, (1, 3): 4,
                     (2, 2): 2, (2, 3): 1}
    rep = S.sketch_report(items_df(spark, ITEMS), 3, 4, 2, 7, 2).first()
    assert rep.items == 10 and rep.items_in_interval == 7
    assert rep.f2 == pytest.approx(3 / 7) and rep.f2_sketch == pytest.approx(3 / 7)
    assert rep.avg_error == pytest.approx(0.0)


def test_empty_interval_gives_nulls(spark):
    rep = S.sketch_report(items_df(spark, ITEMS), 3, 4, 100, 200, 2).first()
    assert rep.items == 10 and rep.items_in_interval == 0 and rep.distinct_in_interval == 0
    assert rep.f2 is None and rep.f2_sketch is None and rep.avg_error is None


def brute(xs, D, W, K, p=8191):
    rows = draw_sketch_rows(D, 0, p)
    hist = {}
    for x in xs:
        hist[x] = hist.get(x, 0) + 1
    C = {}
    for x, f in hist.items():
        for r in rows:
            h = ((r.ah * x + r.bh) % p) % W
            g = -1 if ((r.ag * x + r.bg) % p) % 2 == 0 else 1
            C[(r.row, h)] = C.get((r.row, h), 0) + g * f
    est = {}
    for x in hist:
        vals = []
        for r in rows:
            h = ((r.ah * x + r.bh) % p) % W
            g = -1 if ((r.ag * x + r.bg) % p) % 2 == 0 else 1
            vals.append(g * C[(r.row, h)])
        est[x] = int(np.median(vals))
    n = len(xs)
    f2 = sum(f * f for f in hist.values()) / n ** 2
    f2s = float(np.median([sum(v * v for (j, _), v in C.items() if j == r.row) for r in rows])) / n ** 2
    top = sorted(hist.items(), key=lambda kv: (-kv[1], kv[0]))[:K]
    err = float(np.mean([abs(f - est[x]) / f for x, f in top]))
    return C, est, f2, f2s, err


@pytest.mark.parametrize("D,W", [(1, 7), (4, 16), (5, 50)])
def test_against_brute_force(spark, D, W):
    rng = random.Random(D * 100 + W)
    xs = [int(rng.paretovariate(1.2)) - 40 for _ in range(3000)]
    C, est, f2, f2s, err = brute(xs, D, W, 10)
    hist = S.histogram(items_df(spark, xs))
    cells = S.sketch_cells(hist, D, W)
    assert {(r.row, r.col): r.c for r in cells.collect()} == C
    assert {r.item: r.est for r in S.estimates(hist, cells, D, W).collect()} == est
    rep = S.report_from_histogram(hist, spark.range(1).select(F.lit(len(xs)).alias("items")),
                                  D, W, -10**9, 10**9, 10).first()
    assert rep.f2 == pytest.approx(f2) and rep.f2_sketch == pytest.approx(f2s)
    assert rep.avg_error == pytest.approx(err)


def test_sketch_is_linear_and_row_sums_are_signed_counts(spark):
    rng = random.Random(5)
    a = [rng.randrange(200) for _ in range(800)]
    b = [rng.randrange(200) for _ in range(500)]
    ca = S.sketch_cells(S.histogram(items_df(spark, a)), 3, 20)
    cb = S.sketch_cells(S.histogram(items_df(spark, b)), 3, 20)
    cab = S.sketch_cells(S.histogram(items_df(spark, a + b)), 3, 20)
    merged = ca.unionByName(cb).groupBy("row", "col").agg(F.sum("c").alias("c"))
    assert sorted(merged.collect()) == sorted(cab.collect())
    # D=1, W=1: the single cell is the signed item count
    one = S.sketch_cells(S.histogram(items_df(spark, a)), 1, 1).first()
    r = draw_sketch_rows(1)[0]
    assert one.c == sum(-1 if ((r.ag * x + r.bg) % 8191) % 2 == 0 else 1 for x in a)


def test_tradeoff_matches_single_reports(spark):
    rng = random.Random(9)
    xs = [int(rng.paretovariate(1.1)) for _ in range(2000)]
    hist = S.histogram(items_df(spark, xs))
    grid = [(1, 10), (3, 30), (4, 100)]
    got = {(r.d, r.w): r for r in S.tradeoff(hist, grid, 5).collect()}
    for d, w in grid:
        _, _, f2, f2s, err = brute(xs, d, w, 5)
        assert got[(d, w)].f2 == pytest.approx(f2)
        assert got[(d, w)].f2_sketch == pytest.approx(f2s)
        assert got[(d, w)].avg_error == pytest.approx(err)


def test_parameters_must_be_positive(spark):
    hist = S.histogram(items_df(spark, ITEMS))
    for bad in [dict(depth=0, width=4), dict(depth=2, width=0)]:
        with pytest.raises(ValueError):
            S.sketch_cells(hist, bad["depth"], bad["width"])
    with pytest.raises(ValueError):
        S.top_k(hist, 0)


def test_second_moment_of_very_large_counts(spark):
    """Four items of 10^9 and one of 3.2 * 10^9: squares and their sums leave BIGINT."""
    rows = [(k, 10**9) for k in range(4)] + [(9, 3_200_000_000)]
    hist = spark.createDataFrame(rows, "item bigint, freq bigint")
    n = sum(f for _, f in rows)
    want = sum(f * f for _, f in rows) / (n * n)
    exact = S.f2_exact(hist).first()
    assert exact.items == n and abs(exact.f2 - want) < 1e-12
    cells = S.sketch_cells(hist, 3, 1000)
    sums = {}
    for r in cells.collect():
        sums[r.row] = sums.get(r.row, 0) + r.c * r.c
    median = sorted(sums.values())[1] / (n * n)
    assert abs(S.f2_sketch(cells, S.f2_exact(hist).select("items")).first().f2_sketch - median) < 1e-12
    grid = S.tradeoff(hist, [(3, 1000)], 5).first()
    assert abs(grid.f2 - want) < 1e-12 and abs(grid.f2_sketch - median) < 1e-12
    report = S.report_from_histogram(hist, S.f2_exact(hist).select("items"), 3, 1000, 0, 10, 5).first()
    assert abs(report.f2 - want) < 1e-12


def test_folded_widths_equal_their_own_cells(spark):
    hist = S.histogram(spark.createDataFrame([(x * x % 997,) for x in range(3000)], "item bigint"))
    grid = [(3, 12), (3, 24), (3, 6), (3, 9), (2, 24), (2, 5)]
    assert S._base_configs(grid) == {1: [1, 0, 2], 4: [4], 3: [3], 5: [5]}
    base = None
    for i in S._base_configs(grid):
        cells = S.sketch_cells(hist, *grid[i]).selectExpr(f"{i} AS cfg", "row", "col", "c")
        base = cells if base is None else base.unionByName(cells)
    folded = {}
    for r in S.fold_cells(base, grid).collect():
        folded.setdefault(r.cfg, {})[r.row, r.col] = r.c
    for i, (d, w) in enumerate(grid):
        assert folded[i] == {(r.row, r.col): r.c for r in S.sketch_cells(hist, d, w).collect()}
