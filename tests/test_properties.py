"""Property tests (hypothesis): random small graphs and item streams against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_graph import all_triangles
from tests.test_sketch import brute
from trisk.operators import graph as G
from trisk.operators import sketch as S
from trisk.operators import triangles as TR

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

edges = st.lists(st.tuples(st.integers(-20, 40), st.integers(-20, 40)), min_size=0, max_size=250)


@SETTINGS
@given(pairs=edges, a=st.integers(1, 8190), b=st.integers(0, 8190), colors=st.integers(1, 5),
       hot=st.sampled_from([1, 3, 1_000_000]))
def test_exact_counts_agree(spark, pairs, a, b, colors, hot):
    df = spark.createDataFrame(pairs, "src bigint, dst bigint")
    lists = TR.prepare(G.canonical_edges(df), hot_rows=hot)
    want = len(all_triangles(pairs))
    assert TR.exact_count(lists, hot_work=hot).first()["triangles"] == want
    assert TR.exact_by_color_triples(lists, a, b, colors).first()["triangles"] == want
    # one colour: every estimate is the exact count
    assert TR.color_estimates(lists, [(a, b)], 1).first()["estimate"] == want
    assert TR.partition_estimate(lists, 1).first()["estimate"] == want


@SETTINGS
@given(xs=st.lists(st.integers(-50, 50), min_size=1, max_size=400),
       depth=st.integers(1, 6), width=st.integers(1, 40))
def test_sketch_matches_brute_force(spark, xs, depth, width):
    C, est, f2, f2s, err = brute(xs, depth, width, 3)
    hist = S.histogram(spark.createDataFrame([(x,) for x in xs], "item bigint"))
    cells = S.sketch_cells(hist, depth, width)
    assert {(r.row, r.col): r.c for r in cells.collect()} == C
    assert {r.item: r.est for r in S.estimates(hist, cells, depth, width).collect()} == est
