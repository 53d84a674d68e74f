import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, edges_of
from trisk import session
from trisk.functions.hashing import color_planes, draw_color_params, draw_partition_params
from trisk.operators import graph as G
from trisk.operators import skew
from trisk.operators import triangles as TR
from trisk.sources.edges import order_pairs

# The small graphs of FIXTURES.md as (edges, raw lines, canonical edges,
# triangles); "sample" is the seven-line edge file of the first program.
SMALL = {
    "sample": ("0,1 1,3 2,3 2,1 0,2 1,4 3,4", 7, 7, 3),
    "repeats": ("1,2 2,1 2,3 3,1 3,3 1,2", 6, 3, 1),
    "negative": ("-1,0 0,1 1,-1", 3, 3, 1),
    "k4": ("0,1 0,2 0,3 1,2 1,3 2,3", 6, 6, 4),
    "star": ("0,1 0,2 0,3", 3, 3, 0),
    "mod8191": ("0,8191 8191,16382 16382,0", 3, 3, 1),
}


def all_triangles(pairs):
    """Every triple of nodes of which each two are joined."""
    joined = {frozenset(p) for p in pairs if len(set(p)) == 2}
    nodes = sorted(set().union(*joined)) if joined else []
    return [t for t in combinations(nodes, 3) if all(frozenset(p) in joined for p in combinations(t, 2))]


def random_pairs(seed, nodes, n):
    rng = random.Random(seed)
    return [(rng.randrange(-nodes // 3, nodes), rng.randrange(-nodes // 3, nodes)) for _ in range(n)]


def frame(spark, pairs):
    return G.canonical_edges(spark.createDataFrame(pairs, "src bigint, dst bigint"))


@pytest.mark.parametrize("name", sorted(SMALL))
@pytest.mark.parametrize("hot", [10**6, 1])
def test_small_graphs_exact(spark, name, hot):
    text, raw, canon, tri = SMALL[name]
    pairs = edges_of(spark, text)
    assert tuple(G.edge_counts(pairs).first()) == (raw, canon)
    lists = TR.prepare(G.canonical_edges(pairs), hot_rows=hot)
    assert TR.exact_count(lists, hot_work=hot).first()["triangles"] == tri
    for (a, b, C) in [(1, 0, 2), (5, 3, 3), (6918, 2121, 4)]:
        assert TR.exact_by_color_triples(lists, a, b, C).first()["triangles"] == tri


def test_empty_graph(spark):
    edges = G.canonical_edges(edges_of(spark, ""))
    lists = TR.prepare(edges)
    assert TR.exact_count(lists).first()["triangles"] == 0
    assert TR.partition_estimate(lists, 4).first()["estimate"] == 0
    assert [r["estimate"] for r in TR.color_estimates(lists, [(1, 0), (2, 5)], 4).collect()] == [0, 0]
    assert tuple(G.edge_counts(edges_of(spark, "")).first()) == (0, 0)


def test_one_colour_edges_and_keys_fixture(spark):
    # C=2, (a,b)=(1,0): sample graph one-colour edges (0,2) (1,3); estimate 0; 4 keys
    e = G.canonical_edges(edges_of(spark, SMALL["sample"][0]))
    mono = TR.monochrome_edges(e, [(1, 0)], 2).select("u", "v").orderBy("u").collect()
    assert [(r.u, r.v) for r in mono] == [(0, 2), (1, 3)]
    assert TR.color_estimates(TR.prepare(e), [(1, 0)], 2).first()["estimate"] == 0
    assert TR.color_triple_counts(e, 1, 0, 2).count() == 4
    # ids equal mod 8191 share a colour: every edge is one-colour, estimate 4 * 1
    e2 = G.canonical_edges(edges_of(spark, SMALL["mod8191"][0]))
    assert TR.color_estimates(TR.prepare(e2), [(1, 0)], 2).first()["estimate"] == 4
    assert TR.color_triple_counts(e2, 1, 0, 2).count() == 2


def order_graph(spark, sf):
    return G.canonical_edges(order_pairs(spark.read.parquet(f"{SF[sf]}/lineitem.parquet")))


def test_order_graph_is_linear_in_its_rows(spark):
    rows = [(1, 5, 7), (1, 5, 7), (1, 6, 7), (2, None, 7), (None, 5, 7), (3, 5, None)]
    raw = order_pairs(spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint"))
    assert raw.count() == 9
    got = sorted(map(tuple, G.canonical_edges(raw).collect()))
    assert got == [(3, 16), (3, 19), (3, 23), (16, 23), (19, 23)]
    assert TR.exact_count(TR.prepare(G.canonical_edges(raw))).first()["triangles"] == 2


def test_c1_estimates_equal_exact(spark):
    lists = TR.prepare(order_graph(spark, "0.001"))
    exact = TR.exact_count(lists).first()["triangles"]
    assert exact > 5000
    assert TR.partition_estimate(lists, 1).first()["estimate"] == exact
    assert {r["estimate"] for r in TR.color_estimates(lists, [(3, 4), (77, 0)], 1).collect()} == {exact}


def test_colour_median_is_close(spark):
    lists = TR.prepare(order_graph(spark, "0.01"))
    exact = TR.exact_count(lists).first()["triangles"]
    med = TR.median_estimate(TR.color_estimates(lists, draw_color_params(9, 0), 4)).first()
    assert med["runs"] == 9
    assert abs(med["median_estimate"] - exact) / exact < 0.15


def test_heavy_keys_are_few_however_many_rows(spark):
    counts = spark.createDataFrame([(k, 10) for k in range(50)] + [(99, 400), (98, 200)], "k bigint, n bigint")
    # total 1,100: above max(5, 1100 / 4) only key 99; without the share bound all but none
    assert [tuple(r) for r in skew.heavy_keys(counts, ["k"], "n", 5, 4).collect()] == [(99, 400)]
    assert skew.heavy_keys(counts, ["k"], "n", 5, 10_000).count() == 52
    assert skew.heavy_keys(counts.where("n < 0"), ["k"], "n", 5, 4).count() == 0


def test_salting_paths_agree(spark):
    edges = order_graph(spark, "0.001")
    plain, hot = TR.prepare(edges), TR.prepare(edges, hot_rows=20)
    key = lambda r: r.src
    assert sorted(plain.collect(), key=key) == sorted(hot.collect(), key=key)
    want = TR.exact_count(plain).first()["triangles"]
    assert TR.exact_count(hot, hot_work=30).first()["triangles"] == want
    params = draw_color_params(3, 1)
    assert sorted(TR.color_estimates(plain, params, 3).collect()) == sorted(
        TR.color_estimates(plain, params, 3, hot_work=2).collect())
    assert TR.partition_estimate(plain, 3).first() == TR.partition_estimate(plain, 3, hot_work=2).first()
    a = G.adjacency_degree(edges).orderBy("node").collect()
    assert a == G.adjacency_degree(edges, hot_rows=20).orderBy("node").collect()


def test_orientation_bounds_out_degree(spark):
    e = order_graph(spark, "0.01")
    m = e.count()
    ad = G.adjacency_degree(e)
    assert ad.agg(F.max("out_degree")).first()[0] <= (2 * m) ** 0.5
    assert ad.agg(F.sum("out_degree")).first()[0] == m
    assert TR.prepare(e).agg(F.sum(F.size("nb"))).first()[0] == m


def test_every_list_is_built_once(spark):
    """A count reads the written lists; nothing gathers lists again."""
    plan = TR.exact_count(TR.prepare(order_graph(spark, "0.001")))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_estimates_against_brute_force(spark):
    pairs = random_pairs(11, 60, 700)
    triangles = all_triangles(pairs)
    lists = TR.prepare(frame(spark, pairs))
    assert TR.exact_count(lists).first()["triangles"] == len(triangles) > 0
    p, C = 8191, 3
    for a, b in [(5, 7), (4000, 0), (8190, 8190)]:
        alike = [t for t in triangles if len({((a * x + b) % p) % C for x in t}) == 1]
        assert TR.color_estimates(lists, [(a, b)], C).first()["estimate"] == C * C * len(alike)
    pa, pb = draw_partition_params(0)
    alike = [t for t in triangles if len({((pa * u + pb * v) % p) % C for u, v in combinations(t, 2)}) == 1]
    assert TR.partition_estimate(lists, C, seed=0).first()["estimate"] == C * C * len(alike)


def test_hub_with_a_third_of_the_edges(spark):
    # node 0 joins every node of a 300-ring (300 of its 900 edges) with chords (i, i+2):
    # 600 triangles with the hub, 300 ring triangles (i, i+1, i+2)
    n = 300
    pairs = [(0, i) for i in range(1, n + 1)]
    pairs += [(i, (i + step - 1) % n + 1) for step in (1, 2) for i in range(1, n + 1)]
    e = frame(spark, pairs)
    for hot in (10**6, 10):   # 10: the hub's lookup is broadcast and its list salted
        lists = TR.prepare(e, hot_rows=hot, hot_keys=5)
        assert TR.exact_count(lists, hot_work=hot).first()["triangles"] == 3 * n
        assert TR.exact_by_color_triples(lists, 17, 3, 3).first()["triangles"] == 3 * n
        hub = G.adjacency_degree(e, hot_rows=hot, hot_keys=5).where("node = 0").first()
        assert (hub.degree, hub.out_degree) == (n, 0)


def test_colour_triple_keys_hold_their_own_triangles(spark):
    pairs = random_pairs(21, 50, 500)
    a, b, C = 77, 5, 3
    want = Counter(tuple(sorted(((a * x + b) % 8191) % C for x in t)) for t in all_triangles(pairs))
    got = {(r.k1, r.k2, r.k3): r.triangles
           for r in TR.exact_by_color_triples_per_key(TR.prepare(frame(spark, pairs)), a, b, C).collect()}
    assert got == want


def test_run_results_are_the_separate_runs(spark):
    lists = TR.prepare(frame(spark, random_pairs(5, 40, 400)))
    got = {(r.algorithm, r.run): r.estimate for r in TR.run_results(lists, 3, 4, seed=2).collect()}
    params = draw_color_params(4, 2)
    want = {("color", k): TR.color_estimates(lists, [p], 3).first()["estimate"] for k, p in enumerate(params)}
    want["partition", 0] = TR.partition_estimate(lists, 3, seed=2).first()["estimate"]
    want["exact", 3] = TR.exact_count(lists).first()["triangles"]
    assert got == want


def plain_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_held_lists_are_not_shuffled_again(spark):
    lists = TR.prepare(order_graph(spark, "0.001"), buckets=8)
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, moved in ((TR.exact_count(lists), 1), (TR.color_estimates(lists, [(5, 3), (6, 7)], 3), 1),
                          (TR.partition_estimate(lists, 3), 1)):
            # Ahead of the hubs' join, the union's first branch: its senders are dealt by dst, its lists scanned.
            plan = plain_plan(df)
            cold = plan[plan.index("Union"):].split("SortMergeJoin [dst", 2)[1]
            assert cold.count("Exchange hashpartitioning(dst") == moved and "Bucketed: true" in cold
        # An equi-join on the node alone: the senders move, the lists do not.
        senders = lists.select(F.col("src").alias("of"), F.explode("nb").alias("dst"))
        joined = senders.join(lists.withColumnRenamed("src", "dst"), "dst")
        assert plain_plan(joined).count("Exchange hashpartitioning") == 1
        want = TR.exact_count(lists).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert TR.exact_count(lists).first() == want
    assert TR.exact_count(lists, hot_work=5).first() == want   # hubs in a join of their own


def test_work_is_what_lists_send(spark):
    lists = TR.prepare(frame(spark, random_pairs(3, 30, 200))).collect()
    want = Counter()
    for r in lists:
        for at, dst in enumerate(r.nb):
            want[dst] += len(r.nb) - at - 1
    assert {r.src: r.work for r in lists if r.work} == {k: n for k, n in want.items() if n}


@pytest.mark.parametrize("colors", [1, 2, 3, 5])
def test_partitioned_join_equals_the_label_form(spark, colors):
    pairs = random_pairs(21, 50, 500)
    lists = TR.prepare(frame(spark, pairs))
    key = lambda r: tuple(r)
    dealt = TR.triple_key_lists(lists, 77, 5, colors)
    got = TR.triangles_inside_keys(dealt)
    assert plain_plan(got).count("Exchange") == 1   # the deal by key; lists, wedges and counts stay inside
    assert sorted(map(key, got.collect())) == sorted(map(key, TR.label_by_color_triples(lists, 77, 5, colors).collect()))
    # A key holds its own edges only, and every edge is in its C keys.
    hue = lambda x: ((77 * x + 5) % 8191) % colors
    held = Counter()
    for r in dealt.collect():
        for dst in r.nb:
            rest = [r.k1, r.k2, r.k3]
            rest.remove(hue(r.src))
            rest.remove(hue(dst))
            held[min(r.src, dst), max(r.src, dst), r.k1, r.k2, r.k3] += 1
    want = {(u, v, *sorted((hue(u), hue(v), i))) for u, v in {(min(p), max(p)) for p in pairs if p[0] != p[1]}
            for i in range(colors)}
    assert set(held) == want and set(held.values()) == {1}


def test_triple_report_counts_copies_and_the_largest_key(spark):
    edges = frame(spark, random_pairs(4, 40, 300))
    per_key = [r.edges for r in TR.color_triple_counts(edges, 77, 5, 3).collect()]
    r = TR.color_triple_report(edges, 77, 5, 3).first()
    assert (r.edges, r.copies, r.replication, r["keys"], r.largest_key) == (
        edges.count(), 3 * edges.count(), 3.0, len(per_key), max(per_key))
    r = TR.color_triple_report(edges.where("u > v"), 77, 5, 3).first()
    assert (r.edges, r.copies, r.replication, r["keys"], r.largest_key) == (0, 0, None, 0, 0)


def test_timed_runs_give_the_mean_the_median_and_the_last(spark):
    lists = TR.prepare(frame(spark, random_pairs(5, 40, 400)))
    params = draw_color_params(3, 2)
    runs = TR.timed_runs(lambda ab: TR.color_estimates(lists, [ab], 3), params)
    rows = runs.orderBy("run").collect()
    want = [TR.color_estimates(lists, [ab], 3).first()["estimate"] for ab in params]
    assert [r.estimate for r in rows] == want and all(r.elapsed_ms > 0 for r in rows)
    report = TR.timing_report(runs).first()
    assert (report.runs, report.mean_ms) == (3, round(sum(r.elapsed_ms for r in rows) / 3))
    assert (report.median_estimate, report.last_estimate) == (sorted(want)[1], want[2])


@pytest.mark.parametrize("colors", [1, 2, 3, 5])
def test_keys_split_over_tasks_equal_keys_in_one_task(spark, colors):
    lists = TR.prepare(frame(spark, random_pairs(21, 50, 500)))
    want = sorted(map(tuple, TR.exact_by_color_triples_per_key(lists, 77, 5, colors).collect()))
    assert want
    for hot in (G.HOT_WORK, 3):   # 3: hubs in a join of their own
        split = TR.exact_by_color_triples_per_key(lists, 77, 5, colors, key_edges=10, hot_work=hot)
        assert split.columns == ["k1", "k2", "k3", "triangles"]
        assert sorted(map(tuple, split.collect())) == want
    assert TR.exact_by_color_triples(lists, 77, 5, colors, key_edges=10).first() == TR.exact_count(lists).first()
    held = Counter((r.src, r.dst, r.k1, r.k2, r.k3) for r in TR.triple_key_copies(lists, 77, 5, colors).collect())
    hue = lambda x: ((77 * x + 5) % 8191) % colors
    edges = [(r.src, x) for r in lists.collect() for x in r.nb]
    assert held == Counter((u, v, *sorted((hue(u), hue(v), i))) for u, v in edges for i in range(colors))


def test_a_key_over_its_limit_is_not_one_task(spark):
    """One colour puts every edge in one key: its wedges are dealt by node, none by the key."""
    lists = TR.prepare(order_graph(spark, "0.001"), buckets=8)
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = plain_plan(TR.exact_by_color_triples_per_key(lists, 17, 3, 1, key_edges=100))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert "Exchange hashpartitioning(dst" in split and "Window" not in split
    cold = split[split.index("Union"):].split("SortMergeJoin [dst", 2)[1]
    assert "Bucketed: true" in cold and cold.count("Exchange hashpartitioning(dst") == 1


def test_prepare_counts_edges_and_degrees_once(spark):
    """Lookups read written degrees of written edges and sort no edges; buckets follow the edges."""
    edges = order_graph(spark, "0.001")
    plan = plain_plan(G.orient(edges))
    assert "HashAggregate(keys=[node" not in plan and "SortMergeJoin" not in plan
    before, TR.BUCKET_EDGES = TR.BUCKET_EDGES, 500
    try:
        many = TR.prepare(edges)
    finally:
        TR.BUCKET_EDGES = before
    key = lambda r: r.src
    assert len({r.file for r in many.select(F.input_file_name().alias("file")).collect()}) > 8
    assert sorted(many.collect(), key=key) == sorted(TR.prepare(edges).collect(), key=key)


def test_pairs_are_dealt_before_repeats_are_dropped(spark):
    plan = plain_plan(frame(spark, [(1, 2), (2, 1), (2, 3)]))
    first = plan.rindex("Exchange hashpartitioning(u")   # the lowest, and only, exchange
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan[first:]


def test_lists_send_to_members_with_a_list_only(spark):
    """A member without a list closes nothing: its places are not in ``at``, and nothing is sent there."""
    rng = random.Random(3)   # orders, parts, suppliers: no supplier has a list
    ids = [(rng.randrange(30), 100 + rng.randrange(9), 200 + rng.randrange(3)) for _ in range(90)]
    lists = TR.prepare(frame(spark, [pair for t in ids for pair in combinations(t, 2)]))
    rows = lists.collect()
    have = {r.src for r in rows if r.nb}
    assert [r.at for r in rows] == [[k for k, x in enumerate(r.nb[:-1]) if x in have] for r in rows]
    assert any(set(r.nb[:-1]) - have for r in rows)
    sent = sorted((r.src, r.dst, tuple(r.rest)) for r in G.wedges(lists).collect())
    assert sent == sorted((r.src, x, tuple(r.nb[k + 1:])) for r in rows for k, x in enumerate(r.nb[:-1]) if x in have)


def test_a_wedge_moves_once_for_all_runs(spark):
    pairs, params, C = random_pairs(11, 60, 700), draw_color_params(70, 4), 3   # 70: two messages
    lists = TR.prepare(frame(spark, pairs))
    hue = lambda x, r: ((params[r][0] * x + params[r][1]) % 8191) % C
    moved = TR.monochrome_wedges(lists, params[:5], C).collect()
    assert len({(r.src, r.dst) for r in moved}) == len(moved) > 0
    for row in moved:
        alike = [r for r in range(5) if hue(row.src, r) == hue(row.dst, r)]
        assert row.mark == sum(1 << r for r in alike)
        assert all(any(hue(x, r) == hue(row.dst, r) for r in alike) for x in row.rest)
    want = Counter((r, hue(t[0], r)) for t in all_triangles(pairs) for r in range(70) if len({hue(x, r) for x in t}) == 1)
    assert {(r.run, r.color): r.triangles for r in TR.triangles_by_color(lists, params, C).collect()} == want


def test_counts_of_written_edges_equal_those_of_pairs(spark):
    raw = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (2, 4)], "src bigint, dst bigint")
    assert tuple(G.edge_counts(raw, edges=G.canonical_edges(raw)).first()) == tuple(G.edge_counts(raw).first()) == (4, 2)


def test_members_are_compared_by_compiled_code(spark):
    """Pairs of a list's members are rows, not an interpreted filter of arrays, and are packed without an exchange."""
    lists = TR.prepare(order_graph(spark, "0.001"), buckets=8)
    for sent in (TR.part_wedges(lists, 3), TR.monochrome_wedges(lists, [(5, 3), (6, 7)], 3)):
        plan = plain_plan(sent)
        assert "lambda" not in plan and "Exchange" not in plan and sent.columns[:2] == ["src", "dst"]


@pytest.mark.parametrize("p", [8191, 65537])   # residues in a table, and worked out
def test_colour_planes_spell_every_runs_colour(spark, p):
    params, xs = [(7, 3), (8000, 8190), (1, 0)], [0, 1, 8190, 8191, 70000, 10**15, -5]
    for colors in (1, 2, 5, 20000):
        planes = color_planes(params, colors, p)
        rows = spark.createDataFrame([(x,) for x in xs], "x bigint").select(
            "x", F.array(*[of(F.col("x")) for of in planes], F.lit(0).cast("bigint")).alias("words")).collect()
        for row in rows:
            for r, (a, b) in enumerate(params):
                assert sum((w >> r & 1) << j for j, w in enumerate(row.words)) == (a * row.x + b) % p % colors


def test_an_end_is_met_once_for_all_its_copies(spark):
    """What an edge can close is looked up before it is copied to its C keys."""
    lists = TR.prepare(order_graph(spark, "0.001"), buckets=8)
    plan = plain_plan(TR.exact_by_color_triples_per_key(lists, 17, 3, 4, key_edges=100))
    assert plan.index("Generate explode") < plan.index("array_intersect")


def test_edges_move_once_to_their_lists(spark):
    """Dealt by their smaller end, edges are told to the other end, and only those that belong to the first go
    back; live members are found where the lists are."""
    edges, deg, n = TR.write_graph(order_pairs(spark.read.parquet(f"{SF['0.001']}/lineitem.parquet")))
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lists = G.directed_lists(edges, deg, None, n)
        plan = plain_plan(lists)
        # Spark deals v for both branches, and runs the same exchange once.
        assert "Exchange hashpartitioning(u" not in plan and plan.count("Exchange hashpartitioning(v") == 2
        assert plan.count("Exchange") == 3 and plan.count("Exchange hashpartitioning(src") == 1
        held = TR.prepare(edges, buckets=n, written=True, deg=deg).where(F.size("nb") > 0).select("src", "nb")
        work = TR.materialize_bucketed(G.node_work(held), "work", "src", n)
        assert "Exchange hashpartitioning" not in plain_plan(G.live_members(held, work, n))
        assert "Exchange hashpartitioning" in plain_plan(G.live_members(held, work, n, sinks=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert sorted(map(tuple, lists.collect())) == sorted(map(tuple, held.collect()))


@pytest.mark.parametrize("hot", [10**6, 150, 30])   # 150: larger ends are heavy; 30: smaller ones too
def test_pairs_of_any_skew_give_the_same_lists(spark, hot):
    rng = random.Random(8)
    raw = [(-1, x) for x in range(40)] + [(900, x) for x in range(200)] + [(5, 5)]
    raw += [(rng.randrange(200), rng.randrange(200)) for _ in range(500)]
    raw += [(y, x) for x, y in raw[::3]]
    pairs = spark.createDataFrame(raw, "src bigint, dst bigint")
    total, smaller, larger = G.raw_ends(pairs)
    lesser, greater = Counter(min(p) for p in raw), Counter(max(p) for p in raw)
    assert (total, smaller >= max(lesser.values()), larger >= max(greater.values())) == (len(raw), True, True)
    joined = {(min(p), max(p)) for p in raw if p[0] != p[1]}
    edges, deg, _ = TR.write_graph(pairs, hot_rows=hot, hot_keys=10**6)
    assert sorted(map(tuple, edges.collect())) == sorted(joined)
    degree = Counter(x for pair in joined for x in pair)
    assert {r.node: r.degree for r in deg.collect()} == degree
    rank = lambda x: (degree[x], x)
    nb = {}
    for pair in joined:
        low, high = sorted(pair, key=rank)
        nb.setdefault(low, []).append(high)
    lists = TR.prepare_pairs(pairs, hot_rows=hot, hot_keys=10**6)
    assert {r.src: r.nb for r in lists.collect() if r.nb} == {x: sorted(ys, key=rank) for x, ys in nb.items()}
    assert TR.exact_by_color_triples(lists, 77, 5, 3, key_edges=10).first()["triangles"] == len(all_triangles(raw))


def test_members_without_a_list_are_found_both_ways(spark):
    edges = frame(spark, random_pairs(31, 60, 150))
    want = sorted(TR.prepare(edges).collect())
    assert want == sorted(TR.prepare(edges, sinks=0).collect()) == sorted(TR.prepare(edges, sinks=0, hot_rows=5).collect())


@pytest.mark.parametrize("shift", [0, 2**31 - 40, -2**40])   # ids of 32 bits, across their end, and far below
def test_long_ids_count_as_short_ones(spark, shift):
    pairs = random_pairs(12, 50, 400)
    lists = TR.prepare(frame(spark, [(u + shift, v + shift) for u, v in pairs]))
    count = TR.exact_by_color_triples_per_key(lists, 77, 5, 3, key_edges=10)
    assert ("as array<int>" in plain_plan(count)) == (shift == 0)
    assert sum(r.triangles for r in count.collect()) == len(all_triangles(pairs)) > 0


def test_only_the_lists_stay(spark):
    before = (len(session._made), len(session._tables))
    lists = TR.prepare_pairs(spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "src bigint, dst bigint"))
    assert (len(session._made), len(session._tables)) == (before[0] + 1, before[1] + 1)
    assert TR.exact_count(lists).first()["triangles"] == 1
