"""Triangle estimators and exact counts of the three graph programs.

* colour estimate: colour nodes with ``((a*u+b) mod p) mod C``, keep edges whose end
  points share a colour, count triangles per colour, sum, multiply by C^2;
* R independent colourings run as one job keyed by ``run``; median over runs,
  rounded half to even;
* partition estimate: split edges into C parts by a hash of the edge, count
  triangles per part, sum, multiply by C^2;
* exact count by colour triples: every edge goes to the C keys
  ``sorted(c(u), c(v), i)``; a key counts only triangles whose sorted colours
  equal the key, so the sum is the exact count.

The first three read one table of out-lists (``prepare``), bucketed by node, whose held side is
never shuffled again. A colour or a part keeps some members of what each list sends, so the
subgraphs need no shuffle of their own, and no group of edges is ever gathered in one task.
A list sends only to members that have a list, and what R colourings keep of it moves once.

The exact count is the one-round join of Suri & Vassilvitskii (2011): the copies of the edges
are dealt to their keys once, and lists, wedges and counts are made inside the keys without
another exchange (``triangles_inside_keys``). C sets the replication and the size of a key,
which ``color_triple_report`` gives. Inside a key everything is sorted and can spill.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trisk.functions.hashing import (
    DEFAULT_PRIME,
    color_planes,
    color_runs_column,
    draw_color_params,
    draw_partition_params,
    edge_part,
    node_color,
)
from trisk.operators.graph import (
    HOT_WORK,
    SINKS,
    canonical_edges,
    close_wedges,
    count_wedges,
    degrees,
    degrees_in_place,
    directed_lists,
    each_of,
    hubs_of,
    live_members,
    meet_lists,
    node_work,
    raw_ends,
    wedges,
    with_members,
)
from trisk.operators.skew import HOT_KEYS, HOT_ROWS
from trisk.operators.util import combine_rows, require_positive
from trisk.session import made_so_far, materialize, materialize_bucketed, remove_made, shuffles_removed

Params = list[tuple[int, int]]

# Edges of one bucket of lists: what is sent to a bucket is sorted in one task.
BUCKET_EDGES = 1_000_000
# Edges up to which a colour-triple key, which holds an edge once at most, is counted in one task.
KEY_EDGES = 1_000_000


def prepare(edges: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS,
            buckets: int | None = None, written: bool = False, sinks: int = SINKS,
            deg: DataFrame | None = None) -> DataFrame:
    """Out-lists ``(src, nb, at, work)`` of a canonical edge table, written once in the shared folder,
    bucketed and sorted by node; ``at`` are the places in nb of members that have a list themselves
    and members after them, ``work`` is what other lists send to the node.

    Every count reads them from there; the lineage is cut, and a lost executor costs a
    re-read, not a recomputation. Edges and degrees are written once too, as several steps read
    them (``written``: the edges are; ``deg``: the degrees too, bucketed by node), and what is written
    here is removed once the lists are there. Lists are dealt to their
    buckets as edges and stay there.
    """
    since, spark = made_so_far(), edges.sparkSession
    with shuffles_removed(spark):
        edges = edges if written else materialize(edges, "edges", "zstd")
        n = buckets or _buckets(spark, edges.count())
        deg = materialize_bucketed(degrees(edges), "degrees", "node", n) if deg is None else deg
        hubs = hubs_of(deg, hot_rows, hot_keys)
        lists = materialize_bucketed(directed_lists(edges, deg, hubs, n), "out-lists", "src", n, dealt=True)
        work = materialize_bucketed(node_work(lists), "work", "src", n)
        whole = with_members(lists, live_members(lists, work, n, hubs, sinks), work)
        done = materialize_bucketed(whole, "bucketed-lists", "src", n, dealt=True)
    remove_made(spark, since, keep=1)
    return done


def write_graph(raw: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> tuple[DataFrame, DataFrame, int]:
    """The canonical edges of raw pairs and the degrees, each written once in the shared folder, and the buckets
    to ``prepare`` them in.

    Edges are dealt, and bucketed, by their smaller end, and not dealt by it again; where one node may
    be that of a heavy share of the pairs, they are dealt by both ends instead.
    """
    pairs, smaller, larger = raw_ends(raw)
    n, heavy = _buckets(raw.sparkSession, pairs), max(hot_rows, pairs / hot_keys)
    with shuffles_removed(raw.sparkSession):
        edges = (materialize(canonical_edges(raw), "edges", "zstd") if smaller > heavy else
                 materialize_bucketed(canonical_edges(raw, by_end=n), "edges", "u", n, dealt=True, then=["v"]))
        if max(smaller, larger) > heavy:
            return edges, materialize_bucketed(degrees(edges), "degrees", "node", n), n
        return edges, materialize_bucketed(degrees_in_place(edges, n), "degrees", "node", n, dealt=True), n


def prepare_pairs(raw: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``prepare`` of raw pairs, of which only the lists stay."""
    since = made_so_far()
    edges, deg, n = write_graph(raw, hot_rows, hot_keys)
    lists = prepare(edges, hot_rows, hot_keys, n, written=True, deg=deg)
    remove_made(raw.sparkSession, since, keep=1)
    return lists


def _buckets(spark: SparkSession, edges: int) -> int:
    """Shuffle partitions, or one per BUCKET_EDGES edges if those are more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-edges // BUCKET_EDGES))


def _total(per_key: DataFrame, scale: int = 1, name: str = "triangles") -> DataFrame:
    return per_key.agg((F.coalesce(F.sum("triangles"), F.lit(0)) * F.lit(scale)).cast("bigint").alias(name))


def node_colors(edges: DataFrame, params: Params, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(run, node, color)`` for every node of a canonical edge table and run."""
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return (nodes.select("node", F.inline(color_runs_column(params)))
            .select("run", "node", node_color(F.col("node"), F.col("a"), F.col("b"), colors, p)
                    .alias("color")))


# Runs whose colourings share one message: a bit of a bigint each.
MASK_RUNS = 62


def monochrome_wedges(lists: DataFrame, params: Params, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(src, dst, mark, rest)``: the wedges that have one colour in any of at most ``MASK_RUNS`` runs, each once;
    bit r of ``mark`` says whether src and dst share a colour in run r."""
    planes = color_planes(params, colors, p)
    every = F.lit((1 << len(params)) - 1).cast("bigint")

    def mask(x: str) -> Column:
        differ = [of(F.col("src")).bitwiseXOR(of(F.col(x))) for of in planes]
        return F.bitwise_not(reduce(Column.bitwiseOR, differ)).bitwiseAND(every) if differ else every

    return wedges(lists, mask, lambda m, n: m.bitwiseAND(n) != 0)


def triangles_by_color(lists: DataFrame, params: Params, colors: int, p: int = DEFAULT_PRIME,
                       hot_work: int = HOT_WORK) -> DataFrame:
    """``(run, color, triangles)`` inside each colour class (classes with >= 1 triangle).

    The one-colour subgraphs of the runs overlap, so their union moves: a wedge goes to its list once
    and, closed there, counts in each run that gives its three nodes one colour.
    """
    require_positive(colors=colors, runs=len(params))

    def color(x: str) -> Column:
        return node_color(F.col(x), F.col("a"), F.col("b"), colors, p)

    found = []
    for at in range(0, len(params), MASK_RUNS):
        some = params[at:at + MASK_RUNS]
        closed = close_wedges(monochrome_wedges(lists, some, colors, p).drop("src"), lists, hot_work)
        found.append(closed.select("dst", "mark", each_of("common").alias("third"))
                     .select("*", F.inline(color_runs_column(some, at)))
                     .where(F.get(F.array(*[F.col("mark").bitwiseAND(1 << r) != 0 for r in range(len(some))]),
                                  F.col("run") - at))
                     .select("run", color("dst").alias("color"), color("third").alias("own"))
                     .where("color = own").groupBy("run", "color").agg(F.count(F.lit(1)).alias("triangles")))
    return reduce(DataFrame.unionByName, found)


def color_estimates(lists: DataFrame, params: Params, colors: int, p: int = DEFAULT_PRIME,
                    hot_work: int = HOT_WORK) -> DataFrame:
    """``(run, estimate)``: C^2 times the monochromatic triangles, one row per run."""
    per_run = (triangles_by_color(lists, params, colors, p, hot_work)
               .groupBy("run").agg(F.sum("triangles").alias("t")))
    runs = lists.sparkSession.range(len(params)).select(F.col("id").cast("int").alias("run"))
    return (F.broadcast(runs).join(per_run, "run", "left")  # R rows, a parameter
            .select("run", (F.coalesce("t", F.lit(0)) * F.lit(colors * colors))
                    .cast("bigint").alias("estimate")))


def median_estimate(estimates: DataFrame) -> DataFrame:
    """``(runs, median_estimate)``: median over runs, rounded half to even.

    Exact while the estimates are below 2^53, as ``percentile`` works on doubles.
    """
    return estimates.agg(
        F.count(F.lit(1)).alias("runs"),
        F.bround(F.percentile(F.col("estimate"), F.lit(0.5)), 0).cast("bigint")
        .alias("median_estimate"))


def part_wedges(lists: DataFrame, parts: int, seed: int | None = 0, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(src, dst, part, rest)``: the wedges whose two edges at src are in one part.

    The part of an edge is ``((a*u + b*v) mod p) mod C`` on the canonical (u, v),
    so repeated or reversed lines of one edge always meet in one part.
    """
    of = _part_of(F.col("src"), parts, seed, p)
    return wedges(lists, lambda x: of(F.col(x)), lambda part, other: part == other).withColumnRenamed("mark", "part")


def _part_of(end: Column, parts: int, seed: int | None, p: int):
    """The part of the edge from ``end`` to a node, as a function of that node."""
    a, b = draw_partition_params(seed, p)
    return lambda x: edge_part(F.least(end, x), F.greatest(end, x), a, b, parts, p)


def partition_estimate(lists: DataFrame, parts: int, seed: int | None = 0, p: int = DEFAULT_PRIME,
                       hot_work: int = HOT_WORK) -> DataFrame:
    """``(estimate)``: C^2 times the triangles whose three edges share a part."""
    require_positive(parts=parts)
    closed = close_wedges(part_wedges(lists, parts, seed, p).drop("src"), lists, hot_work)
    part = _part_of(F.col("dst"), parts, seed, p)  # the third edge's, which the whole list does not say
    same = closed.withColumn("common", F.filter("common", lambda x: part(x) == F.col("part")))
    return _total(count_wedges(same), parts * parts, "estimate")


def partition_sizes(edges: DataFrame, parts: int, seed: int | None = 0,
                    p: int = DEFAULT_PRIME) -> DataFrame:
    """``(part, edges)``: how many canonical edges fall in each part."""
    a, b = draw_partition_params(seed, p)
    return (edges.select(edge_part(F.col("u"), F.col("v"), a, b, parts, p).alias("part"))
            .groupBy("part").agg(F.count(F.lit(1)).alias("edges")))


def _triple_keys(c1: Column, c2: Column, c3: Column) -> list[Column]:
    """Three colours in ascending order, as the key columns k1, k2, k3."""
    low, high = F.least(c1, c2, c3), F.greatest(c1, c2, c3)
    return [low.alias("k1"), (c1 + c2 + c3 - low - high).alias("k2"), high.alias("k3")]


def _every_color(colors: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(colors - 1).cast("bigint")))


def color_triple_counts(edges: DataFrame, a: int, b: int, colors: int,
                        p: int = DEFAULT_PRIME) -> DataFrame:
    """``(k1, k2, k3, edges)``: how many edge copies each colour-triple key receives."""
    require_positive(colors=colors)
    copies = edges.select(node_color(F.col("u"), a, b, colors, p).alias("cu"),
                          node_color(F.col("v"), a, b, colors, p).alias("cv"), _every_color(colors).alias("want"))
    return (copies.select(*_triple_keys(F.col("cu"), F.col("cv"), F.col("want")))
            .groupBy("k1", "k2", "k3").agg(F.count(F.lit(1)).alias("edges")))


def color_triple_report(edges: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(colors, edges, copies, replication, keys, largest_key, mean_key)``: what dealing the edges to
    colour-triple keys costs, and how evenly the keys are filled."""
    per_key = color_triple_counts(edges, a, b, colors, p).agg(
        F.coalesce(F.sum("edges"), F.lit(0)).cast("bigint").alias("copies"), F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.max("edges"), F.lit(0)).cast("bigint").alias("largest_key"), F.avg("edges").alias("mean_key"))
    whole = edges.agg(F.count(F.lit(1)).alias("edges"))
    return combine_rows([whole, per_key]).select(
        F.lit(colors).alias("colors"), "edges", "copies", F.try_divide("copies", "edges").alias("replication"),
        "keys", "largest_key", "mean_key")


KEY = ("k1", "k2", "k3")


def triple_key_lists(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME,
                     partitions: int | None = None) -> DataFrame:
    """``(k1, k2, k3, src, nb, hues, both)``: every oriented edge in its C keys, dealt out by key and packed
    by its source: nb are the ends of src's edges there, in the order of its list, hues their
    colours, and ``both`` less an end's colour is the colour that a third node must have."""
    require_positive(colors=colors)
    hue = node_color(F.col("src"), a, b, colors, p)
    each = lists.where(F.size("nb") > 0).select(
        "src", "nb", hue.alias("cs"), F.transform("nb", lambda x: node_color(x, a, b, colors, p)).alias("hues"))
    # With src's colour, the other two of a key: C (C + 1) / 2 pairs, a parameter.
    pairs = F.array(*[F.struct(F.lit(x).cast("bigint").alias("x"), F.lit(y).cast("bigint").alias("y"))
                      for x in range(colors) for y in range(x, colors)])
    x, y = F.col("x"), F.col("y")
    packed = each.select("*", F.inline(pairs)).select(
        *_triple_keys(F.col("cs"), x, y), "src",
        F.filter("nb", lambda _, k: F.get("hues", k).isin(x, y)).alias("nb"),
        F.filter("hues", lambda h: h.isin(x, y)).alias("hues"), (x + y).alias("both"))
    n = partitions or int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.where(F.size("nb") > 0).repartition(n, *KEY)


def triangles_inside_keys(dealt: DataFrame) -> DataFrame:
    """``(k1, k2, k3, triangles)`` of edges dealt to colour-triple keys, by no further exchange.

    In its key, a node's list sends each member y what comes after y in the third colour; y's
    own list comes first in y's window, and each row sent there meets it. Rows of a window are
    sorted and spill; none is gathered.
    """
    none = F.expr("CAST(array() AS array<bigint>)")
    sends = F.transform("nb", lambda dst, k: F.struct(
        dst.alias("node"), F.lit(1).alias("kind"), none.alias("own"),
        F.filter(F.slice("nb", k + 2, F.size("nb")),
                 lambda _, j: F.get("hues", k + 1 + j) == F.col("both") - F.get("hues", k)).alias("rest")))
    own = F.array(F.struct(F.col("src").alias("node"), F.lit(0).alias("kind"), F.col("nb").alias("own"), none.alias("rest")))
    rows = dealt.select(*KEY, F.inline(F.concat(own, F.filter(sends, lambda s: F.size(s["rest"]) > 0))))
    node = Window.partitionBy(*KEY, "node").orderBy("kind")
    held = F.first(F.when(F.col("kind") == 0, F.col("own")), ignorenulls=True).over(
        node.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = rows.withColumn("held", held).where("kind = 1 AND held IS NOT NULL")
    t = F.size(F.array_intersect("rest", "held"))
    return (met.select(*KEY, t.alias("t")).where("t > 0").groupBy(*KEY)
            .agg(F.sum("t").cast("bigint").alias("triangles")))


def triple_key_edges(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(src, dst, cs, live, rest)``: every oriented edge, with src's colour and what comes after dst in src's
    list; ``live`` says whether dst has a list to close a wedge with."""
    edges = lists.select("src", "nb", F.col("at").alias("open"), node_color(F.col("src"), a, b, colors, p).alias("cs"),
                         F.posexplode("nb").alias("at", "dst"))
    return edges.select("src", "dst", "cs", F.array_contains("open", F.col("at")).alias("live"),
                        F.slice("nb", F.col("at") + 2, F.size("nb")).alias("rest"))


def copied(edges: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(k1, k2, k3, third, rest, ...)``: each of ``edges(dst, cs, rest, ...)`` once in each of its C keys, as a
    row; third is the colour that a third node must have, and rest what of the edge's has it."""
    require_positive(colors=colors)
    others = [c for c in edges.columns if c not in ("cs", "rest")]
    rest = F.filter("rest", lambda x: node_color(x, a, b, colors, p) == F.col("third"))
    return (edges.select("*", _every_color(colors).alias("third"))
            .select(*_triple_keys(F.col("cs"), node_color(F.col("dst"), a, b, colors, p), F.col("third")), *others,
                    "third", rest.alias("rest")))


def triple_key_copies(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(k1, k2, k3, src, dst, live, third, rest)``: every oriented edge once in each of its C keys, as a row."""
    return copied(triple_key_edges(lists, a, b, colors, p), a, b, colors, p)


def triangles_in_split_keys(edges: DataFrame, lists: DataFrame, a: int, b: int, colors: int,
                            p: int = DEFAULT_PRIME, hot_work: int = HOT_WORK, short: bool = False) -> DataFrame:
    """``(k1, k2, k3, triangles)`` of the rows of ``triple_key_edges``, for keys of any size.

    A key's wedges are spread by node, so all copies of an edge belong where its end's list is: the edge
    moves there once and is copied to its C keys in that place. In its key, a copy has what comes after
    the end in the source's list and has the third colour, and closes the triangles whose third node is
    in the end's list too. Every wedge is in one key. Hubs are salted as in every count. Where all
    ids are ``short``, of 32 bits, they move as such.
    """
    moved = F.col("rest").cast("array<int>") if short else F.col("rest")
    met = meet_lists(edges.where("live").select("dst", "cs", moved.alias("rest")), lists, hot_work)
    # Of what comes after the end, only what is in its list can close there: looked up once for all copies.
    closed = F.array_intersect("own", F.col("rest").cast("array<bigint>"))
    copies = copied(met.select("dst", "cs", closed.alias("rest")), a, b, colors, p)
    return (copies.select(*KEY, F.size("rest").alias("t")).groupBy(*KEY)
            .agg(F.sum("t").cast("bigint").alias("triangles")).where("triangles > 0"))


def exact_by_color_triples_per_key(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME,
                                   partitions: int | None = None, key_edges: int = KEY_EDGES,
                                   hot_work: int = HOT_WORK) -> DataFrame:
    """``(k1, k2, k3, triangles)``: triangles whose sorted colours are the key, counted in their key:
    in one task per key, or over all tasks where a key may hold more than ``key_edges``."""
    edges, least, most = lists.agg(F.coalesce(F.sum(F.size("nb")), F.lit(0)), F.min(F.array_min("nb")),
                                   F.max(F.array_max("nb"))).first()
    if edges <= key_edges:
        return triangles_inside_keys(triple_key_lists(lists, a, b, colors, p, partitions))
    short = -(1 << 31) <= least and most < 1 << 31
    return triangles_in_split_keys(triple_key_edges(lists, a, b, colors, p), lists, a, b, colors, p, hot_work, short)


def exact_by_color_triples(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME,
                           partitions: int | None = None, key_edges: int = KEY_EDGES,
                           hot_work: int = HOT_WORK) -> DataFrame:
    """``(triangles)``: exact count, summed over colour-triple keys."""
    return _total(exact_by_color_triples_per_key(lists, a, b, colors, p, partitions, key_edges, hot_work))


def label_by_color_triples(lists: DataFrame, a: int, b: int, colors: int, p: int = DEFAULT_PRIME,
                           hot_work: int = HOT_WORK) -> DataFrame:
    """``(k1, k2, k3, triangles)`` with the key as a label of triangles found by the exact count: no
    edge is copied; what the one-round join must equal."""
    def color(x: Column) -> Column:
        return node_color(x, a, b, colors, p)

    found = close_wedges(wedges(lists), lists, hot_work).select("src", "dst", each_of("common").alias("third"))
    return (found.select(*_triple_keys(color(F.col("src")), color(F.col("dst")), color(F.col("third"))))
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("triangles")))


def exact_count(lists: DataFrame, hot_work: int = HOT_WORK) -> DataFrame:
    """``(triangles)``: exact count on the oriented graph."""
    return count_wedges(close_wedges(wedges(lists).drop("src"), lists, hot_work))


def triangle_report(raw_counts: DataFrame, lists: DataFrame, colors: int, runs: int,
                    seed: int | None = 0, p: int = DEFAULT_PRIME, hot_work: int = HOT_WORK) -> DataFrame:
    """One row: raw and distinct edges, C, R, the median colour estimate over R runs,
    the partition estimate and the exact count (by colour triples, first run's hash).
    ``raw_counts`` is a one-row ``(raw_edges, edges)`` frame."""
    params = draw_color_params(runs, seed, p)
    a0, b0 = params[0]
    return combine_rows([
        raw_counts.select("raw_edges", "edges"),
        median_estimate(color_estimates(lists, params, colors, p, hot_work))
        .select(F.col("median_estimate").alias("color_estimate")),
        partition_estimate(lists, colors, seed, p, hot_work)
        .select(F.col("estimate").alias("partition_estimate")),
        exact_by_color_triples(lists, a0, b0, colors, p)
        .select(F.col("triangles").alias("exact_triangles")),
    ]).select(F.lit(colors).alias("colors"), F.lit(runs).alias("runs"), "raw_edges", "edges",
              "color_estimate", "partition_estimate", "exact_triangles")


def run_results(lists: DataFrame, colors: int, runs: int, seed: int | None = 0, p: int = DEFAULT_PRIME,
                hot_work: int = HOT_WORK) -> DataFrame:
    """``(algorithm, run, estimate)``: what every run of the programs prints, without times:
    R colour runs, the partition run, and the exact count with the last run's hash."""
    params = draw_color_params(runs, seed, p)
    color = color_estimates(lists, params, colors, p, hot_work).select(
        F.lit("color").alias("algorithm"), "run", "estimate")
    part = partition_estimate(lists, colors, seed, p, hot_work).select(
        F.lit("partition").alias("algorithm"), F.lit(0).alias("run"), "estimate")
    exact = exact_by_color_triples(lists, *params[-1], colors, p).select(
        F.lit("exact").alias("algorithm"), F.lit(runs - 1).alias("run"), F.col("triangles").alias("estimate"))
    return color.unionByName(part).unionByName(exact)


def timed_runs(count: Callable[[tuple[int, int]], DataFrame], params: Params) -> DataFrame:
    """``(run, estimate, elapsed_ms)``: ``count`` of one (a, b) pair, run to its end for every pair in turn, as
    the programs time their R runs; its frame has one row with the estimate in its last column."""
    require_positive(runs=len(params))
    rows = []
    for run, pair in enumerate(params):
        begun, frame = time.perf_counter(), count(pair)
        estimate = int(frame.first()[-1])
        rows.append((run, estimate, round(1000 * (time.perf_counter() - begun))))
    return frame.sparkSession.createDataFrame(rows, "run int, estimate bigint, elapsed_ms bigint")


def timing_report(runs: DataFrame) -> DataFrame:
    """``(runs, mean_ms, median_estimate, last_estimate)`` of timed runs, rounded half to even."""
    return runs.agg(F.count(F.lit(1)).alias("runs"), F.bround(F.avg("elapsed_ms"), 0).cast("bigint").alias("mean_ms"),
                    F.bround(F.percentile(F.col("estimate"), F.lit(0.5)), 0).cast("bigint").alias("median_estimate"),
                    F.max_by("estimate", "run").alias("last_estimate"))


def monochrome_edges(edges: DataFrame, params: Params, colors: int, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(run, color, u, v)``: canonical edges whose end points share a colour, per run."""
    rows = edges.select("u", "v", F.inline(color_runs_column(params)))
    cu = node_color(F.col("u"), F.col("a"), F.col("b"), colors, p)
    cv = node_color(F.col("v"), F.col("a"), F.col("b"), colors, p)
    return rows.where(cu == cv).select("run", cu.alias("color"), "u", "v")
