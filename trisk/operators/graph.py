"""Undirected simple graphs as edge tables, degree orientation and triangle counts.

Data model: a canonical edge table ``(u, v)`` with ``u < v`` and no repeats (repeats and
reversals collapse, self-loops never count).

Counting follows the node-iterator with degree ordering (Schank & Wagner 2005; Suri &
Vassilvitskii 2011): each edge is oriented from the lower to the higher ``(degree, id)``,
so every node has out-degree at most sqrt(2m): a list of at most 4.5 million ids even for
10^13 edges. Each triangle x < y < z (in that order) is found exactly once, at its edge
x -> y, as a common out-neighbour z of x and y.

``directed_lists`` builds every node's out-neighbours once, in that order, ``node_work`` the number
of entries that other lists send to each node, and ``live_members`` the members of each list
that have a list themselves: only there can a wedge close. All are written as one table bucketed
by node, so a count reads the held side of its join without an exchange; what a colouring or
a partition of the edges keeps is filtered out of the sending lists before they move. A list
meets the lists of its live members by one join: the row of x sends to each such member y what
comes after y in x's list, which is all that y's list can have in common with it there.

Skew: a hub is a member of very many lists. Nodes that are sent more than ``hot_work`` entries
are heavy and few (``heavy_keys``): their rows take a join of their own, spread over salt
buckets by the sender, with their own (short) list repeated once per bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisk.operators.skew import HOT_KEYS, HOT_ROWS, heavy_keys, plain_lookup, salt_count, split_lookup
from trisk.operators.util import combine_rows
from trisk.session import materialize

# List entries (8 bytes each) sent to one node that one task may hold.
HOT_WORK = 16_000_000


def canonical_edges(raw: DataFrame, src: str = "src", dst: str = "dst", by_end: int | None = None) -> DataFrame:
    """Raw directed pairs to the canonical undirected edge set ``(u, v)``, u < v.

    Pairs are dealt out before repeats are dropped: a task of raw pairs that hardly repeat would
    fill, spill and sort a hash table for nothing. With ``by_end`` they are dealt by u into that
    many partitions, where they are sorted, and an edge then is; without, by both ends, which no node can fill.
    """
    pairs = (raw.where(F.col(src) != F.col(dst))
             .select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")))
    if by_end is None:
        return pairs.repartition("u", "v").distinct()
    before = F.lag("v").over(Window.partitionBy("u").orderBy("v"))
    return (pairs.repartition(by_end, "u").select("u", "v", before.alias("before"))
            .where("before IS NULL OR before <> v").drop("before"))


# Cells that the ends of raw pairs are counted in: more than heavy keys can be.
END_CELLS = 1 << 15


def raw_ends(raw: DataFrame, src: str = "src", dst: str = "dst", cells: int = END_CELLS) -> tuple[int, int, int]:
    """The number of raw pairs, and of those at most that one node is the smaller end of, and the larger:
    counts by a hash of it, so that a task sends ``2 * cells`` rows at most."""
    def cell(end: Column) -> Column:
        return F.pmod(F.xxhash64(end), F.lit(cells))

    ends = raw.select(F.explode(F.array(cell(F.least(src, dst)), cell(F.greatest(src, dst)) + cells)).alias("cell"))
    counts = ends.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).groupBy((F.col("cell") >= cells).alias("larger"))
    found = {r.larger: r for r in counts.agg(F.sum("n").alias("pairs"), F.max("n").alias("most")).collect()}
    return (found[False].pairs, found[False].most, found[True].most) if found else (0, 0, 0)


def edge_counts(raw: DataFrame, src: str = "src", dst: str = "dst", edges: DataFrame | None = None) -> DataFrame:
    """``(raw_edges, edges)`` of raw pairs in one pass: all rows, and canonical edges. Where these are
    written already they are given as ``edges`` and counted there."""
    if edges is not None:
        return combine_rows([raw.agg(F.count(F.lit(1)).alias("raw_edges")), edges.agg(F.count(F.lit(1)).alias("edges"))])
    pairs = (raw.groupBy(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
             .agg(F.count(F.lit(1)).alias("n")))
    return pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("raw_edges"),
                     F.count_if(F.col("u") != F.col("v")).alias("edges"))


def degrees(edges: DataFrame) -> DataFrame:
    """``(node, degree)`` of a canonical edge table (partial aggregation)."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def degrees_in_place(edges: DataFrame, parts: int) -> DataFrame:
    """``degrees``, dealt by node, of edges that are bucketed by u into ``parts`` buckets: u's are counted
    there, and v's are dealt as they are, which hardly repeat in a bucket; none may be heavy."""
    up = edges.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("up"))
    down = edges.select(F.col("v").alias("node")).repartition(parts, "node").groupBy("node").agg(F.count(F.lit(1)).alias("down"))
    return up.join(down, "node", "full").select(
        "node", (F.coalesce("up", F.lit(0)) + F.coalesce("down", F.lit(0))).cast("bigint").alias("degree"))


def hubs_of(deg: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame | None:
    """The heavy rows of ``(node, degree)``, or None if there are none."""
    hot = heavy_keys(deg, ["node"], "degree", hot_rows, hot_keys)
    return None if hot.isEmpty() else hot


def orient(edges: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Orient canonical edges by ``(degree, id)``: ``(src, dst, dsrc, ddst)``.

    Degrees are counted once and read back by both ends' lookups and the search for hubs; only
    a graph that has hubs pays for keeping their rows apart.
    """
    deg = materialize(degrees(edges), "degrees")
    return orient_by(edges, deg, hubs_of(deg, hot_rows, hot_keys))


def orient_by(edges: DataFrame, deg: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """``orient`` with the written degrees and their heavy rows, which both lookups and those of lists share."""
    both = edges
    for end, name in (("u", "du"), ("v", "dv")):
        dim = deg.select("node", F.col("degree").alias(name))
        both = (plain_lookup(both, dim, end, "node") if hubs is None else
                split_lookup(both, dim, end, "node", name, hubs.select("node", F.col("degree").alias(name))))
    forward = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))

    def pick(a: str, b: str):
        return F.when(forward, F.col(a)).otherwise(F.col(b))

    return both.select(pick("u", "v").alias("src"), pick("v", "u").alias("dst"),
                       pick("du", "dv").alias("dsrc"), pick("dv", "du").alias("ddst"))


def directed_lists(edges: DataFrame, deg: DataFrame, hubs: DataFrame | None, parts: int) -> DataFrame:
    """``(src, nb)``: every node's out-neighbours in ascending ``(degree, id)``, dealt by node.

    ``deg(node, degree)`` is bucketed by node into ``parts`` buckets. An edge is told to v with u's degree, where
    v's is known: if v comes first it stays, else it goes back to u. So it moves once, and a second time only
    where u comes first; edges that are bucketed by u are not dealt by u again. A hub comes after all
    others, and its degree is broadcast: its edges go to their sources at once.
    """
    du, dv = (deg.select(F.col("node").alias(end), F.col("degree").alias("d" + end)).hint("shuffle_hash") for end in "uv")
    cold = edges
    for end in ("u", "v") if hubs is not None else ():
        cold = cold.join(F.broadcast(hubs.select(F.col("node").alias(end))), end, "left_anti")
    met = cold.join(du, "u").repartition(parts, "v").join(dv, "v")
    stay = met.where("dv < du").select(F.col("v").alias("src"), F.col("du").alias("ddst"), F.col("u").alias("dst"))
    back = met.where("du <= dv").select(F.col("u").alias("src"), F.col("dv").alias("ddst"), F.col("v").alias("dst"))
    if hubs is not None:
        back = back.unionByName(_to_hubs(edges, hubs))

    def packed(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("src").agg(F.collect_list(F.struct("ddst", "dst")).alias(name))

    none = F.expr("CAST(array() AS array<struct<ddst:bigint,dst:bigint>>)")
    both = packed(stay, "stay").join(packed(back.repartition(parts, "src"), "back"), "src", "full")
    ranked = F.sort_array(F.concat(F.coalesce("stay", none), F.coalesce("back", none)))
    return both.select("src", ranked["dst"].alias("nb"))


def _to_hubs(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """``(src, ddst, dst)`` of the edges that have a hub as an end: to it, or of two hubs to the later one."""
    both = edges
    for end in ("u", "v"):
        both = both.join(F.broadcast(hubs.select(F.col("node").alias(end), F.col("degree").alias("d" + end))), end, "left")
    # An end that is no hub has no degree here, and comes first.
    forward = F.col("dv").isNotNull() & (F.col("du").isNull() | (F.col("du") <= F.col("dv")))
    return both.where("du IS NOT NULL OR dv IS NOT NULL").select(
        F.when(forward, F.col("u")).otherwise(F.col("v")).alias("src"),
        F.when(forward, F.col("dv")).otherwise(F.col("du")).alias("ddst"),
        F.when(forward, F.col("v")).otherwise(F.col("u")).alias("dst"))


def adjacency_degree(edges: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``(node, degree, out_degree)``: undirected degree and out-degree after orientation.

    One aggregation over both ends of the oriented edges (partial aggregation, so a
    hub costs one row per task), no join back to a degree table.
    """
    oriented = orient(edges, hot_rows, hot_keys)
    ends = oriented.select(F.inline(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("out")),
                                            F.struct(F.col("dst").alias("node"), F.lit(0).alias("out")))))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"),
                                    F.sum("out").cast("bigint").alias("out_degree"))


def node_work(lists: DataFrame) -> DataFrame:
    """``(src, work)``: list entries that other nodes' lists send to each node."""
    sent = lists.select(F.posexplode("nb").alias("at", "dst"), F.size("nb").alias("n"))
    return (sent.where(F.col("at") < F.col("n") - 1)
            .groupBy(F.col("dst").alias("src")).agg(F.sum(F.col("n") - F.col("at") - 1).alias("work")))


# Nodes without a list that may be broadcast to tell live members; more are looked up by a shuffle.
SINKS = 1_000_000


def live_members(lists: DataFrame, work: DataFrame, parts: int, hubs: DataFrame | None = None,
                 sinks: int = SINKS) -> DataFrame:
    """``(src, dst, at)``: every member of a list that has a list itself and members after it, and its place.

    ``lists`` and ``work(src, work)`` are bucketed by node, so the members without a list are found in place. Up to
    ``sinks`` of them are broadcast and no list entry moves; if they are more, every entry asks for
    its member by a shuffle, and what is live comes back to ``parts`` partitions by node.
    """
    asked = (lists.select("src", F.posexplode("nb").alias("at", "dst"), F.size("nb").alias("n"))
             .where(F.col("at") < F.col("n") - 1).select("src", "dst", "at"))
    without = work.join(lists.select("src"), "src", "left_anti").select(F.col("src").alias("dst"))
    if without.limit(sinks + 1).count() <= sinks:
        return asked.join(F.broadcast(without), "dst", "left_anti").select("src", "dst", "at")
    held = lists.select(F.col("src").alias("node"), F.lit(True).alias("held"))
    if hubs is None:
        return plain_lookup(asked, held, "dst", "node").select("src", "dst", "at").repartition(parts, "src")
    known = hubs.select("node").join(held, "node", "left").select("node", F.coalesce("held", F.lit(False)).alias("held"))
    return (split_lookup(asked, held, "dst", "node", "held", known).where("held").select("src", "dst", "at")
            .repartition(parts, "src"))


def with_members(lists: DataFrame, live: DataFrame, work: DataFrame) -> DataFrame:
    """``(src, nb, at, work)``, one row per node that has a list or is in one that sends to it: its list (or
    an empty one), the places in it of its ``live`` members, and its work. All three are dealt by node
    already, and stay where they are."""
    told = live.groupBy("src").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return lists.join(told, "src", "left").join(work, "src", "full").select(
        "src", F.coalesce("nb", F.expr("CAST(array() AS array<bigint>)")).alias("nb"),
        F.coalesce("at", F.expr("CAST(array() AS array<int>)")).alias("at"),
        F.coalesce("work", F.lit(0)).cast("bigint").alias("work"))


def wedges(lists: DataFrame, label: Callable[[str], Column] | None = None,
           alike: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(src, dst, mark, rest)``: what each list sends to its live members, as far as any is left.

    ``label`` gives a column of members a value, and ``alike`` says by the values of dst, its ``mark``,
    and of a member after it whether that member is sent; without them all are. Pairs of members are
    compared as rows, by compiled code (a filter of arrays is interpreted), and packed again where they are.
    """
    live = lists.where(F.size("at") > 0)
    if label is None:
        return live.select("src", "nb", F.explode("at").alias("at")).select(
            "src", F.get("nb", F.col("at")).alias("dst"), F.slice("nb", F.col("at") + 2, F.size("nb")).alias("rest"))
    pairs = (live.select("src", "nb", F.explode("at").alias("at"))
             .select("src", F.get("nb", F.col("at")).alias("dst"),
                     F.explode(F.slice("nb", F.col("at") + 2, F.size("nb"))).alias("third")))
    return (pairs.where(alike(label("dst"), label("third"))).groupBy("src", "dst")
            .agg(F.collect_list("third").alias("rest")).select("src", "dst", label("dst").alias("mark"), "rest"))


def close_wedges(sent: DataFrame, lists: DataFrame, hot_work: int = HOT_WORK, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``sent(dst, rest, ...)`` where dst has a list, with what of rest is in that list, each a triangle, as
    ``common`` in place of rest. ``lists(src, nb, work)`` holds whole lists, bucketed by node."""
    kept = [c for c in sent.columns if c != "rest"]
    return meet_lists(sent, lists, hot_work, hot_keys).select(*kept, F.array_intersect("own", "rest").alias("common"))


def each_of(common: str) -> Column:
    """A row per element. Spark filters a plain column by its size first, which would intersect twice."""
    return F.explode(F.slice(common, 1, F.size(common)))


def meet_lists(sent: DataFrame, lists: DataFrame, hot_work: int = HOT_WORK, hot_keys: int = HOT_KEYS) -> DataFrame:
    """The rows of ``sent(dst, ...)`` whose dst has a list, with that list as ``own``; a node is sent at
    most its work."""
    work = lists.where((F.col("work") > 0) & (F.size("nb") > 0)).select("src", "work")
    heavy = F.broadcast(heavy_keys(work, ["src"], "work", hot_work, hot_keys)
                        .select(F.col("src").alias("dst"), salt_count(F.col("work"), hot_work).alias("salts")))
    held = (lists.where((F.col("work") > 0) & (F.size("nb") > 0))  # no other node is sent anything
            .select(F.col("src").alias("dst"), F.col("nb").alias("own")))
    cold = sent.join(heavy, "dst", "left_anti").join(held, "dst")
    salted = (sent.join(heavy, "dst")
              .select(*sent.columns, F.pmod(F.xxhash64(*sent.columns), F.col("salts")).cast("int").alias("salt")))
    repeated = (held.join(heavy, "dst")
                .select("dst", "own", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    hot = salted.join(repeated, ["dst", "salt"]).drop("salt")
    return cold.unionByName(hot)


def count_wedges(closed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., triangles)`` of closed wedges."""
    return closed.groupBy(*keys).agg(
        F.coalesce(F.sum(F.size("common")), F.lit(0)).cast("bigint").alias("triangles"))
