"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the test tables.

Inputs (see FIXTURES.md): the order graph of ``lineitem`` (order - part, part - supplier
and order - supplier per row), the edge text ``l_partkey,l_suppkey``, and the item stream
``events.user_id`` cut into batches of 1,250 events. Every query reads the whole
tables; parameters are the fixed values of ``trisk.plans.params``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.operators import batches as B
from trisk.operators import graph as G
from trisk.operators import sketch as S
from trisk.operators import triangles as TR
from trisk.plans import params as PR
from trisk.sources import table
from trisk.session import work_dir
from trisk.sources.edges import edge_text_from_lineitem, order_pairs, parse_edges, read_edge_text
from trisk.sources.feed import replay_feed
from trisk.sources.items import batched_events, item_text, parse_items
from trisk.streaming import runner as ST

Query = Callable[[SparkSession, str], DataFrame]


def bigints(df: DataFrame) -> DataFrame:
    """Integral columns as BIGINT, so that result schemas are stable."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, small)
                       else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """DOUBLE columns rounded, as results are compared by value."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- inputs

def _lineitem(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _graph(spark, sf_dir) -> DataFrame:
    return G.canonical_edges(order_pairs(_lineitem(spark, sf_dir)))


def _lists(spark, sf_dir) -> DataFrame:
    return TR.prepare_pairs(order_pairs(_lineitem(spark, sf_dir)))


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


def _items(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("user_id").alias("item"))


def _hist(spark, sf_dir) -> DataFrame:
    return S.histogram(_items(spark, sf_dir))


def _batched(spark, sf_dir) -> DataFrame:
    return batched_events(_events(spark, sf_dir), PR.BATCH_ROWS)


def _stream(spark, sf_dir) -> DataFrame:
    """The events table fed as a stream of (batch_id, item), by ranges of event ids over MICRO_BATCHES
    micro-batches; a batch may be split over two of them."""
    feed = replay_feed(_events(spark, sf_dir).select("event_id", "user_id"), "event_id", PR.MICRO_BATCHES)
    return batched_events(feed, PR.BATCH_ROWS)


# ---------------------------------------------------------------- graph programs

def edge_list_parse(spark, sf_dir):
    return parse_edges(edge_text_from_lineitem(_lineitem(spark, sf_dir)))


def edge_text_scan(spark, sf_dir):
    """The edge text written as files and read back from them, as the programs' input is."""
    path = work_dir(spark, "edge-text")
    edge_text_from_lineitem(_lineitem(spark, sf_dir)).write.text(path)
    return parse_edges(read_edge_text(spark, path))


def edge_count(spark, sf_dir):
    return G.edge_counts(edge_list_parse(spark, sf_dir))


def edges_canonical(spark, sf_dir):
    return _graph(spark, sf_dir)


def adjacency_degree(spark, sf_dir):
    return G.adjacency_degree(_graph(spark, sf_dir))


def node_color(spark, sf_dir):
    return bigints(TR.node_colors(_graph(spark, sf_dir), PR.color_params(), PR.COLORS, PR.P))


def monochrome_edges(spark, sf_dir):
    return bigints(TR.monochrome_edges(_graph(spark, sf_dir), PR.color_params(), PR.COLORS, PR.P))


def edge_partition_sizes(spark, sf_dir):
    return TR.partition_sizes(_graph(spark, sf_dir), PR.COLORS, PR.SEED, PR.P)


def color_triple_edges(spark, sf_dir):
    a, b = PR.color_params()[0]
    return TR.color_triple_counts(_graph(spark, sf_dir), a, b, PR.COLORS, PR.P)


def color_triple_report(spark, sf_dir):
    a, b = PR.color_params()[0]
    return rounded(bigints(TR.color_triple_report(_graph(spark, sf_dir), a, b, PR.COLORS, PR.P)))


def triangles_exact(spark, sf_dir):
    return TR.exact_count(_lists(spark, sf_dir))


def triangles_by_color(spark, sf_dir):
    return bigints(TR.triangles_by_color(_lists(spark, sf_dir), PR.color_params(), PR.COLORS, PR.P))


def triangles_color_estimate(spark, sf_dir):
    return bigints(TR.color_estimates(_lists(spark, sf_dir), PR.color_params(), PR.COLORS, PR.P))


def triangles_color_median(spark, sf_dir):
    est = TR.color_estimates(_lists(spark, sf_dir), PR.color_params(), PR.COLORS, PR.P)
    return TR.median_estimate(est)


def triangles_partition_estimate(spark, sf_dir):
    return TR.partition_estimate(_lists(spark, sf_dir), PR.COLORS, PR.SEED, PR.P)


def triangles_exact_colored(spark, sf_dir):
    a, b = PR.color_params()[0]
    return TR.exact_by_color_triples(_lists(spark, sf_dir), a, b, PR.COLORS, PR.P)


def triangles_per_triple_key(spark, sf_dir):
    a, b = PR.color_params()[0]
    return TR.exact_by_color_triples_per_key(_lists(spark, sf_dir), a, b, PR.COLORS, PR.P)


def triangle_report(spark, sf_dir):
    raw = order_pairs(_lineitem(spark, sf_dir))
    edges, deg, n = TR.write_graph(raw)
    return bigints(TR.triangle_report(G.edge_counts(raw, edges=edges),
                                      TR.prepare(edges, buckets=n, written=True, deg=deg), PR.COLORS, PR.RUNS, PR.SEED, PR.P))


def run_report(spark, sf_dir):
    return bigints(TR.run_results(_lists(spark, sf_dir), PR.COLORS, PR.RUNS, PR.SEED, PR.P))


# ---------------------------------------------------------------- stream programs, on tables

def item_parse(spark, sf_dir):
    return parse_items(item_text(_events(spark, sf_dir), "user_id"))


def interval_items(spark, sf_dir):
    return _items(spark, sf_dir).where(S.in_interval(F.col("item"), PR.LEFT, PR.RIGHT))


def item_histogram(spark, sf_dir):
    return _hist(spark, sf_dir)


def item_hashes(spark, sf_dir):
    return bigints(S.item_hashes(_hist(spark, sf_dir), PR.DEPTH, PR.WIDTH, PR.SEED, PR.P))


def stream_lengths(spark, sf_dir):
    it = _items(spark, sf_dir)
    return it.agg(F.count(F.lit(1)).alias("items"),
                  F.count_if(S.in_interval(F.col("item"), PR.LEFT, PR.RIGHT)).alias("items_in_interval"))


def sketch_cells(spark, sf_dir):
    return bigints(S.sketch_cells(_hist(spark, sf_dir), PR.DEPTH, PR.WIDTH, PR.SEED, PR.P))


def _cells(spark, sf_dir):
    hist = _hist(spark, sf_dir)
    return hist, S.sketch_cells(hist, PR.DEPTH, PR.WIDTH, PR.SEED, PR.P)


def sketch_estimates(spark, sf_dir):
    hist, cells = _cells(spark, sf_dir)
    return S.estimates(hist, cells, PR.DEPTH, PR.WIDTH, PR.SEED, PR.P)


def f2_exact(spark, sf_dir):
    return rounded(S.f2_exact(_hist(spark, sf_dir)))


def f2_sketch(spark, sf_dir):
    hist, cells = _cells(spark, sf_dir)
    return rounded(S.f2_sketch(cells, S.f2_exact(hist).select("items")))


def topk_items(spark, sf_dir):
    hist, cells = _cells(spark, sf_dir)
    return bigints(S.top_k_estimates(hist, cells, PR.TOP_K, PR.DEPTH, PR.WIDTH, PR.SEED, PR.P))


def topk_avg_error(spark, sf_dir):
    hist, cells = _cells(spark, sf_dir)
    return rounded(S.avg_error(S.top_k_estimates(hist, cells, PR.TOP_K, PR.DEPTH, PR.WIDTH,
                                                 PR.SEED, PR.P)))


def sketch_report(spark, sf_dir):
    return rounded(bigints(S.sketch_report(_items(spark, sf_dir), PR.DEPTH, PR.WIDTH, PR.LEFT,
                                           PR.RIGHT, PR.TOP_K, PR.SEED, PR.P)))


def sketch_tradeoff(spark, sf_dir):
    items = _lineitem(spark, sf_dir).select(F.col("l_partkey").alias("item"))
    return rounded(bigints(S.tradeoff(S.histogram(items), PR.TRADEOFF_GRID, PR.TOP_K, PR.SEED, PR.P)))


def distinct_items(spark, sf_dir):
    return B.distinct_items(_items(spark, sf_dir))


def distinct_report(spark, sf_dir):
    return B.distinct_report(_items(spark, sf_dir))


def batch_lengths(spark, sf_dir):
    return B.batch_lengths(_batched(spark, sf_dir), PR.LEFT, PR.RIGHT)


def batch_prefix_cutoff(spark, sf_dir):
    return B.prefix_cutoff(B.batch_lengths(_batched(spark, sf_dir), PR.LEFT, PR.RIGHT), PR.THRESHOLD)


def batch_partials_merge(spark, sf_dir):
    return B.merge_partials(B.batch_partials(_batched(spark, sf_dir)))


# ---------------------------------------------------------------- stream programs, streaming

def stream_histogram(spark, sf_dir):
    out = work_dir(spark, "hist")
    ST.stream_partials(_stream(spark, sf_dir), out)
    return B.merge_partials(ST.read_histogram_partials(spark, out))


def stream_sketch_cells(spark, sf_dir):
    return bigints(ST.stream_sketch_cells(_stream(spark, sf_dir), work_dir(spark, "cells"), PR.DEPTH, PR.WIDTH,
                                          seed=PR.SEED, p=PR.P))


def stream_distinct(spark, sf_dir):
    return ST.stream_distinct(_stream(spark, sf_dir), work_dir(spark, "distinct"))


def stream_distinct_report(spark, sf_dir):
    return ST.stream_distinct_report(_stream(spark, sf_dir), work_dir(spark, "distinct"), PR.THRESHOLD, PR.BATCH_ROWS)


def stream_prefix_cutoff(spark, sf_dir):
    out = work_dir(spark, "cutoff")
    ST.stream_partials(_stream(spark, sf_dir), out, PR.LEFT, PR.RIGHT, PR.THRESHOLD, PR.BATCH_ROWS)
    kept = B.prefix_cutoff(ST.read_lengths(spark, out), PR.THRESHOLD)
    hist = B.merge_partials(ST.read_histogram_partials(spark, out), kept)
    total = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("items"))
    return rounded(bigints(S.report_from_histogram(hist, total, PR.DEPTH, PR.WIDTH, PR.LEFT,
                                                   PR.RIGHT, PR.TOP_K, PR.SEED, PR.P)))


QUERIES: dict[str, Query] = {
    "edge_list_parse": edge_list_parse,
    "edge_text_scan": edge_text_scan,
    "edge_count": edge_count,
    "edges_canonical": edges_canonical,
    "adjacency_degree": adjacency_degree,
    "node_color": node_color,
    "monochrome_edges": monochrome_edges,
    "edge_partition_sizes": edge_partition_sizes,
    "color_triple_edges": color_triple_edges,
    "color_triple_report": color_triple_report,
    "triangles_exact": triangles_exact,
    "triangles_by_color": triangles_by_color,
    "triangles_color_estimate": triangles_color_estimate,
    "triangles_color_median": triangles_color_median,
    "triangles_partition_estimate": triangles_partition_estimate,
    "triangles_exact_colored": triangles_exact_colored,
    "triangles_per_triple_key": triangles_per_triple_key,
    "triangle_report": triangle_report,
    "run_report": run_report,
    "item_parse": item_parse,
    "interval_items": interval_items,
    "item_histogram": item_histogram,
    "item_hashes": item_hashes,
    "stream_lengths": stream_lengths,
    "sketch_cells": sketch_cells,
    "sketch_estimates": sketch_estimates,
    "f2_exact": f2_exact,
    "f2_sketch": f2_sketch,
    "topk_items": topk_items,
    "topk_avg_error": topk_avg_error,
    "sketch_report": sketch_report,
    "sketch_tradeoff": sketch_tradeoff,
    "distinct_items": distinct_items,
    "distinct_report": distinct_report,
    "batch_lengths": batch_lengths,
    "batch_prefix_cutoff": batch_prefix_cutoff,
    "batch_partials_merge": batch_partials_merge,
    "stream_histogram": stream_histogram,
    "stream_sketch_cells": stream_sketch_cells,
    "stream_distinct": stream_distinct,
    "stream_distinct_report": stream_distinct_report,
    "stream_prefix_cutoff": stream_prefix_cutoff,
}
