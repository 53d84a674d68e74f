"""Exact frequencies, the count sketch and the second moment F2 of an item table.

Data model (all tables, none collected):

* items      ``(item BIGINT)`` — one row per stream element;
* histogram  ``(item, freq)`` — exact counts, from a partially aggregated ``groupBy``;
* cells      ``(row, col, c)`` — the D x W signed counter matrix, sparse; a cell that
  some item reached keeps its row even when its sum is 0.

The sketch is built from the histogram, not from the raw items: each distinct item
adds ``sign * freq`` to one cell per row. This is the same matrix (the sketch is
linear) and a hot item costs one row per sketch row instead of one per occurrence.

Estimates are the median over rows of ``sign_j(x) * C[j, h_j(x)]``,
mean of the two middle values when D is even, truncated toward zero; F2 is divided by
the squared number of items; the sketch F2 is the median over rows of the sum of
squared cells. Squares are taken as DECIMAL(38, 0), so sums of them are exact for any
BIGINT counts of up to 10^19 items. Empty inputs give NULL ratios, not a division error.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisk.functions.hashing import (
    DEFAULT_PRIME,
    SketchRow,
    draw_sketch_rows,
    sketch_col,
    sketch_sign,
    sketch_rows_column,
)
from trisk.operators.util import combine_rows, require_positive
from trisk.session import materialize


def in_interval(item: Column, left: int, right: int) -> Column:
    """Both ends included."""
    return item.between(F.lit(left), F.lit(right))


def histogram(items: DataFrame, item_col: str = "item") -> DataFrame:
    """``(item, freq)`` exact frequencies."""
    return items.groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("freq"))


def _rows_of(depth_or_rows, seed, p) -> list[SketchRow]:
    if isinstance(depth_or_rows, int):
        require_positive(depth=depth_or_rows)
        return draw_sketch_rows(depth_or_rows, seed, p)
    return list(depth_or_rows)


def _hashed(hist: DataFrame, rows: list[SketchRow], width: int, p: int) -> DataFrame:
    """histogram x sketch rows (a literal generate, D rows per item): adds row, col, sign."""
    out = hist.select("*", F.inline(F.array(*sketch_rows_column(rows))))
    return out.select(
        *hist.columns, "row",
        sketch_col(F.col("item"), F.col("ah"), F.col("bh"), width, p).alias("col"),
        sketch_sign(F.col("item"), F.col("ag"), F.col("bg"), p).alias("sign"))


def item_hashes(hist: DataFrame, depth: int, width: int, seed: int | None = 0,
                p: int = DEFAULT_PRIME) -> DataFrame:
    """``(item, row, col, sign)`` for every distinct item and sketch row."""
    rows = _rows_of(depth, seed, p)
    return _hashed(hist.select("item"), rows, width, p)


def sketch_cells(hist: DataFrame, depth: int, width: int, seed: int | None = 0,
                 p: int = DEFAULT_PRIME) -> DataFrame:
    """``(row, col, c)`` count-sketch cells of a histogram."""
    rows = _rows_of(depth, seed, p)
    require_positive(width=width)
    return (_hashed(hist, rows, width, p)
            .groupBy("row", "col")
            .agg(F.sum(F.col("sign") * F.col("freq")).cast("bigint").alias("c")))


def estimates(hist: DataFrame, cells: DataFrame, depth: int, width: int,
              seed: int | None = 0, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(item, freq, est)``: sketch estimate of every item of ``hist``."""
    rows = _rows_of(depth, seed, p)
    probes = _hashed(hist, rows, width, p)
    joined = probes.join(cells, ["row", "col"])
    return (joined.groupBy("item", "freq")
            .agg(F.percentile(F.col("sign") * F.col("c"), F.lit(0.5)).cast("bigint").alias("est")))


def _squares(value: str) -> Column:
    """Sum of squares of a BIGINT column, exact, as DOUBLE."""
    wide = F.col(value).cast("decimal(19,0)")
    return F.sum((wide * wide).cast("decimal(38,0)")).cast("double")


def _over_square(value: Column, count: Column) -> Column:
    """``value / count^2`` as DOUBLE; NULL for a count of 0."""
    wide = count.cast("double")
    return F.try_divide(value, wide * wide)


def f2_exact(hist: DataFrame) -> DataFrame:
    """``(items, f2)``: sum of squared frequencies over the squared item count."""
    return hist.agg(
        F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("items"),
        _over_square(_squares("freq"), F.sum("freq")).alias("f2"))


def f2_sketch(cells: DataFrame, items: DataFrame) -> DataFrame:
    """``(f2_sketch)``: median over rows of the sum of squared cells, over items^2.
    ``items`` is a one-row frame with column ``items`` (the number of elements)."""
    per_row = cells.groupBy("row").agg(_squares("c").alias("s"))
    med = per_row.agg(F.percentile(F.col("s"), F.lit(0.5)).alias("m"))
    both = combine_rows([med, items.select("items")])
    return both.select(_over_square(F.col("m"), F.col("items")).alias("f2_sketch"))


def top_k(hist: DataFrame, k: int) -> DataFrame:
    """``(rank, item, freq)``: the K most frequent items, ties by smaller item first.


    ``orderBy(...).limit(K)`` plans as a per-partition top-K plus one K-row merge;
    ranking the K survivors is a window over K rows only.
    """
    require_positive(k=k)
    top = hist.orderBy(F.col("freq").desc(), F.col("item").asc()).limit(k)
    w = Window.orderBy(F.col("freq").desc(), F.col("item").asc())
    return top.select(F.row_number().over(w).alias("rank"), "item", "freq")


def top_k_estimates(hist: DataFrame, cells: DataFrame, k: int, depth: int, width: int,
                    seed: int | None = 0, p: int = DEFAULT_PRIME) -> DataFrame:
    """``(rank, item, freq, est)`` for the top-K items (only K items are estimated)."""
    top = top_k(hist, k)
    est = estimates(top, cells, depth, width, seed, p)
    return top.join(F.broadcast(est.select("item", "est")), "item").select("rank", "item", "freq", "est")


def avg_error(top: DataFrame) -> DataFrame:
    """``(avg_error)``: mean of |freq - est| / freq over the given rows."""
    return top.agg(F.avg(F.abs(F.col("freq") - F.col("est")) / F.col("freq")).alias("avg_error"))


def sketch_report(items: DataFrame, depth: int, width: int, left: int, right: int, k: int,
                  seed: int | None = 0, p: int = DEFAULT_PRIME,
                  item_col: str = "item") -> DataFrame:
    """One row as the stream program prints it at the end:
    D, W, left, right, K, items, items in the interval, distinct items in the interval,
    average error of the top K, exact F2 and its sketch estimate."""
    every = materialize(histogram(items, item_col), "histogram")  # one scan of the items
    total = every.agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("items"))
    hist = every.where(in_interval(F.col("item"), left, right))
    return report_from_histogram(hist, total, depth, width, left, right, k, seed, p)


def report_from_histogram(hist: DataFrame, total: DataFrame, depth: int, width: int,
                          left: int, right: int, k: int, seed: int | None = 0,
                          p: int = DEFAULT_PRIME) -> DataFrame:
    """The sketch report from an interval histogram and a one-row ``(items)`` total."""
    cells = sketch_cells(hist, depth, width, seed, p)
    exact = f2_exact(hist)
    inter = exact.select(F.col("items").alias("items_in_interval"), "f2")
    distinct = hist.agg(F.count(F.lit(1)).alias("distinct_in_interval"))
    fsk = f2_sketch(cells, exact.select("items"))
    err = avg_error(top_k_estimates(hist, cells, k, depth, width, seed, p))
    return combine_rows([total.select("items"), inter, distinct, err, fsk]).select(
        F.lit(depth).alias("d"), F.lit(width).alias("w"), F.lit(left).cast("bigint").alias("left_end"),
        F.lit(right).cast("bigint").alias("right_end"), F.lit(k).alias("k"),
        "items", "items_in_interval", "distinct_in_interval", "avg_error", "f2", "f2_sketch")


def _base_configs(configs: list[tuple[int, int]]) -> dict[int, list[int]]:
    """Per configuration that is no multiple's divisor at its depth, the configurations folded from it.

    The rows of one depth share their draws, so where W' divides W, a cell of W' is the sum of
    the cells of W that are equal to it mod W'.
    """
    out: dict[int, list[int]] = {}
    for i, (d, w) in sorted(enumerate(configs), key=lambda c: -c[1][1]):
        base = next((j for j in out if configs[j][0] == d and configs[j][1] % w == 0), i)
        out.setdefault(base, []).append(i)
    return out


def fold_cells(cells: DataFrame, configs: list[tuple[int, int]]) -> DataFrame:
    """``(cfg, row, col, c)`` of every configuration from the cells of the base ones."""
    folds = [(base, i, configs[i][1]) for base, many in _base_configs(configs).items() for i in many]
    table = F.array(*[F.struct(F.lit(b).cast("int").alias("base"), F.lit(i).cast("int").alias("to"),
                               F.lit(w).cast("bigint").alias("width")) for b, i, w in folds])
    own = F.filter(table, lambda f: f["base"] == F.col("cfg"))
    return (cells.select("row", "col", "c", F.inline(own))
            .groupBy(F.col("to").alias("cfg"), "row", F.pmod("col", "width").cast("bigint").alias("col"))
            .agg(F.sum("c").cast("bigint").alias("c")))


def tradeoff(hist: DataFrame, configs: list[tuple[int, int]], k: int, seed: int | None = 0,
             p: int = DEFAULT_PRIME) -> DataFrame:
    """Space-accuracy trade-off: one job for a whole grid of (D, W).

    ``(cfg, d, w, avg_error, f2, f2_sketch)`` per configuration. Every item is hashed once
    per row of every base configuration (a literal generate); the other widths of a depth are
    folded from its cells, D x W rows, and only the top-K items are estimated.
    """
    for d, w in configs:
        require_positive(depth=d, width=w)

    def structs(which: Iterable[int]) -> Column:
        return F.array(*[
            F.struct(F.lit(i).cast("int").alias("cfg"), F.lit(configs[i][0]).cast("int").alias("d"),
                     F.lit(configs[i][1]).cast("int").alias("w"), F.lit(r.row).cast("int").alias("row"),
                     F.lit(r.ah).cast("bigint").alias("ah"), F.lit(r.bh).cast("bigint").alias("bh"),
                     F.lit(r.ag).cast("bigint").alias("ag"), F.lit(r.bg).cast("bigint").alias("bg"))
            for i in which for r in draw_sketch_rows(configs[i][0], seed, p)])

    def hashed(frame: DataFrame, which: Iterable[int]) -> DataFrame:
        return (frame.select("*", F.inline(structs(which)))
                .select(*frame.columns, "cfg", "d", "w", "row",
                        sketch_col(F.col("item"), F.col("ah"), F.col("bh"), F.col("w"), p).alias("col"),
                        sketch_sign(F.col("item"), F.col("ag"), F.col("bg"), p).alias("sign")))

    base = (hashed(hist, _base_configs(configs)).groupBy("cfg", "row", "col")
            .agg(F.sum(F.col("sign") * F.col("freq")).cast("bigint").alias("c")))
    cells = fold_cells(base, configs)
    top = top_k(hist, k)
    est = (hashed(top, range(len(configs))).join(cells, ["cfg", "row", "col"])
           .groupBy("cfg", "item", "freq")
           .agg(F.percentile(F.col("sign") * F.col("c"), F.lit(0.5)).cast("bigint").alias("est")))
    err = est.groupBy("cfg").agg(
        F.avg(F.abs(F.col("freq") - F.col("est")) / F.col("freq")).alias("avg_error"))
    sq = (cells.groupBy("cfg", "row").agg(_squares("c").alias("s"))
          .groupBy("cfg").agg(F.percentile(F.col("s"), F.lit(0.5)).alias("m")))
    # the exact F2 is one row: spread it over the grid with a literal generate
    grid = F.array(*[F.struct(F.lit(i).cast("int").alias("cfg"), F.lit(d).cast("int").alias("d"),
                              F.lit(w).cast("int").alias("w")) for i, (d, w) in enumerate(configs)])
    out = (f2_exact(hist).select("items", "f2", F.inline(grid))
           .join(err, "cfg", "left").join(sq, "cfg", "left"))
    return out.select(
        "cfg", "d", "w", "avg_error", "f2",
        _over_square(F.col("m"), F.col("items")).alias("f2_sketch"))
