"""Per-batch bookkeeping of the stream programs, on batch-keyed tables.

A stream is seen here as a table ``(batch_id, item)``. Per-batch results are
*partials* keyed by ``batch_id``; merging partials is a plain ``groupBy().sum()``
(histograms and sketches are linear), and re-delivering a batch cannot double count
because partials are keyed, not accumulated.

The cut-off rule of the stream programs: a batch is processed only if the items of
all earlier batches number less than T; the batch crossing T is kept whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trisk.operators.sketch import in_interval
from trisk.session import materialize

def batch_lengths(batched: DataFrame, left: int, right: int) -> DataFrame:
    """``(batch_id, n, n_in)``: items per batch and items inside [left, right]."""
    return batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(in_interval(F.col("item"), left, right)).alias("n_in"))


def preceding_sum(lengths: DataFrame, value: str = "n", order: str = "batch_id",
                  blocks: int | None = None) -> DataFrame:
    """``lengths`` plus ``preceding``: sum of ``value`` over all rows of smaller ``order``
    (rows of one ``order`` in any order among themselves).

    The rows are dealt into ``blocks`` ranges of the ids that exist (default: the shuffle
    partitions), however sparse they are, and written once; a row's sum is that before it in
    its block and the blocks' totals before it, one number per block.
    """
    once = materialize(lengths, "lengths")  # the range sample reads it too
    dealt = once.repartitionByRange(blocks, order) if blocks else once.repartitionByRange(order)
    block = materialize(dealt.withColumn("_block", F.spark_partition_id()), "length-blocks")
    within = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (block.groupBy("_block").agg(F.sum(value).alias("_sum"))
              .select("_block", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_off")))
    return (block.withColumn("_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(F.broadcast(totals), "_block")  # a row per block, a parameter
            .select(*lengths.columns, (F.col("_in") + F.col("_off")).cast("bigint").alias("preceding")))


def prefix_cutoff(lengths: DataFrame, threshold: int) -> DataFrame:
    """Batches kept by the threshold rule: ``(batch_id, n, n_in, preceding)``."""
    return preceding_sum(lengths).where(F.col("preceding") < F.lit(threshold))


def batch_partials(batched: DataFrame, left: int | None = None, right: int | None = None) -> DataFrame:
    """``(batch_id, item, freq)``: per-batch histogram of the items (in the interval, if one is given)."""
    if left is not None and right is not None:
        batched = batched.where(in_interval(F.col("item"), left, right))
    return (batched.groupBy("batch_id", "item").agg(F.count(F.lit(1)).alias("freq")))


def merge_partials(partials: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """``(item, freq)``: the sum of per-batch partials, over the kept batches only."""
    if kept is not None:
        partials = partials.join(kept.select("batch_id"), "batch_id", "left_semi")
    return partials.groupBy("item").agg(F.sum("freq").cast("bigint").alias("freq"))


def distinct_items(items: DataFrame) -> DataFrame:
    """``(item)``, each once."""
    return items.select("item").distinct()


def distinct_report(items: DataFrame) -> DataFrame:
    """``(items, distinct_items, largest_item)``; the largest is NULL on an empty input."""
    per = items.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
    return per.agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("items"),
                   F.count(F.lit(1)).alias("distinct_items"),
                   F.max("item").alias("largest_item"))
