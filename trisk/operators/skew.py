"""Skew handling for joins whose key may hold a large share of all rows.

A key is heavy if it has more than ``max(threshold, total / keys)`` rows. Counts sum to
the total, so fewer than ``keys`` keys can be heavy, whatever the size of the table: the
heavy table may be broadcast without any cap, and every other key has at most
``max(threshold, total / keys)`` rows, which an ordinary shuffle deals out.

* ``heavy_keys``: that table;
* ``split_lookup``: join a big table to a one-row-per-key table. Rows of heavy keys take
  their value from the broadcast (no shuffle, no hot reducer), the others by a shuffle;
* ``salt_count``: over how many buckets a heavy key's rows are spread while the other side
  is repeated once per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many rows (or list entries, where work is what counts) a key may be split;
# fewer than HOT_KEYS keys are ever broadcast as heavy.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000


def heavy_keys(counts: DataFrame, key_cols: list[str], count_col: str,
               threshold: int = HOT_ROWS, keys: int = HOT_KEYS) -> DataFrame:
    """Keys of ``counts`` (one row per key) with more than ``max(threshold, total / keys)``.

    The total is a scalar subquery of the same plan, so nothing runs while it is built.
    """
    total = counts.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("double").alias("total")).scalar()
    return (counts.where(F.col(count_col) > F.greatest(F.lit(float(threshold)), total / F.lit(float(keys))))
            .select(*key_cols, count_col))


def salt_count(count: Column, threshold: int) -> Column:
    """Buckets for a key with ``count`` rows: ceil(count / threshold), at least 1."""
    return F.greatest(F.lit(1), F.ceil(count / F.lit(threshold))).cast("int")


def plain_lookup(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str) -> DataFrame:
    """``big`` joined to ``dim`` (one row per ``dim_key``) where no key is heavy: ``dim``, the short
    side, is hashed in each partition, so ``big`` is not sorted."""
    return big.join(dim.withColumnRenamed(dim_key, big_key).hint("shuffle_hash"), big_key)


def split_lookup(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str, value_col: str,
                 hot: DataFrame) -> DataFrame:
    """``big`` joined to ``dim(dim_key, value_col)`` (one row per key), skew-safe.

    ``hot`` holds the heavy rows of ``dim``. Returns ``big`` plus ``value_col``; rows
    without a match are dropped (inner join).
    """
    hot = F.broadcast(hot.select(F.col(dim_key).alias(big_key), F.col(value_col).alias("_hv")))
    # One pass over ``big``: heavy rows already hold their value and join the shuffled
    # side under a key that cannot match (flag 1) and that spreads them evenly.
    tagged = (big.join(hot, big_key, "left")
              .withColumn("_f", F.col("_hv").isNotNull().cast("int"))
              .withColumn("_k", F.when(F.col("_f") == 1, F.xxhash64(*big.columns))
                          .otherwise(F.col(big_key).cast("bigint"))))
    cold = dim.select(F.lit(0).alias("_f"), F.col(dim_key).cast("bigint").alias("_k"),
                      F.col(value_col).alias("_cv"))
    joined = tagged.join(cold.hint("shuffle_hash"), ["_f", "_k"], "left")
    return (joined.withColumn(value_col, F.coalesce("_hv", "_cv"))
            .where(F.col(value_col).isNotNull())
            .drop("_f", "_k", "_hv", "_cv"))
