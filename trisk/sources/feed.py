"""A table replayed as a feed: a stream of files cut by ranges of an order column.

Spark's file source does the rest: its log of files is the offset, a checkpoint replays the
same files after a failure, and the files per trigger are the admission control.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from trisk.session import work_dir


def replay_feed(table: DataFrame, order: str, micro_batches: int, files_per_batch: int | None = None) -> DataFrame:
    """``table`` as a stream of about ``micro_batches`` micro-batches, each a range of ``order``.

    The rows are written once in the shared folder, range by range, ``files_per_batch`` files
    to a micro-batch (default: one per core), so that a micro-batch is read in parallel. Rows of
    one value of ``order`` are in one file; files come in any order.
    """
    spark = table.sparkSession
    files = files_per_batch or max(1, spark.sparkContext.defaultParallelism)
    path = work_dir(spark, "feed")
    table.repartitionByRange(micro_batches * files, order).write.parquet(path)
    return (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files)
            .parquet(path))
