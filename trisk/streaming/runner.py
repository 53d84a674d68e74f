"""Structured Streaming versions of the stream programs.

* Source: any streaming DataFrame of items. Either it has a ``batch_id`` (the batches of the
  data, whose rows may arrive split over files and micro-batches), or it is bare items or
  text lines, and then the micro-batch is the batch (``epoch_batches``).
* ``table_stream`` opens a table's own files, as many per micro-batch as the cluster has
  cores; ``sources.feed.replay_feed`` feeds any table by ranges of ids. The trigger is a
  parameter: processing time or availableNow.
* Per micro-batch (``foreachBatch``): lengths and interval histograms are written, in one
  job, as partials in a folder of this attempt at the epoch, then the cut's state, then one
  empty file in the commit log names the attempt (``Epochs``). Readers take the last committed
  attempt of every epoch: a replayed micro-batch replaces its own output (at-least-once
  delivery becomes effectively once), and one that fails half-way leaves the last whole one.
* Threshold T: the cut's state holds the frontier, the first batch not yet known to be whole,
  the items before it, and the lengths of batches at or after it. New lengths are added to
  those alone; whole batches without a gap move the frontier on, found by blocks of ids
  (``whole_prefix``). The query stops once the items before the frontier reach T, so the
  crossing batch is whole and so is every batch before it. A restart reads the state back.
  The result applies the same cut to the partials, so it never depends on where the query
  stopped.
* Count sketch: a stateful streaming aggregation ``groupBy(row, col).sum(sign)``; its state
  is bounded by D x W cells.
* Distinct items: ``dropDuplicates(['item'])`` appended to a parquet sink, with one state row
  per distinct item in RocksDB (off the heap, changelog checkpoints); with a threshold, the
  partials of all items give the distinct count and the largest item.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trisk.functions.hashing import DEFAULT_PRIME, draw_sketch_rows, sketch_col, sketch_rows_column, sketch_sign
from trisk.operators.batches import merge_partials, prefix_cutoff
from trisk.operators.sketch import in_interval
from trisk.sources.items import parse_items

AVAILABLE_NOW = {"availableNow": True}
PARTIALS = "kind STRING, batch_id BIGINT, item BIGINT, a BIGINT, epoch BIGINT"
STATE = "frontier BOOLEAN, batch_id BIGINT, n BIGINT, epoch BIGINT"
#: Batch ids of one block of the cut's state, and blocks walked at a time.
BLOCK = 4096
#: Sketch cells of one state partition, at least.
CELLS_PER_PARTITION = 1000
#: State off the heap, its checkpoints only what changed.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def table_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A table's Parquet files as a stream, one file per core in a micro-batch by default.

    The path is given as a pattern that matches itself, as the file source takes a table of
    a single file only by a pattern.
    """
    files = files_per_trigger or max(1, spark.sparkContext.defaultParallelism)
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
            .parquet(f"{path[:-1]}[{path[-1]}]"))


def text_items(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """A stream of text lines, one integer each, as ``(item)``; the micro-batch is the batch."""
    return parse_items(lines, value_col)


def epoch_batches(df: DataFrame, epoch_id: int) -> DataFrame:
    """Bare items of one micro-batch as ``(batch_id, item)``; data batches stay as they are."""
    return df if "batch_id" in df.columns else df.select(F.lit(epoch_id).cast("bigint").alias("batch_id"), "item")


def partials_of(batch: DataFrame, left: int | None, right: int | None) -> DataFrame:
    """``(kind, batch_id, item, a)`` of one micro-batch by one aggregation: ``hist`` rows count an item
    inside the interval (None: no bound), an ``out`` row all of a batch's items outside."""
    inside = F.lit(True) if left is None or right is None else F.coalesce(in_interval(F.col("item"), left, right), F.lit(False))
    kind = F.when(inside, F.lit("hist")).otherwise(F.lit("out")).alias("kind")
    return (batch.groupBy(kind, "batch_id", F.when(inside, F.col("item")).alias("item"))
            .agg(F.count(F.lit(1)).alias("a")))


def lengths_of(partials: DataFrame) -> DataFrame:
    """``(batch_id, n, n_in)`` of partials."""
    inside = F.when(F.col("kind") == "hist", F.col("a")).otherwise(0)
    return partials.groupBy("batch_id").agg(F.sum("a").alias("n"), F.sum(inside).alias("n_in"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of epochs with a known schema; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Epochs:
    """The commit log of a folder: per epoch, the attempts that were written to the end.

    A commit is an empty file ``commits/<epoch>.<attempt>``, made in one step after all data of
    the attempt; an epoch's attempts are numbered, and its last one counts.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(out).getFileSystem(sc._jsc.hadoopConfiguration())

    def committed(self) -> dict[int, str]:
        """Epoch to its last committed attempt."""
        folder = self._path(f"{self.out}/commits")
        if not self._fs.exists(folder):
            return {}
        names = [f.getPath().getName().split(".", 2) for f in self._fs.listStatus(folder)]
        last: dict[int, tuple[int, str]] = {}
        for epoch, number, name in names:
            last[int(epoch)] = max(last.get(int(epoch), (-1, "")), (int(number), name))
        return {epoch: f"{number}.{name}" for epoch, (number, name) in last.items()}

    def attempt(self, epoch: int) -> str:
        """A name for the next attempt at an epoch, used by no other."""
        last = self.committed().get(epoch)
        return f"{int(last.partition('.')[0]) + 1 if last else 0}.{uuid.uuid4().hex}"

    def folder(self, kind: str, epoch: int, attempt: str) -> str:
        return f"{self.out}/{kind}/epoch={epoch}/attempt={attempt}"

    def commit(self, epoch: int, attempt: str) -> None:
        self._fs.create(self._path(f"{self.out}/commits/{epoch}.{attempt}"), False).close()

    def read(self, kind: str, schema: str, epochs: list[int] | None = None) -> DataFrame:
        """The committed rows of a kind, of all epochs or of some."""
        last = self.committed()
        paths = [self.folder(kind, e, last[e]) for e in (sorted(last) if epochs is None else epochs)]
        paths = [p for p in paths if self._fs.exists(self._path(p))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        names = [f.partition(" ")[0] for f in schema.split(", ")]
        return (self.spark.read.schema(schema).option("basePath", f"{self.out}/{kind}")
                .parquet(*paths).select(*names))


def read_lengths(spark: SparkSession, out: str) -> DataFrame:
    """``(batch_id, n, n_in)`` over all committed epochs under ``out``."""
    return lengths_of(Epochs(spark, out).read("partials", PARTIALS))


def read_histogram_partials(spark: SparkSession, out: str) -> DataFrame:
    """``(batch_id, item, freq)`` over all committed epochs under ``out``."""
    return (Epochs(spark, out).read("partials", PARTIALS).where(F.col("kind") == "hist")
            .select("batch_id", "item", F.col("a").alias("freq")))


def whole_prefix(lengths: DataFrame, first: int, block: int = BLOCK) -> tuple[int, int]:
    """(next id, items): how far the whole batches ``(batch_id, n)`` go on from id ``first`` without a gap.

    Ids are dealt out by blocks; each block tells how far its ids go on from its start, one row
    per block, and the driver walks these rows, ``block`` of them at a time.
    """
    at = F.expr(f"batch_id - pmod(batch_id, {int(block)})")
    within = Window.partitionBy("start").orderBy("batch_id")
    rows = (lengths.where(F.col("batch_id") >= first).select("batch_id", "n", at.alias("start"))
            .withColumn("nth", F.row_number().over(within) - 1)
            .withColumn("from", F.greatest("start", F.lit(first))))
    told = (rows.where(F.col("batch_id") == F.col("from") + F.col("nth"))
            .groupBy("start", "from").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")))
    here, items = first, 0
    while True:
        chunk = told.where(F.col("start") >= here - here % block).orderBy("start").limit(block).collect()
        begun = here
        for r in chunk:
            if r["from"] != here:
                return here, items
            here, items = here + r.k, items + r.n
            if here != r.start + block:
                return here, items
        if here == begun or len(chunk) < block:
            return here, items


class Cut:
    """The threshold rule over a growing stream, as a state table per epoch.

    A data batch is whole once it has ``batch_rows`` items; without that number only bare
    streams, whose batch is the micro-batch, can stop early, and others run to their end.
    """

    def __init__(self, out: str, threshold: int, batch_rows: int | None = None):
        self.out, self.threshold, self.batch_rows = out, threshold, batch_rows

    def advance(self, epochs: Epochs, lengths: DataFrame, epoch_id: int, attempt: str, bare: bool) -> bool:
        """Write the state after ``epoch_id``, whose ``lengths`` are (batch_id, n); whether the
        crossing batch is whole."""
        spark = epochs.spark
        earlier = [e for e in epochs.committed() if e < epoch_id]
        old = epochs.read("state", STATE, [max(earlier)] if earlier else [])
        mark = old.where("frontier").first() if earlier else None
        # A bare stream's epochs are its batches: one without items is an empty batch.
        frontier, before = (mark.batch_id, mark.n) if mark else (0, 0)
        rest = None
        if bare:
            frontier, before = epoch_id + 1, before + (lengths.agg(F.sum("n")).first()[0] or 0)
        else:
            pending = (old.where("NOT frontier").select("batch_id", "n").unionByName(lengths.select("batch_id", "n"))
                       .groupBy("batch_id").agg(F.sum("n").alias("n")))
            frontier, items = whole_prefix(pending.where(F.col("n") >= self.batch_rows), frontier)
            before += items
            rest = pending.where(F.col("batch_id") >= frontier)
        state = spark.createDataFrame([(True, frontier, before)], "frontier BOOLEAN, batch_id BIGINT, n BIGINT")
        if rest is not None:
            state = state.unionByName(rest.select(F.lit(False).alias("frontier"), "batch_id", "n"))
        state.write.mode("overwrite").parquet(epochs.folder("state", epoch_id, attempt))
        return before >= self.threshold


class PartialWriter:
    """``foreachBatch`` callback writing the partials, and the cut's state, of one micro-batch."""

    def __init__(self, out: str, left: int | None, right: int | None, threshold: int | None = None,
                 batch_rows: int | None = None):
        self.out, self.left, self.right = out, left, right
        self.cut = Cut(out, threshold, batch_rows) if threshold is not None else None
        self.done = threading.Event()
        self.error: BaseException | None = None

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        try:
            if self.done.is_set():
                return  # the cut is decided: later batches are skipped
            epochs, bare = Epochs(df.sparkSession, self.out), "batch_id" not in df.columns
            attempt = epochs.attempt(epoch_id)
            path, crossed = epochs.folder("partials", epoch_id, attempt), False
            (partials_of(epoch_batches(df, epoch_id), self.left, self.right)
             .write.mode("overwrite").parquet(path))
            if self.cut is not None and (bare or self.cut.batch_rows):
                lengths = lengths_of(_read(df.sparkSession, path, PARTIALS.rpartition(",")[0]))
                crossed = self.cut.advance(epochs, lengths, epoch_id, attempt, bare)
            epochs.commit(epoch_id, attempt)
            if crossed:
                self.done.set()
        except BaseException as exc:  # surfaced by run_query
            self.error = exc
            raise


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over as it starts, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a query's state: every micro-batch opens and commits all of them, so one per core,
    and no more than the shuffle partitions. A checkpoint keeps the number it began with."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, spark.sparkContext.defaultParallelism))


def run_query(writer, stop: threading.Event | None = None, poll: float = 0.2) -> list[dict]:
    """Run a query to its end (availableNow) or until ``stop`` is set; the progress reports of its last
    micro-batches (``spark.sql.streaming.numRecentProgressUpdates``)."""
    query = writer.start()
    try:
        while query.isActive:
            if stop is not None and stop.is_set():
                query.stop()
                break
            query.awaitTermination(poll)
        exc = query.exception()
        if exc is not None:
            raise RuntimeError(f"streaming query failed: {exc}")
        return [p for p in query.recentProgress]
    finally:
        if query.isActive:
            query.stop()


def stream_partials(stream: DataFrame, out: str, left: int | None = None, right: int | None = None,
                    threshold: int | None = None, batch_rows: int | None = None,
                    trigger: dict = AVAILABLE_NOW) -> PartialWriter:
    """Run ``stream`` writing lengths and histogram partials under ``out``."""
    sink = PartialWriter(out, left, right, threshold, batch_rows)
    writer = (stream.writeStream.foreachBatch(sink)
              .option("checkpointLocation", f"{out}/_checkpoint").trigger(**trigger))
    run_query(writer, sink.done)
    if sink.error is not None:
        raise sink.error
    return sink


def stream_sketch_cells(stream: DataFrame, out: str, depth: int, width: int, left: int | None = None,
                        right: int | None = None, seed: int | None = 0, p: int = DEFAULT_PRIME,
                        trigger: dict = AVAILABLE_NOW) -> DataFrame:
    """Stateful count sketch of the items (in the interval, if one is given): ``(row, col, c)``."""
    rows = draw_sketch_rows(depth, seed, p)
    if left is not None and right is not None:
        stream = stream.where(in_interval(F.col("item"), left, right))
    upd = (stream.select("item", F.inline(F.array(*sketch_rows_column(rows))))
           .select("row", sketch_col(F.col("item"), F.col("ah"), F.col("bh"), width, p).alias("col"),
                   sketch_sign(F.col("item"), F.col("ag"), F.col("bg"), p).alias("sign")))
    cells = upd.groupBy("row", "col").agg(F.sum("sign").cast("bigint").alias("c"))

    def write_cells(df: DataFrame, epoch_id: int) -> None:
        # Complete mode: the whole (bounded, D x W) table in a folder of its epoch, so that
        # a crash while writing leaves the last whole one.
        df.write.mode("overwrite").parquet(f"{out}/cells/epoch={epoch_id}")

    parts = min(state_partitions(stream.sparkSession), -(-depth * width // CELLS_PER_PARTITION))
    with session_conf(stream.sparkSession, {"spark.sql.shuffle.partitions": str(parts)}):
        run_query(cells.writeStream.outputMode("complete").foreachBatch(write_cells)
                  .option("checkpointLocation", f"{out}/_checkpoint").trigger(**trigger))
    spark = stream.sparkSession
    written = _read(spark, f"{out}/cells", "row INT, col BIGINT, c BIGINT, epoch BIGINT")
    last = written.agg(F.max("epoch").alias("e")).scalar()
    return written.where(F.col("epoch") == last).drop("epoch")


def stream_distinct(stream: DataFrame, out: str, trigger: dict = AVAILABLE_NOW) -> DataFrame:
    """Distinct items of a stream, appended to a parquet sink at ``out/items``.

    State holds one key per distinct item, in RocksDB: a task's memory does not grow with them.
    A second call with the same ``out`` goes on where the first one stopped.
    """
    run_distinct(stream, out, trigger)
    return _read(stream.sparkSession, f"{out}/items", "item BIGINT")


def run_distinct(stream: DataFrame, out: str, trigger: dict = AVAILABLE_NOW) -> list[dict]:
    """The query of ``stream_distinct``; its progress reports."""
    parts = {"spark.sql.shuffle.partitions": str(state_partitions(stream.sparkSession))}
    with session_conf(stream.sparkSession, ROCKSDB | parts):
        return run_query(stream.select("item").dropDuplicates(["item"])
                         .writeStream.outputMode("append").format("parquet")
                         .option("path", f"{out}/items").option("checkpointLocation", f"{out}/_checkpoint")
                         .trigger(**trigger))


def state_rows(progress: list[dict]) -> int:
    """Rows that a query's state holds after its last micro-batch."""
    return sum(op["numRowsTotal"] for op in progress[-1]["stateOperators"]) if progress else 0


def stream_distinct_report(stream: DataFrame, out: str, threshold: int, batch_rows: int | None = None,
                           trigger: dict = AVAILABLE_NOW) -> DataFrame:
    """``(items, distinct_items, largest_item)`` of the batches the threshold keeps."""
    spark = stream.sparkSession
    stream_partials(stream, out, threshold=threshold, batch_rows=batch_rows, trigger=trigger)
    kept = prefix_cutoff(read_lengths(spark, out), threshold)
    hist = merge_partials(read_histogram_partials(spark, out), kept)
    return hist.agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("items"),
                    F.count(F.lit(1)).alias("distinct_items"), F.max("item").alias("largest_item"))
