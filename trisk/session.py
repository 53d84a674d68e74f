"""Session helpers: local session for tests and bench, shared work folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
_tables: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "trisk") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRISK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stopTimeout", "60s")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A session without one gets a fresh local folder, but only under a local master: on a
    cluster every executor would write to its own disk, so that raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="trisk-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """Whether a master URL runs everything in this process (``local-cluster`` does not)."""
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, for intermediate tables."""
    path = f"{checkpoint_root(spark).rstrip('/')}/trisk-{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in a fresh shared folder and read back from there."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None,
                         within: Callable[[DataFrame], DataFrame] = lambda dealt: dealt,
                         dealt: bool = False, then: Sequence[str] = ()) -> DataFrame:
    """``df`` written in a fresh shared folder as a table bucketed and sorted by ``key``, one file per
    bucket, and read back: a join on the key does not shuffle it again. ``within`` may change the
    rows of a bucket once they are together, but not their keys. What is ``dealt`` already comes
    from a join on the key with a table of as many buckets, and is written where it is. Rows of one key
    are sorted by ``then``.

    As many buckets as shuffle partitions by default, so that the planner keeps them.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, name)
    table = f"trisk_{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    (within(df if dealt else df.repartition(n, key)).write.format("parquet").bucketBy(n, key).sortBy(key, *then)
     .option("compression", "zstd").option("path", path).saveAsTable(table))
    _tables.append(table)
    return spark.table(table)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files at their end: these would stay until the driver next collects
    garbage. For writes, whose plans are not run again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def made_so_far() -> tuple[int, int]:
    """A mark for ``remove_made``: how many folders and tables there are."""
    return len(_made), len(_tables)


def remove_made(spark: SparkSession, since: tuple[int, int], keep: int = 0) -> int:
    """Delete the intermediate folders (and tables) made ``since`` a mark but the last ``keep``, each a table's;
    returns how many folders were there."""
    jvm, removed = spark.sparkContext._jvm, 0
    paths, tables = _made[since[0]:len(_made) - keep], _tables[since[1]:len(_tables) - keep]
    del _made[since[0]:len(_made) - keep], _tables[since[1]:len(_tables) - keep]
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for made in paths:
        path = jvm.org.apache.hadoop.fs.Path(made)
        removed += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return removed


def remove_work_dirs(spark: SparkSession) -> int:
    """Delete the intermediate folders (and tables) made so far, once no result reads them any
    more; returns how many folders were there."""
    return remove_made(spark, (0, 0))
