"""Shared helpers: intermediate tables in the shared folder and Arrow batch plumbing."""

from __future__ import annotations

import gc
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.session import materialize, work_dir  # noqa: F401

#: Rows, and bytes of text, of one Arrow batch handled at once inside a Python task; they bound
#: the Python objects alive at a time, nothing else. A longer text is a slice of its own.
STEP = 512
STEP_BYTES = 2 << 20


_heavy: dict = {}


def held(key, make: Callable):
    """A worker's one heavy object, such as an automaton or an encoder: kept between the tasks of a stage, and
    dropped once a later stage asks for another one, before that is made."""
    if key not in _heavy:
        _heavy.clear()
        gc.collect()
        _heavy[key] = make()
    return _heavy[key]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, one that ``remove_work_dirs`` knows."""
    return work_dir(spark, f"llm-{name}")


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of any cluster, once per context:
    its sources are put into the shared folder as one archive and handed to Spark."""
    context = spark.sparkContext
    if not getattr(context, "trisk_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, f"{package.name}/{source.relative_to(package)}")
        path = context._jvm.org.apache.hadoop.fs.Path(work_path(spark, "code") + ".zip")
        stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
        stream.write(archive.getvalue())
        stream.close()
        context.addPyFile(path.toString())
        context.trisk_shipped = True
    return spark


def text_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of at most ``STEP`` rows and ``STEP_BYTES`` bytes with the texts of ``column`` (null: empty)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            fit = int(np.searchsorted(ends, before + STEP_BYTES, "right")) - at
            size = min(max(fit, 1), STEP, batch.num_rows - at)
            part = batch.slice(at, size)
            yield part, [t or "" for t in texts.slice(at, size).to_pylist()]
            at += size


def id_field(docs: DataFrame, id_col: str, name: str | None = None) -> T.StructField:
    """The id column's own type under the output name."""
    return T.StructField(name or id_col, docs.schema[id_col].dataType, True)


def columns(docs: DataFrame, **named: str) -> DataFrame:
    """Just the columns an operator reads, under its own names, whatever else is there."""
    return docs.select(*[F.col(f"`{source}`").alias(name) for name, source in named.items()])
