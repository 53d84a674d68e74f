"""Token ids as ORC files: run-length encoded id lists, row indexes, Bloom filters on ids.

``write_token_files`` sorts whole documents by id over a range partitioning, encodes
each text once in its sorted partition and writes ORC. ORC itself run-length encodes the
integer lists per stripe, keeps a row index every ``ROW_INDEX_STRIDE`` rows and a Bloom
filter on ``doc_id``; readers take stripes in parallel and ``lookup`` skips stripes and
row groups by those. Every row carries its file part and the number of ids before it in
that part, so the global start of a document is that plus one small prefix sum over
parts; no pass over all rows in one task.

Defined cases: null or empty text is the end id alone; null ids sort first; repeated ids
and rows each get their own row, in any order among themselves; an empty table gives an
empty result. One id on a third of all rows is split by a hash of the text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.bpe import default_vocab, encoder
from trisk.llm.store import columns, id_field, text_batches

END_ID = 0
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 64 << 20


def _schema(id_type: T.StructField) -> T.StructType:
    return T.StructType([id_type, T.StructField("part", T.IntegerType()), T.StructField("part_start", T.LongType()),
                         T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids", T.ArrayType(T.IntegerType(), False))])


def encode_documents(docs: DataFrame, vocab: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, text) rows to (doc_id, part, part_start, n_tokens, ids), order kept."""

    def run(batches):
        enc, part, before = encoder(vocab), TaskContext.get().partitionId(), 0
        for batch, texts in text_batches(batches, "text"):
            ids, lengths = enc.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                lengths = lengths + 1
            ends = np.cumsum(lengths)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.full(len(texts), part, dtype=np.int32)),
                pa.array(before + ends - lengths), pa.array(lengths),
                pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"])
            before += int(ends[-1]) if len(ends) else 0

    return docs.mapInArrow(run, _schema(id_field(docs, "doc_id")))


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      vocab: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every document to ORC files under ``path``, ascending by id."""
    rows = columns(docs, doc_id=id_col, text=text_col)
    ordered = (rows.withColumn("spread", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("spread"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first()).select("doc_id", "text"))
    (encode_documents(ordered, vocab or default_vocab(), end_id).write
     .option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.row.index.stride", str(ROW_INDEX_STRIDE)).option("orc.stripe.size", str(STRIPE_BYTES))
     .orc(path))


def read_token_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The files' rows as they are; column and stripe pruning apply."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.orc(path)


def lookup(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """The rows of a few document ids; stripes and row groups without them are skipped."""
    return read_token_files(spark, path).filter(F.col("doc_id").isin(ids))


def part_bases(rows: DataFrame) -> DataFrame:
    """(part, base): ids in all earlier parts. One row per file part, so its window is small."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
            .select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base")))


def document_digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from rows read back from the files."""
    schema = T.StructType([id_field(rows, "doc_id"), T.StructField("part", T.IntegerType()),
                           T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "part", "part_start")]
                + [pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], names=schema.names)

    digests = rows.select("doc_id", "part", "part_start", "ids").mapInArrow(run, schema)
    return (digests.join(part_bases(rows), "part")
            .select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                vocab: str | None = None) -> DataFrame:
    """Write the files, read them back and return one digest row per document."""
    write_token_files(docs, path, id_col, text_col, vocab)
    schema = _schema(id_field(docs, id_col, "doc_id"))
    return document_digests(read_token_files(docs.sparkSession, path, schema))
