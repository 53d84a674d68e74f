"""Token counts by section: whole documents encoded once, tokens attributed by offset.

A document is encoded in one go, so a section's count is what it really costs inside the
document. Token byte spans follow from the ids (byte-level tokens are lossless), and they
are interval-joined to the section spans with one sorted search per document batch.

Rule for a token that crosses a boundary: it belongs to the section that holds its first
byte that is not white space, or its first byte if it is white space throughout. Newlines
between sections belong to the section before them. Counts of a document's sections
therefore sum to its token count.

Sections are the lines of a text (``lines_of``) or several named columns joined by a
newline (``field_token_counts``). Defined cases: null or empty text is one empty section
with 0 tokens; null and repeated ids and rows stay one document a row (``doc_row`` tells
equal ids apart is not needed: rows are never merged); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.bpe import default_vocab, encoder
from trisk.llm.store import columns, id_field, text_batches


def attribute(encoder_, texts: list[str], starts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of every section of every text, flat in section order.

    ``starts`` holds each text's section starts as UTF-8 byte offsets, beginning with 0.
    """
    ids, lengths = encoder_.encode(texts)
    sizes, lead = _tables(encoder_)
    token_end = np.cumsum(sizes[ids])
    token_start = token_end - sizes[ids]
    anchor = token_start + lead[ids]
    # All texts on one line of bytes: one sorted search joins tokens to sections. A text's
    # bytes are those of its tokens; empty texts have width 1 so that their section is its own.
    doc_of = np.repeat(np.arange(len(texts)), lengths)
    widths = np.bincount(doc_of, weights=sizes[ids], minlength=len(texts)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(widths + 1)])[:-1]
    n_sections = np.array([len(s) for s in starts], dtype=np.int64)
    edges = np.concatenate(starts) + np.repeat(base, n_sections) if len(starts) else np.empty(0, np.int64)
    shift = base[doc_of] - np.concatenate([[0], np.cumsum(widths)])[:-1][doc_of]
    home = np.searchsorted(edges, anchor + shift, side="right") - 1
    first = np.searchsorted(edges, token_start + shift, side="right") - 1
    last = np.searchsorted(edges, token_end - 1 + shift, side="right") - 1
    tokens = np.bincount(home, minlength=len(edges))
    crossing = np.bincount(home[first != last], minlength=len(edges))
    return tokens, crossing


def _tables(encoder_) -> tuple[np.ndarray, np.ndarray]:
    if not hasattr(encoder_, "span_tables"):
        encoder_.span_tables = (encoder_.byte_lengths(), encoder_.leading_space())
    return encoder_.span_tables


def lines_of(text: str) -> np.ndarray:
    """Byte offsets at which the lines of a text start."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return np.concatenate([[0], np.flatnonzero(raw == 10) + 1])


def line_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      vocab: str | None = None) -> DataFrame:
    """(doc_id, section, start_byte, n_bytes, n_tokens, n_crossing), one row per line of every document."""
    rows = columns(docs, doc_id=id_col, text=text_col)
    vocab = vocab or default_vocab()
    longs = ["section", "start_byte", "n_bytes", "n_tokens", "n_crossing"]
    schema = T.StructType([id_field(rows, "doc_id")] + [T.StructField(c, T.LongType()) for c in longs])

    def run(batches):
        enc = encoder(vocab)
        for batch, texts in text_batches(batches, "text"):
            starts = [lines_of(t) for t in texts]
            tokens, crossing = attribute(enc, texts, starts)
            counts = np.array([len(s) for s in starts])
            ends = np.concatenate([np.append(s[1:], len(t.encode()) + 1) - 1 for s, t in zip(starts, texts)])
            flat = np.concatenate(starts)
            section = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
            doc = batch.column(0).take(pa.array(np.repeat(np.arange(len(texts)), counts)))
            yield pa.RecordBatch.from_arrays(
                [doc] + [pa.array(x.astype(np.int64)) for x in (section, flat, ends - flat, tokens, crossing)],
                names=["doc_id", *longs])

    return rows.mapInArrow(run, schema)


def field_token_counts(rows: DataFrame, id_col: str, fields: list[str], vocab: str | None = None) -> DataFrame:
    """(doc_id, field, n_tokens, n_crossing): the named columns joined by newlines, encoded as one text."""
    vocab = vocab or default_vocab()
    picked = rows.select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.array(*[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields])
                         .alias("parts"))
    schema = T.StructType([id_field(picked, "doc_id"), T.StructField("field", T.StringType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType())])

    def run(batches):
        enc = encoder(vocab)
        for batch in batches:
            parts = batch.column(1).to_pylist()
            starts = [np.cumsum([0] + [len(x.encode()) + 1 for x in p[:-1]]) for p in parts]
            tokens, crossing = attribute(enc, ["\n".join(p) for p in parts], starts)
            doc = batch.column(0).take(pa.array(np.repeat(np.arange(len(parts)), len(fields))))
            yield pa.RecordBatch.from_arrays([doc, pa.array(fields * len(parts), pa.string()),
                                              pa.array(tokens), pa.array(crossing)], names=schema.names)

    return picked.mapInArrow(run, schema)
