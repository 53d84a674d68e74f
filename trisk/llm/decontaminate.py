"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark text.

Texts are lower-cased (A-Z) and reduced to words of digits, letters a-z and everything
above ASCII. Every run of ``window`` consecutive item words is a pattern; an item of fewer
words, but not none, is one pattern. Each document is scanned once; occurrences are mapped
to word numbers and, on request, to character offsets in the original text.

The patterns are collected in blocks of at most ``max_pattern_chars`` characters and each
block is broadcast as a checked-size automaton; the documents pass through the blocks one
after the other (the stated query set against all rows, in blocks), so a benchmark of any
size works and no document is ever shuffled.

Defined cases: null text has no words; null item ids are kept as patterns but not listed;
repeated items, ids and rows are fine; an empty benchmark hits nothing; an empty document
is not contaminated.
"""

from __future__ import annotations


import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import columns, held, id_field, materialize, text_batches

WINDOW = 13
MAX_PATTERN_CHARS = 4_000_000
#: 20 * n_hit >= n_words: at least a twentieth of the words.
MIN_SHARE_INVERSE = 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TO_WORDS = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                  for b in range(256))


def normal_form(text: str) -> bytes:
    """The words of a text, each with one space before and after: b' a b '; b' ' if none."""
    words = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def windows(text: str, window: int = WINDOW) -> list[bytes]:
    """The patterns of one benchmark item."""
    words = normal_form(text).split()
    if not words:
        return []
    n = max(1, len(words) - window + 1)
    return [b" " + b" ".join(words[i:i + window]) + b" " for i in range(n)]


def _automaton(patterns: tuple):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for i, (pattern, _) in enumerate(patterns):
        machine.add_word(pattern.decode("latin-1"), (i, pattern.count(b" ") - 1))
    if patterns:
        machine.make_automaton()
    return machine


def pattern_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_chars: int):
    """Yield lists of (pattern, item ids); a block's patterns hold ``max_chars`` characters and at most
    one pattern more, so that a long item is spread over blocks."""
    rows = columns(benchmark, item_id=id_col, text=text_col).filter(F.col("text").isNotNull())
    block: dict[bytes, set] = {}
    chars = 0
    for row in rows.toLocalIterator():
        for w in windows(row.text, window):
            if w not in block:
                block[w] = set()
                chars += len(w)
            if row.item_id is not None:
                block[w].add(row.item_id)
            if chars >= max_chars:
                yield sorted((p, tuple(sorted(i))) for p, i in block.items())
                block, chars = {}, 0
    if block:
        yield sorted((p, tuple(sorted(i))) for p, i in block.items())


def _scan(hay: bytes, machine, patterns) -> tuple[list, set]:
    """([first word, last word + 1] of every occurrence, merged; item ids)."""
    spans, items = [], set()
    ends = None
    for end, (i, n) in machine.iter(hay.decode("latin-1")):
        if ends is None:
            ends = np.flatnonzero(np.frombuffer(hay, dtype=np.uint8) == 32)
        last = int(np.searchsorted(ends, end))  # the pattern ends on a space: words before it
        spans.append((last - n, last))
        items.update(patterns[i][1])
    return spans, items


def _merged(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW,
                       max_pattern_chars: int = MAX_PATTERN_CHARS) -> DataFrame:
    """``docs`` with the added columns ``__n_words``, ``__spans`` (merged word ranges hit) and
    ``__items`` (ids of items with an occurring window). No row is added, dropped or moved."""
    spark = docs.sparkSession
    item_type = benchmark.schema[item_col].dataType
    span_type = T.ArrayType(T.ArrayType(T.LongType()))
    schema = T.StructType(docs.schema.fields + [T.StructField("__n_words", T.LongType()),
                                                T.StructField("__spans", span_type),
                                                T.StructField("__items", T.ArrayType(item_type))])
    blocks = 0

    def scan_with(shared, carry: bool):
        def run(batches):
            patterns = shared.value
            machine = held(patterns, lambda: _automaton(patterns))
            for batch, texts in text_batches(batches, text_col):
                n_words, spans, items = [], [], []
                before = [c.to_pylist() for c in batch.columns[-2:]] if carry else None
                for k, text in enumerate(texts):
                    hay = normal_form(text)
                    n_words.append(hay.count(b" ") - 1)
                    found, ids = _scan(hay, machine, patterns) if patterns and len(hay) > 1 else ([], set())
                    if carry:
                        found, ids = found + [tuple(s) for s in before[0][k]], ids.union(before[1][k])
                    spans.append(_merged(found))
                    items.append(sorted(ids))
                kept = batch.columns[:-3] if carry else batch.columns
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array(items, pa.list_(_arrow_type(item_type)))], names=schema.names)
        return run

    out = docs
    for patterns in pattern_blocks(benchmark, item_col, item_text_col, window, max_pattern_chars):
        if blocks:
            out = materialize(out, "decontaminate-block")
        out = out.mapInArrow(scan_with(spark.sparkContext.broadcast(tuple(patterns)), blocks > 0), schema)
        blocks += 1
    if not blocks:
        out = out.mapInArrow(scan_with(spark.sparkContext.broadcast(()), False), schema)
    return out


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def n_hit() -> F.Column:
    """Words inside any occurrence, from the merged ``__spans``."""
    return F.aggregate("__spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s[1] - s[0])


def is_contaminated(inverse: int = MIN_SHARE_INVERSE) -> F.Column:
    """The contract's rule on ``__spans`` and ``__n_words``."""
    return (n_hit() > 0) & (inverse * n_hit() >= F.col("__n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated documents; all columns as they are."""
    found = find_contamination(docs, benchmark, text_col)
    return found.filter(~is_contaminated()).select(*[F.col(f"`{c}`") for c in docs.columns])


def original_offsets(text: str, spans: list) -> list[tuple[int, int]]:
    """Character ranges in the original text of merged word ranges."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    return [(words[a][0], words[b - 1][1]) for a, b in spans]


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One digest row per document: counts, sha256 of the item ids, verdict and offsets."""
    found = find_contamination(columns(docs, doc_id=id_col, text=text_col), benchmark)
    schema = T.StructType([id_field(docs, id_col, "doc_id"), T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
                           T.StructField("items_sha256", T.StringType()),
                           T.StructField("contaminated", T.BooleanType()),
                           T.StructField("offsets", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            n_words, spans, items = (c.to_pylist() for c in batch.columns[-3:])
            hit = [sum(b - a for a, b in s) for s in spans]
            digest = [hashlib.sha256(",".join(sorted(map(str, i))).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()),
                 pa.array([len(i) for i in items], pa.int64()), pa.array(digest, pa.string()),
                 pa.array([h > 0 and MIN_SHARE_INVERSE * h >= n for h, n in zip(hit, n_words)], pa.bool_()),
                 pa.array([original_offsets(t, s) if s else [] for t, s in zip(texts, spans)],
                          pa.list_(pa.list_(pa.int64())))], names=schema.names)

    return found.mapInArrow(run, schema)
