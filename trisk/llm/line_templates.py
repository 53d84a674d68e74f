"""Line dedup by a log-template tree.

Every line with words is parsed down a tree of fixed depth: by its number of tokens, then by
its first ``DEPTH`` tokens, tokens with a digit generalised to ``<*>``. In a leaf, lines are
compared with the leaf's templates position by position: a line joins the most similar
template if at least ``SIMILARITY`` of the positions hold the same fixed token, and positions
that differ become ``<*>``; otherwise it starts a template. Templates that occur in at least
``MIN_DOCS`` different documents are boilerplate, and all their lines are dropped. Short lines
can meet by chance, long ones do not: with ``long_docs``, templates of more than ``LONG_TOKENS``
fixed tokens recur from that many documents on.

Documents with the same text count as one, so copies of a whole document do not make its
lines boilerplate.

Distribution. Only leaves that several documents reach are looked at; their distinct
generalised lines are dealt by leaf, since any line may join a template of any other one. Only
lines with fewer fixed tokens than a join asks for, which stay alone, are dealt by themselves.
A line is compared with all templates of its leaf; beyond ``LEAF_LINES`` of them, an index of
tokens by position leaves out those that cannot be similar enough, which changes no result. A
task holds the distinct lines of its largest leaf. Templates that are equal, or similar by the
same rule in a second round over templates, become one. Lines are taken in text order, so the
result is the same at every run. The two joins that move text are merge joins at every size,
so that small inputs plan like large ones.

Defined cases: null or empty text has no lines; lines without words are never dropped; null
or repeated ids and repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import materialize, text_batches

DEPTH = 3
SIMILARITY = 0.6
MIN_DOCS = 6
LONG_TOKENS = 50
LONG_DOCS = 2
#: Templates of one leaf from which on an index picks those to compare; no bound on either.
LEAF_LINES = 2000
#: Rows of one batch that a task hands on.
BATCH_ROWS = 4096
ANY = "<*>"
_DIGIT = re.compile(r"\d")


def generalised(line: str) -> str:
    """The tokens of a line joined by single spaces, those with a digit as ``<*>``; '' if none."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [ANY if _DIGIT.search(t) else t for t in tokens]
    return " ".join(tokens)


def leaf_of(line: str, depth: int = DEPTH) -> int:
    """Hash of a generalised line's place in the tree."""
    head = " ".join(line.split(" ", depth)[:depth])
    return _hash(f"{line.count(' ') + 1} {head}")


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


class Leaf:
    """The templates of one leaf, as token codes; -1 stands for any token."""

    def __init__(self, n_tokens: int, similarity: float = SIMILARITY, leaf_lines: int = LEAF_LINES):
        self.need = similarity * n_tokens
        self.leaf_lines = leaf_lines
        self.codes: dict[str, int] = {ANY: -1}
        self.rows = np.empty((4, n_tokens), dtype=np.int64)
        self.n = 0
        # By (position, code) the templates that started or were indexed with it.
        self.places: dict[tuple[int, int], list[int]] | None = None

    def add(self, line: str) -> int:
        """Number of the template that the line joins or starts."""
        codes = [self.codes.setdefault(t, len(self.codes)) for t in line.split(" ")]
        row = np.array(codes, dtype=np.int64)
        near = self._near(codes)
        held = self.rows[:self.n] if near is None else self.rows[near]
        if len(held):
            same = ((held == row) & (held >= 0)).sum(axis=1)
            best = int(same.argmax())
            # Lines without any fixed token are alike if their signs are.
            if same[best] >= self.need or (held[best] == row).all():
                best = best if near is None else int(near[best])
                self.rows[best][self.rows[best] != row] = -1
                return best
        if self.n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[self.n] = row
        self.n += 1
        if self.places is not None:
            self._index(self.n - 1, codes)
        return self.n - 1

    def _index(self, number: int, codes: list[int]) -> None:
        for at, code in enumerate(codes):
            if code >= 0:
                self.places.setdefault((at, code), []).append(number)

    def _near(self, codes: list[int]) -> np.ndarray | None:
        """The templates that a line can join, in order; None for all.

        One with ``need`` tokens of the line's f fixed ones has at least one of any
        f - need + 1 of them, so the rarest of those are looked up. Templates only lose
        tokens, so none is missed.
        """
        if self.n <= self.leaf_lines:
            return None
        if self.places is None:
            self.places = {}
            for number, row in enumerate(self.rows[:self.n].tolist()):
                self._index(number, row)
        lists = sorted((self.places.get((at, code), ()) for at, code in enumerate(codes) if code >= 0), key=len)
        lists = [x for x in lists[:max(len(lists) - math.ceil(self.need) + 1, 0)] if x]
        return np.unique(np.concatenate(lists)) if lists else np.empty(0, dtype=np.int64)

    def templates(self) -> list[str]:
        """The templates' text."""
        names = {code: token for token, code in self.codes.items()}
        return [" ".join(names[c] for c in row) for row in self.rows[:self.n].tolist()]


def cluster(lines: DataFrame, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """(leaf, line) rows, distinct, to (leaf, line_hash, line, template): each line's template."""

    def run(batches):
        key, leaf, members, out = None, None, [], []

        def done():
            texts = leaf.templates()
            out.extend((key[0], _hash(m), m, texts[k]) for m, k in members)

        def made():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            for at in range(0, len(out), BATCH_ROWS):
                columns = zip(*out[at:at + BATCH_ROWS])
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                                 names=["leaf", "line_hash", "line", "template"])
            out.clear()

        for batch in batches:
            for leaf_key, alone, line in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (leaf_key, alone) != key:
                    if members:
                        done()
                    if len(out) >= BATCH_ROWS:
                        yield from made()
                    key, leaf, members = (leaf_key, alone), Leaf(line.count(" ") + 1, leaf_lines=leaf_lines), []
                members.append((line, leaf.add(line)))
        if members:
            done()
        yield from made()

    # A line with fewer fixed tokens than a join asks for neither joins nor is joined.
    alone = F.when(fixed_tokens("line") < F.lit(SIMILARITY) * F.size(F.split("line", " ")), F.xxhash64("line"))
    return (lines.select("leaf", alone.alias("alone"), "line").repartition("leaf", "alone")
            .sortWithinPartitions("leaf", "alone", "line").mapInArrow(run, "leaf long, line_hash long, line string, template string"))


def fixed_tokens(line: str) -> Column:
    """Tokens of a column of generalised lines or templates that are not ``<*>``."""
    return F.size(F.array_remove(F.split(line, " "), ANY))


def text_key(text_col: str) -> Column:
    """The document a row counts as: its text."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def recurring_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                    leaf_lines: int = LEAF_LINES, long_docs: int | None = None) -> DataFrame:
    """(doc, lines): by text key, the numbers of the lines whose template recurs."""
    rows = docs.select(text_key(text_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))

    def parse(batches, with_text: bool):
        for batch, texts in text_batches(batches, "text"):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                for number, raw in enumerate(text.split("\n")):
                    line = generalised(raw)
                    if line:
                        out.append((doc, number, leaf_of(line), _hash(line), line))
            names = ["doc", "number", "leaf", "line_hash", "line"][:5 if with_text else 4]
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kinds[k]) for k in range(len(names))],
                                             names=names)

    places = materialize(rows.mapInArrow(lambda b: parse(b, False),
                                         "doc long, number long, leaf long, line_hash long"), "line-places")
    # Leaves that documents of different texts reach.
    shared = (places.groupBy("leaf").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
              .filter(F.col("low") != F.col("high")).select("leaf"))
    texts = (rows.mapInArrow(lambda b: parse(b, True),
                             "doc long, number long, leaf long, line_hash long, line string")
             .select("leaf", "line").join(shared.hint("merge"), "leaf", "left_semi"))
    lines = materialize(texts.distinct(), "leaf-lines")
    first = materialize(cluster(lines, leaf_lines), "templates")
    second = (cluster(first.select("leaf", F.col("template").alias("line")).distinct(), leaf_lines)
              .select("leaf", F.col("line").alias("template"), F.col("template").alias("final")))
    keyed = materialize(first.join(second, ["leaf", "template"])
                        .select("leaf", "line_hash", F.xxhash64("final").alias("template"),
                                (fixed_tokens("final") > LONG_TOKENS).alias("long")), "line-templates")
    found = places.join(keyed, ["leaf", "line_hash"]).select("doc", "number", "leaf", "template", "long")
    enough = F.when(F.col("long"), min_docs if long_docs is None else long_docs).otherwise(min_docs)
    often = materialize(found.select("leaf", "template", "long", "doc").distinct().groupBy("leaf", "template", "long")
                        .agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= enough)
                        .select("leaf", "template"), "recurring-templates")
    return (found.join(often, ["leaf", "template"]).groupBy("doc")
            .agg(F.collect_set("number").alias("lines")))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
               leaf_lines: int = LEAF_LINES, long_docs: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every document without its recurring lines."""
    marks = materialize(recurring_lines(docs, text_col, min_docs, leaf_lines, long_docs), "recurring-lines")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       text_key(text_col).alias("doc")).join(marks.hint("merge"), "doc", "left").select(
        "doc_id", "text", "lines")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            out = []
            for text, gone in zip(texts, batch.column(2).to_pylist()):
                gone = set(gone or ())
                every = text.split("\n") if text else []
                kept = [x for k, x in enumerate(every) if k not in gone] if gone else every
                out.append((len(every), len(every) - len(kept), "\n".join(kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
