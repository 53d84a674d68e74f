"""Quality rules: an isolation forest over rule statistics, calibrated on labelled rows.

Rule statistics are counted for every whole document. An isolation forest is grown on the
statistics of labelled good documents: each tree splits a random subset at random values of
random statistics, so odd documents end up alone after few splits. The verdict threshold on
the path-length score starts where at most ``MAX_FALSE`` of the labelled good documents are
rejected and is raised as far as no labelled bad document is lost by it; with no labels of
both kinds nothing is rejected by score. Base rules (too short, too much repetition) hold
besides, and rows that they decide take no part in the fit.

The forest is fitted on at most ``SAMPLE_ROWS`` labelled rows, taken in hash order; all
other counts cover every document. Scoring is one pass without a shuffle.

Defined cases: null or empty text has no words and fails the base rule; null labels are
skipped; a document labelled twice counts as bad if either label says so; null and repeated
ids and rows are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import columns, id_field, text_batches

MIN_WORDS = 20
#: 100 * n_repeat_words > 30 * n_words fails.
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Labelled rows the forest and its threshold are fitted on, at most.
SAMPLE_ROWS = 20_000
TREES = 100
TREE_ROWS = 256
#: Share of labelled good documents that the threshold may reject.
MAX_FALSE = 0.005
SEED = 8

_SPACE = bytes([9, 10, 11, 12, 13, 32])
_SYMBOLS = b"#*$%&|<>"
_MULTIPLIERS = np.random.default_rng(1).integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def repeated_window_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    rolled = h[:n] * _MULTIPLIERS[0]
    for k in range(1, window):
        rolled = rolled + h[k:k + n] * _MULTIPLIERS[k]
    in_order = np.sort(rolled)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return 0  # equal windows have equal hashes, so there are none
    at = np.flatnonzero(np.isin(rolled, twice)).tolist()
    exact = [tuple(words[i:i + window]) for i in at]
    seen = Counter(exact)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    for i, w in zip(at, exact):
        if seen[w] > 1:
            marks[i] += 1
            marks[i + window] -= 1
    return int((np.cumsum(marks)[:-1] > 0).sum())


def rule_counts(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """(the COUNTS of a text, its statistics for the forest)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, len(raw) - len(raw.translate(None, _SYMBOLS)), 0, 0), (0.0,) * len(STATISTICS)
    n_space = len(raw) - len(raw.translate(None, _SPACE))
    word_chars = len(text) - n_space
    n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_window_words(words)
    n_upper = len(raw) - len(raw.translate(None, _UPPER))
    n_digits = len(raw) - len(raw.translate(None, _DIGITS))
    n_bang = raw.count(b"!") + raw.count(b"?")
    common = Counter(words).most_common(1)[0][1]
    chars = max(word_chars, 1)
    return ((n, word_chars, n_symbols, n_dup, n_repeat),
            (float(np.log1p(n)), word_chars / n, n_symbols / n, n_dup / max(len(lines), 1), n_repeat / n,
             n_upper / chars, n_digits / chars, n_bang / n, common / n, n / max(len(lines), 1)))


STATISTICS = ("log_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
              "digit_share", "bangs_per_word", "top_word_share", "words_per_line")


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    """Too few words, or too many of them in repeated windows."""
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` keys."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class IsolationForest:
    """Trees as arrays: split statistic (-1: leaf), value, left child, depth plus the leaf's mean path."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    norm: float
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / norm): near 1 odd, below 0.5 ordinary."""
        if not len(self.roots):
            return np.zeros(len(x))
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            split = self.feature[node]
            inner = split >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(split, 0)] >= self.value[node]
            node = np.where(inner, self.left[node] + right, node)
        return 2.0 ** (-self.length[node].mean(axis=1) / self.norm)


def fit_forest(x: np.ndarray, bad: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS,
               max_false: float = MAX_FALSE, seed: int = SEED) -> IsolationForest:
    """Grow the forest on the good rows of ``x`` and set its threshold by ``bad``."""
    rng = np.random.default_rng(seed)
    good = x[~bad]
    feature, value, left, length, roots = [], [], [], [], []

    def add(depth: int, n: int) -> int:
        feature.append(-1)
        value.append(0.0)
        left.append(0)
        length.append(depth + float(_mean_path(n)))
        return len(feature) - 1

    n_rows = min(tree_rows, len(good))
    limit = int(np.ceil(np.log2(max(n_rows, 2))))
    for _ in range(trees if n_rows > 1 else 0):
        sample = good[rng.choice(len(good), n_rows, replace=False)]
        roots.append(add(0, n_rows))
        todo = [(roots[-1], sample, 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            # Constant statistics may split too: a value beyond the seen one is odd.
            f = int(rng.integers(part.shape[1]))
            if depth >= limit or len(part) < 2:
                continue
            spread = high[f] - low[f]
            v = rng.uniform(low[f], high[f]) if spread > 0 else np.nextafter(high[f], np.inf)
            right = part[:, f] >= v
            feature[at], value[at], left[at] = f, v, len(feature)
            for side in (part[~right], part[right]):
                child = add(depth + 1, len(side))
                if len(side):
                    todo.append((child, side, depth + 1))
    forest = IsolationForest(np.array(feature, dtype=int), np.array(value), np.array(left, dtype=int),
                             np.array(length), np.array(roots, dtype=int), float(max(_mean_path(n_rows), 1)), np.inf)
    if not len(roots) or not bad.any():
        return forest
    good_scores = np.sort(forest.scores(good))
    threshold = good_scores[min(len(good) - 1, int(np.ceil(len(good) * (1 - max_false))))]
    bad_scores = forest.scores(x[bad])
    caught = bad_scores[bad_scores > threshold]
    if len(caught):
        threshold = max(threshold, good_scores[max(0, np.searchsorted(good_scores, caught.min()) - 1)])
    return IsolationForest(**{**forest.__dict__, "threshold": float(threshold)})


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    max_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, is bad) of at most ``max_rows`` labelled documents in hash order of id and statistics."""
    by_hash = F.xxhash64(F.lit(SEED), "doc_id")
    picked = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(by_hash, "doc_id").limit(max_rows))
    rows = columns(docs, doc_id=id_col, text=text_col).join(F.broadcast(picked), "doc_id")
    stats = T.StructType([id_field(rows, "doc_id"), T.StructField("quality", T.IntegerType()),
                          T.StructField("failed", T.BooleanType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            counted = [rule_counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()),
                 pa.array([base_failed(c[0], c[4]) for c, _ in counted], pa.bool_()),
                 pa.array([s for _, s in counted], pa.list_(pa.float64()))], names=stats.names)

    found = (rows.select("doc_id", "text", "quality").mapInArrow(run, stats).filter("NOT failed")
             .orderBy(by_hash, "doc_id", "x").limit(max_rows).collect())
    x = np.array([r.x for r in found], dtype=float).reshape(len(found), len(STATISTICS))
    return x, np.array([r.quality == 0 for r in found], dtype=bool)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = SAMPLE_ROWS) -> IsolationForest:
    """The calibrated forest for a corpus and its labels (doc_id, quality 0 or 1)."""
    return fit_forest(*labelled_sample(docs, labels, id_col, text_col, max_rows))


def _verdicts(texts: list[str], forest: IsolationForest):
    counted = [rule_counts(t) for t in texts]
    failed = np.array([base_failed(c[0], c[4]) for c, _ in counted], dtype=bool)
    scores = forest.scores(np.array([s for _, s in counted]).reshape(len(texts), len(STATISTICS)))
    return counted, failed, scores, ~failed & (scores <= forest.threshold)


def judge(docs: DataFrame, forest: IsolationForest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept, score), one row per document."""
    rows = columns(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([id_field(rows, "doc_id")] + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                             T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # TREES * 2 * TREE_ROWS nodes at most

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            counted, failed, scores, kept = _verdicts(texts, shared.value)
            counts = np.array([c for c, _ in counted], dtype=np.int64).reshape(len(texts), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[:, k]) for k in range(len(COUNTS))],
                 pa.array(failed), pa.array(kept), pa.array(scores)], names=schema.names)

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, forest: IsolationForest, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected documents; all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch, texts in text_batches(batches, text_col):
            yield batch.filter(pa.array(_verdicts(texts, shared.value)[3]))

    return docs.mapInArrow(run, docs.schema)
