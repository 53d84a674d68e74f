"""Periodic runs of words, found by recompression.

A run is a stretch of words with smallest period q (words q apart are identical) of at least
``max(MIN_WORDS, MIN_EXPONENT * q)`` words, as long as neither neighbouring word keeps the
period. The words of many texts are numbered and laid out in one line with a separator of
its own between any two, so that nothing crosses texts.

Recompression (``Grammar``). The line is rewritten level by level: maximal blocks of one
symbol become a (symbol, length) symbol, then pairs of a left and a right symbol, by a random
division of the symbols, become one symbol, and so on in turn until no symbol repeats. Equal
stretches are rewritten alike but for a few symbols at their ends. The levels together are a
run-length grammar of linear size.

Longest common extensions. Two places move through their parse trees together: up where both
begin equal parents, ahead where their symbols are equal (through the shorter of two blocks
at once), else down; at level 0 the first difference is found. The same walk on last
children extends to the left.

Candidates. A run of period q covers two neighbouring points of the grid of multiples of q,
with equal words at them and at the next one. Such points are extended to both sides; their
number over all q is harmonic, n/1 + n/2 + ... A stretch found with several periods keeps
the smallest one, which divides the others (Fine and Wilf). Points inside a run already
known by a divisor of their period are passed over.

Texts are handled ``WORDS_AT_ONCE`` words at a time, a longer text by itself.

Defined cases: null and empty texts have no words, no runs, and collapse to the empty string;
null or repeated ids and rows are ordinary rows; an empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import columns, id_field

MIN_WORDS = 24
MIN_EXPONENT = 3
#: Words of one line, and places extended at a time; bounds of memory, not of results.
WORDS_AT_ONCE = 1 << 17
POINTS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 512


class Grammar:
    """Levels of a line of symbols; its first and last symbol must occur nowhere else.

    Nodes of all levels are numbered through, level 0 first, so a node of level 0 is a place
    in the line. ``parent`` is -1 at the top, ``first`` and ``last`` are the children at the
    ends, ``blocked`` says whether a node's parent is a block.
    """

    def __init__(self, line: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        level, low = np.unique(line, return_inverse=True)[1].reshape(-1), 0
        symbols, parents, firsts, lasts, blocked = [], [], [np.full(len(line), -1)], [np.full(len(line), -1)], []
        by_block = True
        while True:
            symbols.append(level)
            kinds = int(level.max()) + 1
            heads = None if kinds == len(level) else (
                self._blocks(level) if by_block else self._pairs(level, rng, kinds))
            if heads is None:
                parents.append(np.full(len(level), -1))
                blocked.append(np.zeros(len(level), dtype=bool))
                break
            starts = np.flatnonzero(heads)
            sizes = np.diff(np.append(starts, len(level)))
            if by_block:
                key = level[starts] * (int(sizes.max()) + 1) + sizes
            else:
                second = np.where(sizes > 1, level[np.minimum(starts + 1, len(level) - 1)] + 1, 0)
                key = level[starts] * (kinds + 1) + second
            high = low + len(level)
            parents.append(high + np.cumsum(heads) - 1)
            blocked.append(np.full(len(level), by_block))
            firsts.append(low + starts)
            lasts.append(low + starts + sizes - 1)
            level, low = np.unique(key, return_inverse=True)[1].reshape(-1), high
            by_block = not by_block
        self.symbol, self.parent, self.first, self.last, self.blocked = (
            np.concatenate(x) for x in (symbols, parents, firsts, lasts, blocked))
        self.size = len(line)

    @staticmethod
    def _blocks(level: np.ndarray) -> np.ndarray:
        """Where maximal blocks of one symbol begin."""
        return np.concatenate([[True], level[1:] != level[:-1]])

    @staticmethod
    def _pairs(level: np.ndarray, rng: np.random.Generator, kinds: int) -> np.ndarray:
        """Where the symbols begin once each left symbol takes the right symbol after it."""
        left = rng.integers(0, 2, kinds).astype(bool)[level]
        joined = left[:-1] & ~left[1:]
        other = ~left[:-1] & left[1:]
        if other.sum() > joined.sum():
            joined = other
        return np.concatenate([[True], ~joined])

    def extend(self, a: np.ndarray, b: np.ndarray, ahead: bool = True) -> np.ndarray:
        """How many symbols from places a < b on agree, going ahead (or back)."""
        edge, far, step = (self.first, self.last, 1) if ahead else (self.last, self.first, -1)
        x, y, out, which = a.copy(), b.copy(), np.empty(len(a), dtype=np.int64), np.arange(len(a))
        while len(which):
            px, py = self.parent[x], self.parent[y]
            up = (px >= 0) & (edge[px] == x) & (edge[py] == y) & (self.symbol[px] == self.symbol[py])
            same = self.symbol[x] == self.symbol[y]
            # Equal symbols inside two blocks are as many as the shorter rest has.
            rest = np.where(self.blocked[x], np.minimum((far[px] - x) * step, (far[py] - y) * step) + 1, 1)
            down = edge[x]
            end = ~up & ~same & (down < 0)
            new_x = np.where(up, px, np.where(same, x + rest * step, down))
            new_y = np.where(up, py, np.where(same, y + rest * step, edge[y]))
            if end.any():
                out[which[end]] = x[end]
                go = ~end
                which, new_x, new_y = which[go], new_x[go], new_y[go]
            x, y = new_x, new_y
        return np.abs(out - a)


def _grid(line: np.ndarray, period: int) -> np.ndarray:
    """Grid points of a period from which as many equal neighbours follow as any run covers."""
    equal = line[:len(line) - period:period] == line[period::period]
    need = max(MIN_EXPONENT - 1, (MIN_WORDS - period) // period)
    if len(equal) < need:
        return np.empty(0, dtype=np.int64)
    ok = equal[:len(equal) - need + 1].copy()
    for k in range(1, need):
        ok &= equal[k:len(equal) - need + 1 + k]
    return np.flatnonzero(ok) * period


def line_runs(line: np.ndarray, longest: int, seed: int = 0) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of a line whose separators occur once each."""
    found: dict[tuple[int, int], int] = {}
    known: list[tuple[int, int, int]] = []
    grammar = None

    def look(points: np.ndarray, periods: np.ndarray) -> None:
        nonlocal grammar
        if grammar is None:
            grammar = Grammar(line, seed)
        ahead = grammar.extend(points, points + periods)
        back = grammar.extend(points - 1, points + periods - 1, ahead=False)
        starts, ends = points - back, points + periods + ahead
        good = ends - starts >= np.maximum(MIN_WORDS, MIN_EXPONENT * periods)
        for s, e, p in zip(starts[good].tolist(), ends[good].tolist(), periods[good].tolist()):
            if found.get((s, e), p + 1) > p:
                found[s, e] = p
                known.append((s, e, p))

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    for period in range(1, longest // MIN_EXPONENT + 1):
        points = _grid(line, period)
        known = [r for r in known if r[1] - r[0] >= MIN_EXPONENT * period]
        if len(points) and known:
            points = _outside(points, period, known)
        while len(points) > POINTS_AT_ONCE:  # long runs first make most of the others needless
            look(points[:POINTS_AT_ONCE], np.full(POINTS_AT_ONCE, period))
            points = _outside(points[POINTS_AT_ONCE:], period, known)
        if len(points):
            waiting.append((points, np.full(len(points), period)))
            count += len(points)
        if count > POINTS_AT_ONCE:
            look(*map(np.concatenate, zip(*waiting)))
            waiting, count = [], 0
    if waiting:
        look(*map(np.concatenate, zip(*waiting)))
    return [(s, e, p) for (s, e), p in sorted(found.items())]


def _outside(points: np.ndarray, period: int, known: list[tuple[int, int, int]]) -> np.ndarray:
    """Points that lie in no known run whose period divides theirs."""
    keep = np.ones(len(points), dtype=bool)
    for s, e, q in known:
        if period % q == 0:
            keep[np.searchsorted(points, s):np.searchsorted(points, e - period)] = False
    return points[keep]


def text_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, given as words, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order, at = sorted(range(len(texts)), key=lambda k: len(texts[k])), 0
    while at < len(order):
        group, total = [], 0  # texts of like length together: the longest sets the periods tried
        while at < len(order) and (not group or total + len(texts[order[at]]) <= WORDS_AT_ONCE):
            group.append(order[at])
            total += len(texts[order[at]])
            at += 1
        group = [k for k in group if len(texts[k]) >= MIN_WORDS]
        if not group:
            continue
        sizes = np.array([len(texts[k]) for k in group])
        words = pa.array([w for k in group for w in texts[k]], pa.large_binary()).dictionary_encode().indices
        line = np.empty(int(sizes.sum()) + len(group) + 1, dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        inside = np.ones(len(line), dtype=bool)
        inside[bounds] = False
        line[inside] = words.to_numpy()
        line[bounds] = np.arange(len(bounds)) + int(sizes.sum())
        for s, e, p in line_runs(line, int(sizes[-1])):
            home = int(np.searchsorted(bounds, s, side="right")) - 1
            out[group[home]].append((s - int(bounds[home]) - 1, e - s, p))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left, joined by one space, when each run keeps its first period only."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) per row: all runs by start and period, the one of
    greatest length / period (ties: smallest start, then period; null without runs), and the text
    in which each run keeps its first period only."""
    rows = columns(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([id_field(rows, "doc_id"), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run_type)), T.StructField("best", run_type),
                           T.StructField("collapsed", T.StringType())])
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [t.split() for t in part.column(1).to_pylist()]  # bytes split at ASCII white space
                found = text_runs(texts)
                best = [max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None for runs in found]
                as_rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(as_rows, pa.list_(kind)),
                    pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], kind),
                    pa.array([collapse(t, runs).decode() for t, runs in zip(texts, found)], pa.string())],
                    names=schema.names)

    return rows.mapInArrow(run, schema)
