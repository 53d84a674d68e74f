"""Periodic runs, Merkle manifest and class language model against plain versions."""

import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from trisk.llm import class_lm, merkle, periodic_runs, queries

LOWER = bytes(range(256)).lower()


# ---------------------------------------------------------------- periodic runs

def plain_runs(w):
    n, out = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            if w[i] == w[i + p]:
                s = i
                while i < n - p and w[i] == w[i + p]:
                    i += 1
                if i + p - s >= max(24, 3 * p):
                    out.setdefault((s, i + p), p)
            else:
                i += 1
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


@st.composite
def texts_with_periods(draw):
    texts = []
    for _ in range(draw(st.integers(1, 4))):
        w = [b"%d" % k for k in draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 40]))), max_size=160))]
        for start, p, size in draw(st.lists(st.tuples(st.integers(0, 120), st.integers(1, 20), st.integers(24, 90)), max_size=3)):
            for i in range(start + p, min(len(w), start + size)):
                w[i] = w[i - p]
        texts.append(w)
    return texts


@settings(max_examples=150, deadline=None)
@given(texts_with_periods())
def test_runs_equal_plain(texts):
    assert periodic_runs.text_runs(texts) == [plain_runs(w) for w in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=80), st.integers(0, 5))
def test_grammar_extensions_equal_plain(symbols, seed):
    line = np.array([90, *symbols, 91])
    g = periodic_runs.Grammar(line, seed)
    a, b = map(np.array, zip(*[(i, j) for i in range(1, len(symbols)) for j in range(i + 1, len(symbols) + 1)]))

    def plain(i, j, step):
        k = 0
        while line[i + k * step] == line[j + k * step]:
            k += 1
        return k

    assert g.extend(a, b).tolist() == [plain(i, j, 1) for i, j in zip(a.tolist(), b.tolist())]
    assert g.extend(a, b, ahead=False).tolist() == [plain(i, j, -1) for i, j in zip(a.tolist(), b.tolist())]


def test_small_chunks_give_the_same_runs(monkeypatch):
    words = [b"a"] * 300 + [b"%d" % (k % 7) for k in range(400)] + [b"b", b"a"] * 60
    monkeypatch.setattr(periodic_runs, "POINTS_AT_ONCE", 16)
    assert periodic_runs.text_runs([words]) == [plain_runs(words)]


def plain_op11(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    gone = {i for s, n_, p in runs for i in range(s + p, s + n_)}
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_op11_query_equals_plain(spark):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF["0.001"]).collect()}
    assert got == {d.doc_id: plain_op11(d.doc_id, d.text) for d in docs}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_runs_of_awkward_rows(awkward, empty, nothing_but_nulls):
    rows = periodic_runs.find_runs(awkward).collect()
    assert len(rows) == awkward.count()
    long = next(r for r in rows if r.n_words == 20_000)
    assert [(r.start, r.length, r.period) for r in long.runs] == [(0, 20_000, 977)]
    assert len(long.collapsed.split()) == 977
    assert periodic_runs.find_runs(empty).collect() == []
    assert [(r.n_words, r.runs, r.best, r.collapsed) for r in periodic_runs.find_runs(nothing_but_nulls).collect()] == \
        [(0, [], None, "")] * 3


# ---------------------------------------------------------------- Merkle manifest

def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_tree(leaves):
    """(top, siblings' text and fold function per leaf)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])

    def walk(at, digest):
        proof = ""
        for level in levels[:-1]:
            run = level[at // 8 * 8:at // 8 * 8 + 8]
            proof += "".join(run[:at % 8] + run[at % 8 + 1:])
            digest = sha("".join(run[:at % 8] + [digest] + run[at % 8 + 1:]))
            at //= 8
        return proof, digest

    return levels[-1][0], walk


def plain_manifest(docs, changed):
    def leaf(d, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                           for v in (d.doc_id, d.source, d.lang, d.n_chars, text)))

    groups = {}
    for d in docs:
        groups.setdefault(d.lang, []).append((d.doc_id, leaf(d, d.text), leaf(d, changed(d))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: plain_tree([r[1] for r in groups[g]]) for g in order}
    root, over = plain_tree([trees[g][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for k, (i, own, other) in enumerate(groups[g]):
            proof, folded = trees[g][1](k, other)
            rest, folded = over(at, folded)
            out.append((i, own, trees[g][0], root, sha(proof + rest), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_equals_plain(spark, depth):
    sizes = {"a": 700, "b": 65, "c": 8, "d": 1, None: 9, "": 64, "é": 2, **{f"x{k}": 1 for k in range(12)}}
    rows = [(1000 * g + k, None if k % 5 == 0 else f"Text {k} é", lang, None if k % 7 == 0 else "s", k if k % 3 else None)
            for g, (lang, n) in enumerate(sizes.items()) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lowered = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = sorted(map(tuple, merkle.manifest(docs, lowered, depth=depth).collect()), key=repr)
    assert got == plain_manifest(docs.collect(), lambda d: d.text and (d.text.lower() if d.doc_id % 3 == 0 else d.text))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_parent_folds_from_the_kept_state():
    children = [sha(str(k)).encode() for k in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        assert parent.fold(slot, children[slot]) == parent.digest
        other = [*children[:slot], b"0" * 64, *children[slot + 1:]]
        assert parent.fold(slot, b"0" * 64) == hashlib.sha256(b"".join(other)).hexdigest().encode()


def test_manifest_of_awkward_rows(awkward, empty, nothing_but_nulls):
    rows = merkle.manifest(awkward).collect()
    assert sorted(map(tuple, rows), key=repr) == plain_manifest(awkward.collect(), lambda d: d.text)
    assert all(r.verified for r in rows)
    assert merkle.manifest(empty).collect() == []
    rows = merkle.manifest(nothing_but_nulls).collect()
    assert len(rows) == 3 and len({r.root for r in rows}) == 1 and rows[0].leaf == sha("-----")


# ---------------------------------------------------------------- class language model

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200), st.lists(st.integers(0, 3), min_size=10, max_size=10))
def test_gains_equal_the_change_of_likelihood(walk, classes):
    pairs = np.zeros((10, 10), dtype=np.int64)
    np.add.at(pairs, (walk, np.roll(walk, -1)), 1)
    cls = np.array(classes)

    def matrix(c):
        member = np.eye(4, dtype=np.int64)[c]
        return member.T @ pairs @ member

    other = pairs - np.diag(np.diag(pairs))
    member = np.eye(4, dtype=np.int64)[cls]
    gain = class_lm.gains(matrix(cls), cls, other.T @ member, other @ member, np.diag(pairs).copy())
    now = class_lm.likelihood(matrix(cls))
    for w in range(10):
        for b in range(4):
            moved = cls.copy()
            moved[w] = b
            assert math.isclose(class_lm.likelihood(matrix(moved)) - now, gain[w, b] - gain[w, cls[w]], abs_tol=1e-6)


def plain_tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), b"\n"]


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    encoded = class_lm.materialize(class_lm.encode(docs, block_bytes=100_000), "lm-test")
    model = class_lm.fit(encoded, classes=12, rounds=3, share=500)
    sequences = class_lm.materialize(class_lm.class_sequences(encoded, model), "lm-test-sequences")
    bigrams = class_lm.class_bigrams(sequences, 12)
    return docs.collect(), model, bigrams, sequences


def test_counts_and_classes_cover_the_training_texts(trained):
    docs, model, bigrams, _ = trained
    train = [plain_tokens(d.text) for d in docs if zlib.crc32(str(d.doc_id).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    vocab = {r.word.encode(): r for r in model.vocab.collect()}
    assert {w: r.n for w, r in vocab.items()} == counts
    expected = np.zeros((12, 12), dtype=np.int64)
    for t in train:
        c = [vocab[w].cls for w in t]
        np.add.at(expected, ([c[-1], *c[:-1]], c), 1)
    assert (bigrams == expected).all() and (model.totals == expected.sum(0)).all()


def test_probabilities_sum_to_one(trained):
    _, model, bigrams, _ = trained
    step = model.transitions(bigrams)
    emitted = np.zeros(13)
    for r in model.vocab.collect():
        emitted[r.cls] += r.n / model.totals[r.cls]
    emitted[12] = 1
    reached = [k for k in range(12) if model.totals[k]] + [12]
    assert np.allclose(step[reached] @ emitted, 1)


def test_scores_equal_plain(trained):
    docs, model, bigrams, sequences = trained
    step = model.transitions(bigrams)
    vocab = {r.word.encode(): r for r in model.vocab.collect()}
    got = {r.doc_id: r for r in class_lm.score_sequences(sequences, model, step).collect()}
    n, v = model.tokens, model.words
    for d in docs:
        tokens = plain_tokens(d.text)
        cls = [vocab[w].cls if w in vocab else 12 for w in tokens]
        score = sum(math.log10(step[a, b] * (vocab[w].n / model.totals[b] if b < 12 else 1))
                    for a, b, w in zip([cls[-1], *cls[:-1]], cls, tokens))
        base = sum(math.log10(((vocab[w].n if w in vocab else 0) + 1) / (n + v + 1)) for w in tokens)
        r = got[d.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c < 12 for c in cls), n)
        assert math.isclose(r.score, score, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 7 == 2)


def test_exchange_raises_the_likelihood(spark):
    # Words of two kinds that take turns: 1, 3, 5 .. and 2, 4, 6 ..; starting classes by rank mix them.
    walk = [2 * (k * 7 % 5) + k % 2 + 1 for k in range(400)]
    counts = Counter(zip(walk, [*walk[1:], walk[0]]))
    pairs = spark.createDataFrame([(a, b, n) for (a, b), n in counts.items()], "v long, w long, n long")
    of, matrix = class_lm.cluster_frequent(pairs, 10, 3, 8)
    start = class_lm.cluster_frequent(pairs, 10, 3, 0)[1]
    assert class_lm.likelihood(matrix) > class_lm.likelihood(start)
    assert matrix.sum() == 400 and set(of[1:]) <= {0, 1, 2} and of[0] == 3


def test_held_out_texts_score_above_the_base(spark):
    rows = queries.op13_class_lm(spark, SF["0.01"]).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_scores_of_awkward_rows(awkward, empty, nothing_but_nulls):
    rows = class_lm.score(awkward, classes=4, rounds=1).collect()
    assert len(rows) == awkward.count() and all(math.isfinite(r.score) for r in rows)
    assert class_lm.score(empty, classes=4, rounds=1).collect() == []
    rows = class_lm.score(nothing_but_nulls, classes=4, rounds=1).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in rows] == [(1, 1, 3, False)] * 3
    rows = class_lm.score(awkward, held=F.lit(True), classes=4, rounds=1).collect()
    assert all((r.n_known, r.train_tokens, r.score, r.base_score) == (0, 0, 0.0, 0.0) for r in rows)
