"""The corpus pipeline: each stage's decisions, whole results and awkward tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_dedup import classes, plain_fingerprint
from test_filters import counts, words_of
from test_mixing import level_by_hand
from test_tokens import ids_of

import corpus_pipeline as P
from trisk.llm import decontaminate, quality_forest, simhash
from trisk.llm.store import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    """Every stage's result over the small tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "test-stage"))
    return out


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def test_filter_stages_only_drop_rows(staged):
    for before, after in zip(staged[:3], staged[1:4]):
        assert after.columns == before.columns
        assert not rows(after) - rows(before)
        assert 0 < after.count() <= before.count()


def test_stage_decisions_are_those_of_the_operators(spark, staged):
    docs, good, unique, clean, mix, tokens = staged
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = quality_forest.judge(docs, quality_forest.fit(docs, labels)).filter("kept")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in kept.collect()}
    groups = simhash.near_duplicates(good).collect()
    assert sorted(r.doc_id for r in unique.collect()) == sorted({r.component_id for r in groups})
    report = decontaminate.contamination_report(unique, bench).collect()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in report if not r.contaminated}
    assert len(report) > clean.count()
    words = Counter()
    for r in mix.collect():
        words[r.source] += len(r.text.split())
    whole = sum(len(r.text.split()) for r in clean.collect())
    assert abs(sum(words.values()) - whole) <= 0.001 * whole + 30
    assert mix.columns == clean.columns
    assert tokens.count() == mix.count()
    assert {r.doc_id for r in tokens.collect()} == {r.doc_id for r in mix.collect()}


def test_run_equals_the_stages(spark, staged):
    assert rows(P.run(spark, SF)) == rows(staged[-1])


def plain_quality(docs, forest):
    """Documents that pass the base rules and whose mean path down the trees is long enough."""
    kept = []
    for doc_id, text, source in docs:
        n_words, *_, n_repeat = counts(text)
        row, paths = quality_forest.rule_counts(text or "")[1], []
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] + (row[forest.feature[node]] >= forest.value[node])
            paths.append(forest.length[node])
        odd = 2.0 ** (-np.mean(paths) / forest.norm) if paths else 0.0
        if n_words >= 20 and 100 * n_repeat <= 30 * n_words and odd <= forest.threshold:
            kept.append((doc_id, text, source))
    return kept


def plain_near_duplicates(docs, max_bits=3):
    """The document of the smallest id of each class of all pairs' links."""
    docs = sorted(docs)
    codes = [plain_fingerprint(text) for _, text, _ in docs]
    pairs = [(a, b) for b in range(len(codes)) for a in range(b) if (codes[a] ^ codes[b]).bit_count() <= max_bits]
    return [docs[k] for k, low in enumerate(classes(len(docs), pairs)) if k == low]


def plain_decontaminate(docs, items, window=13):
    """Documents of which less than a twentieth of the words lies in a window of an item."""
    windows = {}
    for item in items:
        own = words_of(item)
        size = min(window, len(own))
        windows.setdefault(size, set()).update(tuple(own[k:k + size]) for k in range(len(own) - size + 1 if own else 0))
    kept = []
    for doc_id, text, source in docs:
        words, hit = words_of(text), set()
        for size, known in windows.items():
            for at in range(len(words) - size + 1 if size else 0):
                if tuple(words[at:at + size]) in known:
                    hit.update(range(at, at + size))
        if not hit or 20 * len(hit) < len(words):
            kept.append((doc_id, text, source))
    return kept


def plain_mix(docs):
    """Every source's shuffled documents, round after round, until its target's last word."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs}
    sizes = Counter()
    for d in docs:
        sizes[d[2]] += size[d]
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    targets = level_by_hand(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    out = []
    for source in order:
        def place(d):
            text = hashlib.md5(d[1].encode()).hexdigest() if d[1] is not None else ""
            return hashlib.md5(f"mix:{d[0]}:{text}".encode()).hexdigest()
        line, left = sorted((d for d in docs if d[2] == source and size[d]), key=place), int(targets[source] + 0.5)
        while left > 0:
            for d in line:
                if size[d] <= left:
                    out.append((d[0], d[1]))
                elif left > 0:
                    out.append((d[0], "".join(re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", d[1])[:left]).rstrip(" ")))
                left = max(left - size[d], 0)
    return out


def test_run_equals_a_plain_pipeline(spark):
    """Lists, all pairs, nested loops and the tokenizers library against run(), document by document."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = [(r.doc_id, r.text, r.source) for r in frame.collect()]
    good = plain_quality(docs, quality_forest.fit(frame, labels))
    unique = plain_near_duplicates(good)
    clean = plain_decontaminate(unique, [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert len(docs) > len(good) > len(unique) > len(clean) > 0
    want = Counter()
    for doc_id, text in plain_mix(clean):
        ids = [*ids_of(text), 0]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = sorted(P.run(spark, SF).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()


def test_awkward_and_empty_tables_pass_every_stage(spark, awkward, empty, nothing_but_nulls):
    for frame in (awkward, empty, nothing_but_nulls):
        docs = frame
        for name, stage in P.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF), "test-stage")
            assert docs.columns == frame.columns
            if frame is awkward and name == "simhash near-dedup":
                ids = [r.doc_id for r in docs.collect()]
                assert len(ids) == len(set(ids))
        P.STAGES[-1][1](spark, docs, SF).collect()
    # Stages on what an earlier one would have dropped.
    for name, stage in P.STAGES:
        assert stage(spark, awkward, SF).count() >= 0
