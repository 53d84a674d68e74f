"""Decontamination, license scans and quality rules against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trisk.llm import decontaminate as D
from trisk.llm import license_rules as L
from trisk.llm import quality_forest as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# ---------------------------------------------------------------- decontamination

def contamination(text, items, window=13):
    words, hit, ids = words_of(text), set(), set()
    for i, item in items:
        own = words_of(item)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at:at + size] == own[k:k + size]:
                    hit.update(range(at, at + size))
                    ids.add(i)
    listed = ",".join(sorted(str(i) for i in ids if i is not None))
    return (len(words), len(hit), len(ids - {None}), hashlib.sha256(listed.encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(words))


ITEMS = [(1, "Alpha beta gamma delta"), (2, "one TWO three"), (2, "one two three"), (3, None), (4, ""), (5, "..."),
         (6, " ".join(f"w{k}" for k in range(20))), (None, "no id here"), (7, "one two"), (8, "日本語 text")]


@pytest.mark.parametrize("block", [D.MAX_PATTERN_CHARS, 1])
def test_contamination_equals_plain_matching(spark, awkward, block):
    more = spark.createDataFrame([(20, "xx alpha, BETA gamma-delta yy " + " ".join(f"w{k}" for k in range(3, 18))),
                                  (21, "one two one two three"), (22, "日本語 TEXT"), (23, "done twofold")],
                                 "doc_id long, text string")
    docs = awkward.select("doc_id", "text").union(more)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find_contamination(docs, bench, max_pattern_chars=block)
    rows = found.select("doc_id", "text", "__n_words", D.n_hit().alias("hit"), "__items",
                        D.is_contaminated().alias("bad")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, hit, n_items, _, bad = contamination(r.text, ITEMS)
        assert (r["__n_words"], r.hit, len(r["__items"]), r.bad) == (n, hit, n_items, bad), r.doc_id


def test_long_items_are_spread_over_blocks(spark):
    item = " ".join(f"w{k}" for k in range(400))
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, item)], "item_id long, text string")
    blocks = list(D.pattern_blocks(bench, "item_id", "text", 13, 500))
    assert len(blocks) > 20 and max(sum(len(p) for p, _ in b) for b in blocks) < 600
    docs = spark.createDataFrame([(1, f"a {item} b"), (2, "w5 w6")], "doc_id long, text string")
    for chars in (500, D.MAX_PATTERN_CHARS):
        one, two = D.find_contamination(docs, bench, max_pattern_chars=chars).orderBy("doc_id").collect()
        assert (one["__n_words"], sorted(one["__items"]), [tuple(x) for x in one["__spans"]]) == (402, [1, 3], [(1, 401)])
        assert not two["__items"]


def test_contamination_report(spark, empty, nothing_but_nulls):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    report = D.contamination_report(docs, bench).collect()
    assert sum(r.contaminated for r in report) > 0
    for r in report:
        if r.n_hit or r.doc_id % 10 == 0:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == contamination(texts[r.doc_id], items)
        covered = [w for a, b in r.offsets for w in words_of(texts[r.doc_id][a:b])]
        assert len(covered) == r.n_hit
    assert D.contamination_report(empty, bench).collect() == []
    assert [tuple(r)[1:4] for r in D.contamination_report(nothing_but_nulls, bench).collect()] == [(0, 0, 0)] * 3
    none = bench.filter("item_id < 0")
    assert not any(r.contaminated for r in D.contamination_report(docs, none).collect())
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in report if not r.contaminated}


# ---------------------------------------------------------------- licenses

@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
    ("licensed under the GNU General Public License, version 3", ["gpl-3.0"]),
    ("Released under the MIT License. All rights reserved.", ["mit", "reserved"]),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0"]),
    ("see https://opensource.org/licenses/MIT", ["mit"]),
    ("mit der Apache in the city", []), ("", []), ("\x00", []),
])
def test_labels(text, labels):
    assert [r.label for _, _, r in L.detections(text)] == labels


WRAPPED = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-2.0", "under the terms of the GNU General Public License, version 2"),
    ("cc-by-sa", "Creative Commons Attribution ShareAlike 4.0"), ("reserved", "All rights reserved"),
    ("permission-notice", "Permission is hereby granted, free of charge"), ("no-warranty", "provided as is"),
    ("copyright", "Copyright (c) 2020"), ("mit", "released under the MIT License"),
]


@pytest.mark.parametrize("label, text", WRAPPED)
@pytest.mark.parametrize("gap", ["\n", "  ", "\r\n\t", "\n * ", "\n# ", "\n//", " */\n/* ", "\n *\n * ", "\u00a0"])
def test_wrapped_texts_match_like_plain_ones(label, text, gap):
    plain = L.detections(f"x {text} y")
    assert label in {r.label for _, _, r in plain}
    wrapped = f"İx\n\n{text.replace(' ', gap)} y"
    found = L.detections(wrapped)
    assert [r.order for _, _, r in found] == [r.order for _, _, r in plain]
    for (a, b, _), (x, y, _) in zip(found, plain):
        assert wrapped[a:b] == f"x {text} y"[x:y].replace(" ", gap)


@pytest.mark.parametrize("label, text", [("copyright", "©2020 by us"), ("copyright", "Copyright2021"), ("mit", "the “MIT License” —"),
                                         ("apache-2.0", "—Apache License 2.0—"), ("reserved", "©all rights reserved®")])
def test_glued_texts_pass_the_gate(label, text):
    assert label in {r.label for _, _, r in L.detections(text)}


def test_every_license_rule_matches_wrapped_and_glued_text():
    for label, tags, name, keyword, address in L.LICENSES:
        tag = tags.split("|")[0].replace("\\", "")
        tag = re.sub(r"\(.*?\)\??|\[(.).*?\]\??", r"\1", tag)
        for text in (f"SPDX-License-Identifier:\n{tag}", f"“SPDX-License-Identifier: {tag}”"):
            assert L.detections(text), (label, text)


def test_contained_detections_are_suppressed():
    text = "distributed under the terms of the GNU General Public License version 2 " * 50
    found = L.detections(text)
    assert [r.label for _, _, r in found] == ["gpl-2.0"] * 50
    for a, b, _ in found:
        assert not any((x, y) != (a, b) and x <= a and b <= y for x, y, _ in found)


def test_rules_are_gated_by_a_keyword_each_match_has():
    assert len(L.rules()) > 200
    for label, text in [("cc-by", "license: CC BY 4.0"), ("zlib", "under the zlib license"), ("agpl-3.0", "GNU Affero General Public License")]:
        assert label in {r.label for _, _, r in L.detections(text)}


def test_scan_rows(awkward, empty, spark):
    rows = L.scan(awkward).collect()
    assert len(rows) == awkward.count() and all(r.labels == "" and r.score == 0 for r in rows)
    assert L.scan(empty).collect() == []
    more = spark.createDataFrame([(1, "CC-BY cc by, General\npublic license x all RIGHTS reserved cc by"), (2, "mycc by")],
                                 "doc_id long, text string")
    one, two = sorted(L.scan(more).collect(), key=lambda r: r.doc_id)
    assert (one.n_words, one.n_base, one.first_word, one.last_word) == (13, 5, 0, 11)
    assert one.base_labels == "cc-by,gpl,reserved" and set(one.base_labels.split(",")) <= set(one.labels.split(","))
    assert 0 < one.score <= 1 and (two.n_base, two.first_word, two.base_labels) == (0, None, "")


PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def plain_detections(text):
    """Every rule over the whole text without a gate, each character's place kept; then the inside ones go."""
    low = "".join(c.lower()[0] if len(text.lower()) != len(text) else c.lower() for c in text)
    flat, place, at = [], [], 0
    while at < len(low):
        gap = L._GAP.match(low, at)
        flat.append(" " if gap else low[at])
        place.append(at)
        at = gap.end() if gap else at + 1
    flat = "".join(flat)
    found = sorted(((-r.priority, place[m.start()] - place[m.end() - 1] - 1, r.order, place[m.start()], r)
                    for r in L.rules() for m in r.pattern.finditer(flat)), key=lambda d: d[:4])
    kept = []
    for _, minus, _, a, r in found:
        if not any(x <= a and a - minus <= y for x, y, _ in kept):
            kept.append((a, a - minus, r))
    return kept


def plain_scan(text):
    """(n_words, n_base, first, last, base labels, labels, score, detections)."""
    words, places = words_of(text), []
    for phrase, label in PHRASES:
        own = phrase.split()
        places += [(k, label) for k in range(len(words) - len(own) + 1) if words[k:k + len(own)] == own]
    kept = plain_detections(text or "")
    at, base = [k for k, _ in places], {label for _, label in places}
    score = max([r.confidence for *_, r in kept] + [0.7] * bool(base), default=0.0)
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {r.label for *_, r in kept})), score, sorted((r.label, a, b) for a, b, r in kept))


def check_scan(frame):
    rows = L.scan(frame).join(frame.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == frame.count()
    for r in rows:
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
               sorted((d.label, d.start, d.end) for d in r.detections))
        assert got == plain_scan(r.text), r.doc_id
    return rows


def test_scan_equals_ungated_rules_on_the_table(spark):
    rows = check_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert any(r.n_base for r in rows) and any(r.labels for r in rows)


def test_scan_equals_ungated_rules_on_license_texts(spark):
    """Random strings of license names, grants, tags, comment signs and line breaks."""
    rng = np.random.default_rng(5)
    parts = ["licensed under the", "released under the terms of", "license:", "SPDX-License-Identifier:", "GPL-2.0-or-later",
             "MIT", "License", "Apache License, Version 2.0", "GNU General Public License", "version 3", "cc by", "CC-BY-SA 4.0",
             "\n * ", "\n# ", "  ", "all rights reserved", "All\nRights Reserved", "©2020", "Copyright (c) 2021", "İ", "as is",
             "https://www.gnu.org/licenses/gpl-3", "creativecommons.org/licenses/by-nc", "Mozilla Public License 2.0", "zlib",
             "permission is hereby granted, free of\n// charge", "in the public domain", "eclipse public license", ".", "日本"]
    texts = ["".join(parts[k] + str(rng.choice([" ", " ", "\n", ", ", ""])) for k in rng.integers(0, len(parts), 25))
             for _ in range(300)]
    texts += [None, "", " ".join(parts) * 40]
    rows = check_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len({label for r in rows for label in r.labels.split(",")}) > 10


# ---------------------------------------------------------------- quality

def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    spans = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if spans[tuple(words[k:k + 8])] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n#$"), max_size=80) | st.text(max_size=30))
def test_rule_counts_equal_plain_ones(text):
    text = text.encode("utf-8", "replace").decode()
    assert Q.rule_counts(text)[0] == counts(text)


def test_judge_rows(awkward, empty, nothing_but_nulls, spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 0), (6, None), (99, 0)], "doc_id long, quality int")
    for frame in (awkward, nothing_but_nulls):
        forest = Q.fit(frame, labels)
        rows = Q.judge(frame, forest).collect()
        assert sorted((r.doc_id or 0, *[r[c] for c in Q.COUNTS]) for r in rows) == sorted(
            (r.doc_id or 0, *counts(r.text)) for r in frame.collect())
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.kept and r.base_failed)
        kept = Q.keep_good(frame, forest)
        assert kept.columns == frame.columns and kept.count() == sum(r.kept for r in rows)
    forest = Q.fit(empty, labels)
    assert forest.threshold == np.inf and Q.judge(empty, forest).collect() == []


def test_held_out_verdicts(spark):
    """Fitted on labelled rows of one table, the forest finds bad documents of another and keeps good ones."""
    forest = Q.fit(*[spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")])
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.judge(docs, forest).join(labels, "doc_id").filter("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_path_lengths_find_the_odd_row():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 10)), [[8.0] * 10]])
    forest = Q.fit_forest(x, np.array([False] * 500 + [True]))
    scores = forest.scores(x)
    assert scores[-1] == scores.max() and scores[-1] > forest.threshold
    assert (scores[:500] > forest.threshold).mean() <= Q.MAX_FALSE + 0.002
