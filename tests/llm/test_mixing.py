"""The mix: targets, slots and takes; its SQL is compared in tests/test_oracle.py."""

from collections import Counter

import pytest

from trisk.llm import mixing as M


def level_by_hand(sizes, weights, cap=3):
    """Targets by resharing the excess until no source is above its cap."""
    target, full = {}, set()
    total = sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        target = {s: cap * sizes[s] for s in full} | {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        full |= set(over)


def corpus(spark, sizes, per_doc=50):
    rows, k = [], 0
    for source, size in sizes.items():
        while size > 0:
            n = min(per_doc + k % 7, size)
            rows.append((k, " ".join(["w"] * n) + " ", source))
            size, k = size - n, k + 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("sizes", [{"a": 9000, "b": 200, "c": 3000, "d": 50, None: 700}, {"a": 10}, {"z": 5000, "é": 5000}])
def test_targets_and_takes(spark, sizes):
    docs = corpus(spark, sizes)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    want = level_by_hand(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    rows = M.taken_words(*M.mix(docs)).collect()
    assert len(rows) == docs.count()
    by_source = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        by_source[r.source] += r.taken
    for s in sizes:
        assert abs(by_source[s] - want[s]) <= 0.5 + 1e-6
    again = M.taken_words(*M.mix(docs.repartition(5))).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)


def test_slots_take_equal_blocks_and_spread_sources(spark):
    _, pieces = M.mix(corpus(spark, {"a": 40_000, "b": 20_000, "c": 30_000}), block_words=300)
    blocks, slots = Counter(), {}
    for r in pieces.collect():
        blocks[r.skey, r.block] += r.to_word - r.from_word
        assert slots.setdefault((r.skey, r.block), r.slot) == r.slot
    last = {s: max(b for t, b in blocks if t == s) for s, _ in blocks}
    assert all(n == 300 or (n < 300 and b == last[s]) for (s, b), n in blocks.items())
    assert sum(blocks.values()) == 90_000 and set(slots.values()) <= set(range(300))
    share = Counter(s for s, _ in blocks)
    for at in range(0, 300, 30):  # each stretch of the schedule is close to the shares
        part = Counter(s for (s, _), slot in slots.items() if at <= slot < at + 30)
        assert all(abs(part[s] - share[s] / 10) <= 2 for s in share)


def test_small_sources_reach_their_targets_beside_large_ones(spark):
    sizes = {"big0": 60_000, "big1": 40_000} | {f"s{k:03}": 40 for k in range(400)}
    docs = corpus(spark, sizes)
    for block_words in (M.BLOCK_WORDS, 64):
        documents, pieces = M.mix(docs, block_words=block_words)
        rows = M.taken_words(documents, pieces).collect()
        taken, target = Counter(), {}
        for r in rows:
            taken[r.source] += r.taken
            target[r.source] = r.target
        assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)
        assert all(taken[s] == 120 for s in sizes if s.startswith("s"))
        # The blocks of the small sources are spread over the schedule, not left to its end.
        at = sorted({(r.skey, r.slot) for r in pieces.filter("skey LIKE 'ss%'").collect()}, key=lambda x: x[1])
        end = pieces.agg({"slot": "max"}).first()[0] + 1
        quarters = Counter(4 * slot // end for _, slot in at)
        assert len(at) >= 400 and min(quarters[k] for k in range(4)) >= 0.15 * len(at)


def test_every_block_is_scheduled_once(spark):
    sizes = {f"x{k}": 37 * (k + 1) for k in range(60)} | {"hot": 50_000}
    documents, pieces = M.mix(corpus(spark, sizes), block_words=100)
    seen = Counter()
    for r in pieces.collect():
        seen[r.skey, r.copy, r.start, r.from_word] += 1
    assert max(seen.values()) == 1
    upto = {r.skey: r.upto for r in documents.collect()}
    assert {(r.skey, r.block) for r in pieces.collect()} == {(s, b) for s, n in upto.items() for b in range(-(-n // 100))}


def test_one_id_on_many_rows_is_spread_and_reruns_agree(spark):
    rows = [(None if k % 3 else k, f"text {k} " + "w " * (k % 9), "s") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed = M.place_documents(docs, "doc_id", "source", "text", "mix").filter("doc_id IS NULL")
    assert placed.select("order_hash").distinct().count() == 2000
    first = Counter(map(tuple, M.mixed_documents(docs, share=0.6).collect()))
    again = Counter(map(tuple, M.mixed_documents(docs.repartition(7), share=0.6).collect()))
    assert first == again and sum(len(r[1].split()) * n for r, n in first.items()) == round(
        0.6 * sum(len(r[1].split()) for r in rows))


def test_mixed_documents_take_effect(spark):
    docs = corpus(spark, {"a": 3000, "b": 300, "c": 2000}).selectExpr("*", "1 AS size", "'x' AS skey")
    taken = {r.doc_id: (r["size"], r.taken) for r in M.taken_words(*M.mix(docs)).collect()}
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
    assert got == Counter({i: t for i, (_, t) in taken.items() if t})


def test_awkward_tables(awkward, empty, nothing_but_nulls):
    rows = M.taken_words(*M.mix(awkward)).collect()
    assert len(rows) == awkward.count() and sum(r.taken for r in rows) > 0
    assert M.mixed_documents(awkward).columns == awkward.columns and M.mixed_documents(awkward).count() > 0
    assert M.taken_words(*M.mix(empty)).collect() == [] and M.mixed_documents(empty).collect() == []
    rows = M.taken_words(*M.mix(nothing_but_nulls)).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 3
    assert M.mixed_documents(nothing_but_nulls).collect() == []
