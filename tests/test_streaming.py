"""The stream programs: split, replayed and out-of-order batches, restarts, empty streams."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trisk.operators import batches as B
from trisk.operators import sketch as S
from trisk.session import work_dir
from trisk.sources.feed import replay_feed
from trisk.sources.items import batched_events
from trisk.streaming import runner as ST

SCHEMA = "batch_id bigint, item bigint"


def batched(spark):
    return batched_events(spark.read.parquet(f"{SF['0.01']}/events.parquet"))


def staged(spark, df, files):
    """``df`` as ``files`` files in a folder, opened as a stream with one file per micro-batch."""
    path = work_dir(spark, "t-input")
    df.repartition(files).write.parquet(path)
    return ST.table_stream(spark, path, df.schema, 1)


def one_batch(spark, batch, n):
    return spark.createDataFrame([(batch, k) for k in range(n)], SCHEMA)


def kept_items(spark, out, threshold):
    return {r.batch_id: r.n for r in B.prefix_cutoff(ST.read_lengths(spark, out), threshold).collect()}


def test_the_tables_own_files_are_the_stream(spark):
    events = spark.read.parquet(f"{SF['0.01']}/events.parquet")
    stream = batched_events(ST.table_stream(spark, f"{SF['0.01']}/events.parquet", events.schema))
    out = work_dir(spark, "t-own")
    ST.stream_partials(stream, out)
    got = B.merge_partials(ST.read_histogram_partials(spark, out))
    assert sorted(got.collect()) == sorted(S.histogram(batched(spark)).collect())


def test_stream_histogram_and_replay(spark):
    bt, out = batched(spark), work_dir(spark, "t-hist")
    sink = ST.stream_partials(staged(spark, bt, 4), out, 10, 100)
    want = sorted(S.histogram(bt.where("item BETWEEN 10 AND 100")).collect())
    merged = lambda: sorted(B.merge_partials(ST.read_histogram_partials(spark, out)).collect())
    assert merged() == want
    # epoch 1 comes again with the same rows: its partial is replaced
    rows = ST._read(spark, f"{out}/partials/epoch=1", ST.PARTIALS.rpartition(",")[0])
    again = rows.where("kind = 'hist'").select("batch_id", "item", F.explode(F.sequence(F.lit(1), "a")))
    sink(again.select("batch_id", "item"), 1)
    assert merged() == want


def test_stream_sketch_equals_batch_sketch(spark):
    bt = batched(spark)
    got = ST.stream_sketch_cells(staged(spark, bt, 4), work_dir(spark, "t-cells"), 5, 1000, 10, 100)
    want = S.sketch_cells(S.histogram(bt.where("item BETWEEN 10 AND 100")), 5, 1000)
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_distinct_and_report(spark):
    bt = batched(spark)
    got = ST.stream_distinct(staged(spark, bt, 4), work_dir(spark, "t-distinct"))
    assert sorted(r.item for r in got.collect()) == list(range(150))
    for threshold in (2500, 10**9):
        report = ST.stream_distinct_report(staged(spark, bt, 4), work_dir(spark, "t-report"), threshold, 1250).first()
        rows = bt.where(f"batch_id < {2 if threshold == 2500 else 8}")
        want = rows.agg(F.count(F.lit(1)), F.countDistinct("item"), F.max("item")).first()
        assert tuple(report) == tuple(want)


def test_crossing_batch_split_over_files_is_kept_whole(spark):
    out = work_dir(spark, "t-split")
    sink = ST.PartialWriter(out, None, None, threshold=100, batch_rows=150)
    sink(one_batch(spark, 0, 120), 0)
    assert not sink.done.is_set()   # 120 of 150 rows: crossing, but not whole
    sink(one_batch(spark, 0, 30), 1)
    assert sink.done.is_set()
    assert kept_items(spark, out, 100) == {0: 150}


def test_replay_ahead_of_the_frontier_counts_once(spark):
    out = work_dir(spark, "t-replay")
    sink = ST.PartialWriter(out, None, None, threshold=100, batch_rows=60)
    for epoch, batch in ((0, 1), (0, 1), (1, 0)):   # batch 1 twice, ahead of batch 0
        sink(one_batch(spark, batch, 60), epoch)
        assert sink.done.is_set() == (batch == 0)   # 60 + 60 crosses 100 only with batch 0
    assert kept_items(spark, out, 100) == {0: 60, 1: 60}
    late = work_dir(spark, "t-replay")
    sink = ST.PartialWriter(late, None, None, threshold=150, batch_rows=60)
    for epoch, batch in ((0, 1), (0, 1), (1, 0)):
        sink(one_batch(spark, batch, 60), epoch)
    assert not sink.done.is_set()


def test_restart_stops_at_the_threshold(spark):
    out = work_dir(spark, "t-restart")
    first = ST.PartialWriter(out, None, None, threshold=100, batch_rows=40)
    for k in (0, 1):
        first(one_batch(spark, k, 40), k)
    second = ST.PartialWriter(out, None, None, threshold=100, batch_rows=40)   # a new process
    second(one_batch(spark, 1, 40), 1)   # the last epoch is delivered again
    assert not second.done.is_set()
    second(one_batch(spark, 2, 40), 2)
    assert second.done.is_set()
    second(one_batch(spark, 3, 40), 3)
    assert kept_items(spark, out, 100) == {0: 40, 1: 40, 2: 40}


@pytest.mark.parametrize("seed", range(3))
def test_any_order_and_splitting_gives_the_tables_cut(spark, seed):
    rng = random.Random(seed)
    rows = [(b, rng.randrange(9)) for b in range(6) for _ in range(20)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA)
    want = {r.batch_id: r.n for r in B.prefix_cutoff(B.batch_lengths(table, 0, 9), 50).collect()}
    out = work_dir(spark, "t-any")
    sink = ST.PartialWriter(out, None, None, threshold=50, batch_rows=20)
    for epoch in range(4):
        part = spark.createDataFrame(rows[30 * epoch:30 * epoch + 30], SCHEMA)
        sink(part, epoch)
        if rng.random() < 0.4:
            sink(part, epoch)
    assert kept_items(spark, out, 50) == want == {0: 20, 1: 20, 2: 20}


def test_bare_text_items_have_the_micro_batch_as_batch(spark):
    path, out = work_dir(spark, "t-text"), work_dir(spark, "t-bare")
    for k in range(4):
        spark.createDataFrame([(f" {x}",) for x in range(30)], "value string").coalesce(1).write.mode("append").text(path)
    stream = ST.text_items(spark.readStream.option("maxFilesPerTrigger", 1).text(path))
    sink = ST.stream_partials(stream, out, threshold=50, trigger={"processingTime": "100 milliseconds"})
    assert sink.done.is_set()
    assert kept_items(spark, out, 50) == {0: 30, 1: 30}
    got = B.merge_partials(ST.read_histogram_partials(spark, out),
                           B.prefix_cutoff(ST.read_lengths(spark, out), 50)).collect()
    assert {(r.item, r.freq) for r in got} == {(x, 2) for x in range(30)}


def test_empty_streams(spark):
    none = spark.createDataFrame([], SCHEMA)
    out = work_dir(spark, "t-empty")
    ST.stream_partials(staged(spark, none, 1), out, 10, 100, threshold=5, batch_rows=10)
    sink = ST.PartialWriter(out, 10, 100, threshold=5, batch_rows=10)
    sink(none, 7)
    assert ST.read_lengths(spark, out).collect() == [] and not sink.done.is_set()
    report = ST.stream_distinct_report(staged(spark, none, 1), work_dir(spark, "t-empty"), 5, 10).first()
    assert tuple(report) == (0, 0, None)
    assert ST.stream_distinct(staged(spark, none, 1), work_dir(spark, "t-empty")).collect() == []
    assert ST.stream_sketch_cells(staged(spark, none, 1), work_dir(spark, "t-empty"), 2, 4).collect() == []


def test_feed_is_cut_into_micro_batches_by_id(spark):
    feed = replay_feed(batched(spark), "batch_id", 8, files_per_batch=2)
    out = work_dir(spark, "t-feed")
    ST.stream_partials(feed, out)
    committed = ST.Epochs(spark, out).committed()
    assert sorted(committed) == list(range(len(committed))) and len(committed) >= 4
    assert sorted(B.merge_partials(ST.read_histogram_partials(spark, out)).collect()) == sorted(
        S.histogram(batched(spark)).collect())
    big = batched_events(spark.read.parquet(f"{SF['0.1']}/events.parquet"))
    out = work_dir(spark, "t-feed")
    ST.stream_partials(replay_feed(big, "batch_id", 8, files_per_batch=2), out)
    assert len(ST.Epochs(spark, out).committed()) == 8
    assert ST.read_lengths(spark, out).agg(F.sum("n")).first()[0] == big.count()


def test_state_lives_across_micro_batches(spark):
    bt, out = batched(spark), work_dir(spark, "t-across")
    sink = ST.PartialWriter(out, None, None, threshold=6250, batch_rows=1250)
    for epoch, ids in enumerate([(1, 3), (5, 7), (0,), (2, 6), (4,)]):   # out of order, one batch at a time ahead
        sink(bt.where(F.col("batch_id").isin(*ids)), epoch)
        assert sink.done.is_set() == (epoch == 4)
    assert kept_items(spark, out, 6250) == {k: 1250 for k in range(5)}


@pytest.mark.parametrize("seed", range(4))
def test_whole_prefix_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    first = rng.randrange(20)
    ids = [k for k in range(60) if rng.random() < (0.98 if k < 45 else 0.5)]
    lengths = {k: rng.randrange(1, 9) for k in ids}
    end = first
    while end in lengths:
        end += 1
    got = ST.whole_prefix(spark.createDataFrame(list(lengths.items()), SCHEMA.replace("item", "n")), first, block=4)
    assert got == (end, sum(lengths[k] for k in range(first, end)))


def test_a_failed_attempt_leaves_the_last_whole_one(spark, monkeypatch):
    out = work_dir(spark, "t-failed")
    sink = ST.PartialWriter(out, None, None, threshold=1000, batch_rows=50)
    sink(one_batch(spark, 0, 50), 0)
    sink(one_batch(spark, 1, 30), 1)
    before = sorted(map(tuple, ST.read_lengths(spark, out).collect()))

    def breaks(*_):
        raise OSError("lost")

    for part in (ST.Cut, "advance"), (ST.Epochs, "commit"):   # after the partials, and after the state
        with monkeypatch.context() as m:
            m.setattr(*part, breaks)
            with pytest.raises(OSError):
                ST.PartialWriter(out, None, None, threshold=1000, batch_rows=50)(one_batch(spark, 1, 50), 1)
        assert sorted(map(tuple, ST.read_lengths(spark, out).collect())) == before
    held = ST.read_lengths(spark, out)
    again = ST.PartialWriter(out, None, None, threshold=1000, batch_rows=50)
    again(one_batch(spark, 1, 50), 1)   # the replay
    assert {r.batch_id: r.n for r in ST.read_lengths(spark, out).collect()} == {0: 50, 1: 50}
    assert sorted(map(tuple, held.collect())) == before   # a reader keeps the epochs it opened
    state = ST.Epochs(spark, out).read("state", ST.STATE, [1]).where("frontier").first()
    assert (state.batch_id, state.n) == (2, 100)


def test_distinct_goes_on_after_a_restart_with_state_off_the_heap(spark):
    path, out = work_dir(spark, "t-input"), work_dir(spark, "t-restarted")

    def add(values):
        spark.createDataFrame([(0, v) for v in values], SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def opened():
        return ST.table_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, 1)

    add(range(40))
    assert ST.state_rows(ST.run_distinct(opened(), out)) == 40
    add(range(30, 70))
    progress = ST.run_distinct(opened(), out)   # a new query on the same checkpoint
    assert ST.state_rows(progress) == 70 and progress[-1]["batchId"] == 1
    assert "rocksdb" in str(progress[-1]["stateOperators"][0]["customMetrics"]).lower()
    assert sorted(r.item for r in ST._read(spark, f"{out}/items", "item BIGINT").collect()) == list(range(70))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ST.ROCKSDB[
        "spark.sql.streaming.stateStore.providerClass"]
