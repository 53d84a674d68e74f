from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF
from trisk.operators import batches as B
from trisk.sources.items import batched_events


def events(spark, sf="0.01"):
    return spark.read.parquet(f"{SF[sf]}/events.parquet")


def test_cutoff_fixture(spark):
    lengths = B.batch_lengths(batched_events(events(spark)), 10, 100)
    assert sorted(r.n for r in lengths.collect()) == [1250] * 8
    kept = B.prefix_cutoff(lengths, 5000)
    assert sorted(r.batch_id for r in kept.collect()) == [0, 1, 2, 3]
    assert kept.agg(F.sum("n")).first()[0] == 5000
    kept = B.prefix_cutoff(lengths, 5001)
    assert sorted(r.batch_id for r in kept.collect()) == [0, 1, 2, 3, 4]
    assert kept.agg(F.sum("n")).first()[0] == 6250


def test_prefix_sum_by_levels_equals_one_window(spark):
    import random
    rng = random.Random(1)
    rows = [(i * 3 + rng.randrange(3), rng.randrange(1, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "batch_id bigint, n bigint")
    got = {r.batch_id: r.preceding for r in B.preceding_sum(df, blocks=7).collect()}
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    want = {r.batch_id: r.p for r in df.select("batch_id", F.coalesce(F.sum("n").over(w), F.lit(0))
                                                .alias("p")).collect()}
    assert got == want
    plan = B.preceding_sum(df, blocks=7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") == 0  # the rows were read once, into the blocks


def test_prefix_sum_keeps_repeated_ids_and_columns(spark):
    df = spark.createDataFrame([(-5, 2, "a"), (0, 3, "b"), (0, 3, "b"), (9, 1, None)], "batch_id bigint, n bigint, x string")
    got = sorted((r.batch_id, r.preceding) for r in B.preceding_sum(df, blocks=4).collect())
    assert got == [(-5, 0), (0, 2), (0, 5), (9, 8)]
    assert B.preceding_sum(df.where("n < 0")).collect() == []


def test_prefix_sum_packs_no_rows(spark):
    df = spark.range(3000).selectExpr("id * 5 - 700 AS batch_id", "id % 9 AS n", "repeat('x', 50) AS x")
    out = B.preceding_sum(df, blocks=8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The rows' window is dealt by blocks; the other one has a row per block.
    assert "collect_list" not in plan and plan.count("Window [") == 2 and plan.count("[_block") >= 2
    total, want = 0, []
    for i in range(3000):
        want.append((i * 5 - 700, i % 9, "x" * 50, total))
        total += i % 9
    assert sorted(map(tuple, out.collect())) == want


def test_sparse_ids_are_dealt_over_all_blocks(spark):
    # Ids 2^24 apart, as time stamps are: blocks are ranges of the ids that exist.
    df = spark.range(400).selectExpr("id * (1L << 24) AS batch_id", "1L AS n")
    out = B.preceding_sum(df, blocks=8)
    assert [r.preceding for r in out.orderBy("batch_id").collect()] == list(range(400))
    sizes = [r["count"] for r in out.groupBy(F.floor(F.col("preceding") / 50)).count().collect()]
    assert len(sizes) == 8
    files = {f.rpartition("/")[2] for f in out.inputFiles()}
    assert len(files) >= 6  # one per block with rows


def test_partials_merge_is_the_histogram_of_kept_batches(spark):
    bt = batched_events(events(spark))
    kept = B.prefix_cutoff(B.batch_lengths(bt, 10, 100), 5000)
    merged = B.merge_partials(B.batch_partials(bt, 10, 100), kept)
    direct = (bt.where("batch_id < 4 AND item BETWEEN 10 AND 100").groupBy("item")
              .agg(F.count(F.lit(1)).alias("freq")))
    assert sorted(merged.collect()) == sorted(direct.collect())
    # a replayed batch (same partial delivered twice, keyed by batch id) changes nothing
    parts = B.batch_partials(bt, 10, 100)
    replay = parts.unionByName(parts.where("batch_id = 2")).dropDuplicates(["batch_id", "item"])
    assert sorted(B.merge_partials(replay, kept).collect()) == sorted(merged.collect())


def test_distinct_report(spark):
    items = events(spark).select(F.col("user_id").alias("item"))
    r = B.distinct_report(items).first()
    assert (r.items, r.distinct_items, r.largest_item) == (10000, 150, 149)
    empty = items.where("item < 0")
    r = B.distinct_report(empty).first()
    assert (r.items, r.distinct_items, r.largest_item) == (0, 0, None)
