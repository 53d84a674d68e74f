"""Mixing sources to target weights by a low-discrepancy slot schedule (DataFrame only).

The mix is a schedule of slots of ``BLOCK_WORDS`` words each. Slot i is the point
frac((i + 1/2) * golden ratio); the points are mapped through the cumulative target
shares of the sources, so every stretch of the schedule holds the sources close to
their shares. The r-th slot of a source takes the r-th equal-token block of that
source: its documents laid end to end in a shuffled order (md5 of seed, id and text),
over and over. A block is thus joined to a slot on (source, rank).

Every source ends at its own target, to the word, at any size of corpus: its last block is
partial, and the few blocks that the points of its share leave over (a source smaller than a
block among them) are put in at points of the same sequence. Such a slot holds two blocks.

Sizes are words ``[^\\x20\\x09-\\x0D]+`` (null text: 0). Targets share the total by
weight; a source's target stops at ``cap`` times its size and the excess is reshared
by weight until none is above. No document is taken more than ``cap`` times.

Defined cases: an empty table gives no rows; a null source is a source of its own, the
last one; null and repeated ids and repeated rows are ordinary documents (rows equal in id,
source and text are interchangeable); empty documents take nothing.

Scale: prefix sums are two-level (65,536 hash buckets per source, ranges of slots), so a
source or an id with a third of all rows is spread; slots meet the cumulative shares by an
equality join on cells, not by a range join; only (id, source, size, hash) rows are shuffled.
Windows over all sources hold one row per source: for thousands of sources, not for a
source per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisk.llm.store import materialize

#: Default weights by source in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of a slot; the number of slots follows the corpus.
BLOCK_WORDS = 8192
#: Slots whose ranks one window counts.
SLOT_RANGE = 1 << 16
#: No source or document is taken more than this many times.
CAP = 3
#: Cells over [0, 1) that slots and shares are joined on.
CELLS = 4096
GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text as BIGINT; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, cap: int = CAP) -> DataFrame:
    """(skey, source, source_size) to the same with ``target``, the total by weight, water-filled, and
    ``upto``, the target in whole words.

    The windows run over one row per source, not over documents.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    fill = Window.partitionBy(F.lit(1)).orderBy("limit_ratio", "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    n = len(weights)
    ranked = (sizes.withColumn("rank", F.row_number().over(by_source) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % n + 1).cast("int")))
              .withColumn("limit_ratio", (cap * F.col("source_size")).cast("double") / F.col("weight")))
    level = ((F.sum("source_size").over(every) * F.lit(share)
              - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    first_free = F.min(F.when(F.col("level") <= F.col("limit_ratio"),
                              F.struct("limit_ratio", "rank", "level"))).over(every)["level"]
    return (ranked.withColumn("level", level).withColumn("free_level", first_free)
            .withColumn("target", F.least((cap * F.col("source_size")).cast("double"),
                                          F.coalesce(F.col("free_level") * F.col("weight"),
                                                     (cap * F.col("source_size")).cast("double"))))
            .withColumn("upto", F.floor(F.col("target") + F.lit(0.5)).cast("bigint"))
            .select("skey", "source", "source_size", "rank", "target", "upto"))


def _point(i: Column) -> Column:
    """The i-th point of the golden-ratio sequence, in [0, 1)."""
    x = (i + F.lit(0.5)) * F.lit(GOLDEN)
    return x - F.floor(x)


def slot_schedule(spark, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, skey, block): golden-ratio points through the cumulative targets, ranked per source.

    Every block of every source's target is there once; ``slot`` orders the mix.
    """
    line = Window.partitionBy(F.lit(1)).orderBy("rank")
    total = F.sum("target").over(Window.partitionBy(F.lit(1)))
    shares = (targets.filter(F.col("upto") > 0)
              .withColumn("n_blocks", F.ceil(F.col("upto") / F.lit(block_words)).cast("bigint"))
              .withColumn("lo", F.coalesce(F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0.0)) / total)
              .withColumn("hi", F.sum("target").over(line) / total)
              .withColumn("last", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("rank"))) == 1)
              .withColumn("hi", F.when(F.col("last"), F.lit(1.0)).otherwise(F.col("hi"))))
    words = targets.agg(F.coalesce(F.sum("upto"), F.lit(0))).first()[0]
    n_slots = -(-words // block_words)
    celled = shares.select("skey", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.floor(F.col("hi") * CELLS))).alias("cell"))
    points = (spark.range(n_slots).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
              .withColumn("cell", F.floor(F.col("u") * CELLS)))
    owned = materialize(points.join(celled, "cell").filter((F.col("lo") <= F.col("u")) & (F.col("u") < F.col("hi")))
                        .select("slot", "skey", F.floor(F.col("slot") / SLOT_RANGE).alias("part")), "mix-slots")
    parts = owned.groupBy("skey", "part").agg(F.count("*").alias("n"))
    across = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("skey", "part").orderBy("slot")
    ranked = (owned.withColumn("nth", F.row_number().over(inside) - 1)
              .join(parts.select("skey", "part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base")),
                    ["skey", "part"])
              .join(shares.select("skey", "n_blocks"), "skey")
              .select("slot", "skey", (F.col("base") + F.col("nth")).cast("bigint").alias("block"), "n_blocks")
              .filter(F.col("block") < F.col("n_blocks")).drop("n_blocks"))
    # The points of a share miss its number of blocks by the sequence's discrepancy at most.
    left = (shares.join(parts.groupBy("skey").agg(F.sum("n").alias("n")), "skey", "left")
            .withColumn("n", F.coalesce("n", F.lit(0))).filter(F.col("n") < F.col("n_blocks"))
            .select("skey", "rank", F.explode(F.sequence(F.col("n"), F.col("n_blocks") - 1)).alias("block"))
            .select(F.floor(_point(F.col("rank") + F.col("block")) * n_slots).cast("bigint").alias("slot"), "skey",
                    F.col("block").cast("bigint").alias("block")))
    return ranked.unionByName(left)


def source_key(source_col: str) -> Column:
    """A source as text that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("n"))


def order_hash(id_col: str, text_col: str, seed: str) -> Column:
    """What a source's documents are shuffled by; rows of one id differ by their texts."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(F.col(f"`{text_col}`")), F.lit(""))))


def place_documents(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """(doc_id, skey, order_hash, source, size, start): every document's offset on its source's shuffled line."""
    hashed = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                          word_count(F.col(f"`{text_col}`")).alias("size"), source_key(source_col).alias("skey"),
                          order_hash(id_col, text_col, seed).alias("order_hash"))
              .withColumn("bucket", F.substring("order_hash", 1, 4)))
    inside = (Window.partitionBy("skey", "bucket").orderBy("order_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = materialize(hashed.withColumn("local_start", F.coalesce(F.sum("size").over(inside), F.lit(0))),
                        "mix-places")
    across = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (local.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size"))
             .select("skey", "bucket", F.coalesce(F.sum("bucket_size").over(across), F.lit(0)).alias("base")))
    return (local.join(bases, ["skey", "bucket"])
            .select("doc_id", "skey", "order_hash", "source", "size", (F.col("base") + F.col("local_start")).alias("start")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, share: float = 1.0, cap: int = CAP, block_words: int = BLOCK_WORDS, seed: str = "mix"
        ) -> tuple[DataFrame, DataFrame]:
    """The mix as (documents, pieces).

    ``documents``: doc_id, skey, order_hash, source, size, start, source_size, target, upto, one
    row per input row.
    ``pieces``: slot, skey, block, doc_id, start, copy, from_word, to_word: which words of a
    document a slot takes, in its ``copy``-th round through the source.
    """
    spark = docs.sparkSession
    placed = place_documents(docs, id_col, source_col, text_col, seed)
    sizes = placed.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, cap), "mix-targets")
    documents = placed.join(targets.select("skey", "source_size", "target", "upto"), "skey")
    # A copy of a document is words [a, b) of its source's endless line, which stops at ``upto``.
    copies = (documents.filter((F.col("size") > 0) & (F.col("start") < F.col("upto")))
              .withColumn("copy", F.explode(F.expr("sequence(0, (upto - 1 - start) div source_size)")))
              .withColumn("a", F.col("copy") * F.col("source_size") + F.col("start"))
              .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("upto"))))
    cut = copies.withColumn("block", F.explode(F.expr(f"sequence(a div {block_words}, (b - 1) div {block_words})")))
    lo = F.greatest(F.col("a"), F.col("block") * block_words) - F.col("a")
    hi = F.least(F.col("b"), (F.col("block") + 1) * block_words) - F.col("a")
    pieces = (cut.select("skey", "block", "doc_id", "start", "copy", lo.alias("from_word"), hi.alias("to_word"))
              .join(slot_schedule(spark, targets, block_words), ["skey", "block"]))
    return documents, pieces


def taken_words(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: the words that all slots take of each, repeats counted."""
    # (skey, start) names one document among those with words.
    taken = (pieces.groupBy("skey", "start")
             .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words")))
    with_words = documents.filter(F.col("size") > 0).join(taken, ["skey", "start"], "left")
    none = documents.filter(F.col("size") <= 0).withColumn("words", F.lit(None).cast("bigint"))
    return (with_words.unionByName(none)
            .withColumn("taken", F.coalesce(F.col("words"), F.lit(0)).cast("bigint")).drop("words"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    **options) -> DataFrame:
    """The mix as documents with the input's columns: every document as often as it is taken whole,
    plus one copy cut after its first words where the mix ends inside it; untaken ones go.

    Rows equal in id, source and text share their takes by the order of their other columns' hash.
    """
    seed = options.get("seed", "mix")
    documents, pieces = mix(docs, id_col, source_col, text_col, **options)
    key = ["__skey", "__key"]
    takes = (taken_words(documents, pieces)
             .select(F.col("skey").alias("__skey"), F.col("order_hash").alias("__key"), "start",
                     F.col("size").alias("__size"), F.col("taken").alias("__taken"))
             .withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy("start")))
             .filter("__taken > 0").drop("start"))
    hashable = [F.col(f"`{f.name}`") for f in docs.schema if "map" not in f.dataType.simpleString()]
    numbered = (docs.withColumn("__skey", source_key(source_col)).withColumn("__key", order_hash(id_col, text_col, seed))
                .withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*hashable)))))
    joined = numbered.join(takes, [*key, "__nth"])
    rest = F.col("__taken") % F.col("__size")
    counts = F.array_repeat(F.lit(-1).cast("bigint"), (F.col("__taken") / F.col("__size")).cast("int"))
    copies = F.when(rest > 0, F.concat(counts, F.array(rest))).otherwise(counts)
    out = joined.withColumn("__words", F.explode(copies))
    text = F.col(f"`{text_col}`")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1)),
                               F.lit(1), F.col("__words").cast("int")), "")
    new_text = F.when(F.col("__words") < 0, text).otherwise(F.rtrim(cut))
    return out.withColumn(text_col, new_text).select(*[F.col(f"`{c}`") for c in docs.columns])
