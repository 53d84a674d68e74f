"""SimHash near-duplicates with a Gray-order hierarchical index.

A document's fingerprint sets a bit where over half of its shingles' XXH64 hashes (seed
42) do. Words are runs without ASCII white space, A-Z lower-cased; shingles are ``shingle``
words joined by spaces, repeats counted; fewer words make one shingle; no words make the
fingerprint zero, which links like any other. Fingerprints link at ``max_bits`` or fewer
differing bits, and links join documents transitively.

Index. Two fingerprints within 3 bits agree on one of 4 blocks of 16 bits, so each distinct
fingerprint goes to 4 key groups (one per block, rotated to the front). A group is sorted by
Gray rank, which puts fingerprints that differ little side by side; runs of ``FANOUT``
become a node that keeps the bits all of them share, and so on upwards. A node stores only
the shared bits its parent does not have yet. A search goes down from the root adding up the
differences on those bits and drops a whole node once they exceed ``max_bits``; at the
leaves the sum is the exact distance. Each task turns the links it finds into spanning
edges at once, so a dense group never lists its pairs.

A group over ``MAX_GROUP`` distinct fingerprints is split further by the same rule on its
remaining bits (4 blocks again), so no task holds an unbounded group and no link is lost.

Defined cases: null text has no words; null ids get a fingerprint and a component like
others and are no candidates for ``component_id`` (a component of null ids only has null);
repeated ids and rows are ordinary documents; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.components import components
from trisk.llm.store import columns, id_field, materialize, text_batches

SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 8
#: Distinct fingerprints of one key group that a task may hold; larger groups are split.
MAX_GROUP = 200_000
#: Rows of one index partition.
PARTITION_ROWS = 400_000
#: Queries searched at a time.
CHUNK = 2048
_LOWER = bytes(range(256)).lower()


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-shingle]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = 2 * counts > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, fp): the fingerprint as a signed 64-bit integer."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *keep)
    schema = T.StructType([id_field(rows, "doc_id")] + [rows.schema[k] for k in keep]
                          + [T.StructField("fp", T.LongType())])

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            others = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
            yield pa.RecordBatch.from_arrays([*others, pa.array(fps)], names=schema.names)

    return rows.mapInArrow(run, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class GrayIndex:
    """Hierarchical index over groups of codes; a group shares its key and the first bits."""

    def __init__(self, group: np.ndarray, codes: np.ndarray, fanout: int = FANOUT):
        self.order = np.lexsort((gray_rank(codes), group))
        self.codes, group = codes[self.order], group[self.order]
        every = np.full(len(codes), ~np.uint64(0))
        # A level: (shared bits' mask, pattern, first child, end of children, last leaf), leaves first.
        levels = [[every, self.codes, None, None, np.arange(len(codes))]]
        while True:
            shared, pattern, _, _, last = levels[-1]
            new = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.empty(0, bool)
            starts = np.flatnonzero(new)
            if len(starts) == len(group):
                break
            at = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
            first = np.flatnonzero(at % fanout == 0)
            end = np.append(first[1:], len(group))
            common = np.bitwise_and.reduceat(shared, first)
            low = np.bitwise_and.reduceat(pattern, first)
            high = np.bitwise_or.reduceat(pattern, first)
            mask = common & ~(low ^ high)
            levels.append([mask, low & mask, first, end, last[end - 1]])
            group = group[first]
        # What a node adds to its parent's shared bits.
        self.levels = []
        for k, (mask, pattern, first, end, last) in enumerate(levels):
            own = mask
            if k + 1 < len(levels):
                above = levels[k + 1]
                own = mask & ~np.repeat(above[0], above[3] - above[2])
            self.levels.append((own, pattern, first, end, last))
        top = group  # one node per group
        self.root_of = np.empty(len(codes), dtype=np.int64)
        if len(codes):
            bounds = self.levels[-1][4]
            self.root_of[:] = np.searchsorted(bounds, np.arange(len(codes)))
        self.n_roots = len(top)

    def links(self, max_bits: int):
        """Yield arrays (i, j), positions in ``order``, i < j, of codes of a group within ``max_bits``."""
        n = len(self.codes)
        last_of_root = self.levels[-1][4]
        alone = last_of_root[self.root_of] == np.arange(n)  # nothing of its group comes after it
        queries = np.flatnonzero(~alone)
        for at in range(0, len(queries), CHUNK):
            q = queries[at:at + CHUNK]
            node, acc = self.root_of[q], np.zeros(len(q), dtype=np.uint8)
            for k in range(len(self.levels) - 1, -1, -1):
                own, pattern, first, end, last = self.levels[k]
                acc = acc + np.bitwise_count((self.codes[q] ^ pattern[node]) & own[node])
                live = (acc <= max_bits) & (last[node] > q)
                q, node, acc = q[live], node[live], acc[live]
                if k == 0 or not len(q):
                    break
                n_children = (end - first)[node]
                total = int(n_children.sum())
                offset = np.arange(total) - np.repeat(np.cumsum(n_children) - n_children, n_children)
                q, acc = np.repeat(q, n_children), np.repeat(acc, n_children)
                node = np.repeat(first[node], n_children) + offset
            if len(q):
                yield q, node


class Forest:
    """Union of links into least labels, a chunk at a time."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            y = self.label[x]
            if np.array_equal(x, y):
                return x
            x = y

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root(i), self.root(j)
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))


def _rotated(bits: int, offset: int) -> str:
    """SQL: ``code`` with its low ``bits`` bits rotated left by ``offset``."""
    if not offset:
        return "code"
    if bits == 64:
        return f"(shiftleft(code, {offset}) | shiftrightunsigned(code, {64 - offset}))"
    mask = (1 << bits) - 1
    low = f"(code & {mask}L)"
    return (f"((code & {~mask}L) | (((shiftleft({low}, {offset})) | shiftrightunsigned({low}, {bits - offset}))"
            f" & {mask}L))")


def key_groups(fps: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(path, prefix, code, fp): each distinct fingerprint under every key it must be sought by.

    ``code`` is the fingerprint with the key's bits in front; codes of one path are permuted
    alike, so their distances are those of the fingerprints.
    """
    blocks = max_bits + 1
    rows = fps.select(F.lit("").alias("path"), F.col("fp").alias("code"), "fp")
    done, fixed = None, 0
    while True:
        free = 64 - fixed
        width = free // blocks  # no block of the free bits is shorter
        turned = F.array(*[F.struct(F.concat(F.col("path"), F.lit(str(b))).alias("path"),
                                    F.expr(_rotated(free, b * free // blocks)).alias("code"))
                           for b in range(blocks)])
        fixed += width
        rows = (rows.select("fp", F.explode(turned).alias("k")).select("k.path", "k.code", "fp")
                .withColumn("prefix", F.expr(f"shiftrightunsigned(code, {64 - fixed})")))
        large = rows.groupBy("path", "prefix").count().filter(F.col("count") > max_group)
        if free - width < 2 * blocks or large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        large = F.broadcast(large.drop("count"))  # at most rows / max_group keys
        small = rows.join(large, ["path", "prefix"], "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = materialize(rows.join(large, ["path", "prefix"], "left_semi").select("path", "code", "fp"), "groups")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): spanning edges of the links between distinct fingerprints (column ``fp``)."""
    groups = key_groups(fps, max_bits, max_group)
    n = fps.count() * (max_bits + 1)
    parts = max(1, -(-n // PARTITION_ROWS), min(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                                 -(-n // 20_000)))

    def run(batches):
        taken = list(batches)
        if not taken:
            return
        table = pa.Table.from_batches(taken)
        keys = table.column("path").combine_chunks().dictionary_encode()
        if isinstance(keys, pa.ChunkedArray):
            keys = keys.combine_chunks()
        path = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        prefix = table.column("prefix").to_numpy().astype(np.int64)
        codes = table.column("code").to_numpy().astype(np.int64).view(np.uint64)
        fp = table.column("fp").to_numpy()
        order = np.lexsort((prefix, path))
        change = (np.diff(path[order]) != 0) | (np.diff(prefix[order]) != 0)
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.concatenate([[0], np.cumsum(change)])
        index, forest = GrayIndex(group, codes), Forest(len(codes))
        for i, j in index.links(max_bits):
            forest.join(i, j)
        low = forest.root(forest.label)
        linked = np.flatnonzero(low != np.arange(len(low)))
        if len(linked):
            names = fp[index.order]
            yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(names[low[linked]])], names=["a", "b"])

    return (groups.repartition(parts, "path", "prefix").select("path", "prefix", "code", "fp")
            .mapInArrow(run, "a long, b long"))


def label_documents(signed: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, fp, ...) with ``label``: the component's name, equal for linked documents."""
    fps = materialize(signed.select("fp").distinct(), "fingerprints")
    roots = components(fingerprint_links(fps, max_bits, max_group))
    return (signed.join(roots.withColumnRenamed("a", "fp"), "fp", "left")
            .withColumn("label", F.coalesce("root", "fp")).drop("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): one row per document with its component's smallest id."""
    signed = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    labelled = materialize(label_documents(signed, max_bits), "simhash-labels")
    # Written first, so that the join reads two plain shuffles and a hot component can be split.
    least = materialize(labelled.groupBy("label").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return labelled.join(least, "label").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row left of each component: the one of the smallest id (nulls last), of its
    rows the one of the least hash of all columns."""
    ident = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    signed = materialize(fingerprints(docs.withColumn("__text_hash", ident), id_col, text_col, shingle,
                                      keep=("__text_hash",)), "simhash")
    labelled = label_documents(signed, max_bits)
    kept = (labelled.groupBy("label")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__text_hash")).alias("k"))
            .select(F.col("k.doc_id").alias("__id"), F.col("k.__text_hash").alias("__hash")))
    kept = materialize(kept.distinct(), "simhash-kept")
    marked = docs.withColumn("__text_hash", ident)
    joined = marked.join(kept, marked[id_col].eqNullSafe(kept["__id"]) & (marked["__text_hash"] == kept["__hash"]))
    # Of rows with the same id and text the one of the least hash stays, found before the shuffle in each part.
    row_hash = F.xxhash64(*[marked[f.name] for f in docs.schema if "map" not in f.dataType.simpleString()])
    once = joined.groupBy("__id", "__hash").agg(
        F.min_by(F.struct(*[marked[c].alias(c) for c in docs.columns]), row_hash).alias("__row"))
    return once.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
