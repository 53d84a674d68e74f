"""Merkle manifest of a dataset: a SHA midstate tree over its documents.

Every row is a leaf, the SHA-256 of its fields (a null is ``-``, any other value its UTF-8
byte count, ``:`` and the value). Per group (``lang``) the leaves stand in id order; every
``FANOUT`` consecutive nodes become their common digest until one is left, the group's
subroot; subroots in group order (null first, then bytewise) give the root in the same way.
Digests enter a parent as lower-case hex text, which is one SHA block each.

A parent keeps a copy of the running hash state before each child slot (``Parent``). To fold
a changed leaf upwards, each parent on its path resumes the state kept for the slot with the
replacement and the siblings to the right; the siblings to the left are never hashed again.

On Spark. Digests are built-in column expressions; only they are sorted. A range sort by
(group, id, digest) is written once, and a node's place in its group is its row in the file
plus the rows before that file, one prefix sum over (file, group) counts. Trees are built
``FANOUT`` ** ``LEVELS`` nodes at a time: a block of that many consecutive nodes is
one step of one task, so neither a hot group nor a large one is ever held whole, and every
pass leaves 1/4096 of the nodes. The way back down hands each block the siblings above it,
as one more row of that block.

Defined cases: null ids come first in their group; rows of one id follow by digest, and
equal rows in any order among themselves, which changes no digest; null and empty fields
differ; a group of one leaf is its own subroot; an empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import id_field, materialize

FANOUT = 8
#: Tree levels built in one pass over the nodes; a block has FANOUT ** LEVELS nodes.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "grp string, pos long, n long, digest string"
_UP = "up array<struct<left:binary,right:binary>>, subroot string, root string"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields of a row, as hex text."""
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(c) for c in fields]), 256)


class Parent:
    """Up to ``FANOUT`` children (hex digests as bytes) and the hash state before each of them."""

    def __init__(self, children: list[bytes]):
        self.children, self.states, state = children, [], hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """This node's digest with another child in a slot."""
        state = self.states[slot].copy()
        state.update(replacement + b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()

    def beside(self, slot: int) -> tuple[bytes, bytes]:
        """The siblings to the left and to the right of a slot."""
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])


def subtree(digests: list[bytes], n: int, depth: int = LEVELS) -> list[list[Parent]]:
    """The levels, ``depth`` at most, over a block of consecutive nodes of a group that has ``n`` of them."""
    levels, nodes = [], digests
    while n > 1 and len(levels) < depth:
        levels.append([Parent(nodes[k:k + FANOUT]) for k in range(0, len(nodes), FANOUT)])
        nodes, n = [p.digest for p in levels[-1]], -(-n // FANOUT)
    return levels


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``grp``) plus ``pos``, their place by ``order`` inside their group from 0, and ``n``,
    the group's rows. Rows that tie in all of ``order`` are dealt out by a number of their own."""
    numbered = materialize(rows.withColumn("tie", F.monotonically_increasing_id()), f"{name}-rows")
    at = F.monotonically_increasing_id()
    parted = materialize(
        numbered.repartitionByRange("grp", *order, "tie").sortWithinPartitions("grp", *order, "tie")
        .select(F.spark_partition_id().alias("part"), at.alias("row"), *rows.columns), f"{name}-sorted")
    counts = parted.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("k"), F.min("row").alias("low"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("k").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = counts.select("part", "grp", (before - F.col("low")).alias("shift"), F.sum("k").over(group).alias("n"))
    return (parted.join(places, ["part", "grp"])
            .select(*rows.columns, (F.col("row") + F.col("shift")).alias("pos"), "n"))


def _by_block(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes block by block, each block in one partition and in order of place (a block's
    way up, at place -1, first)."""
    return (nodes.withColumn("block", F.when(F.col("pos") >= 0, F.floor(F.col("pos") / FANOUT ** depth)).otherwise(F.col("block")))
            .repartition("grp", "block").sortWithinPartitions("grp", "block", "pos"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[-1]["grp"], held[-1]["block"]) != (row["grp"], row["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def reduce_blocks(nodes: DataFrame, depth: int = LEVELS) -> DataFrame:
    """One node per block: (grp, pos, n, digest) of the level ``depth`` above."""
    schema = T._parse_datatype_string(_NODES)

    def run(batches):
        for rows in _blocks(batches):
            digests, n = [r["digest"].encode() for r in rows], rows[0]["n"]
            levels = subtree(digests, n, depth)
            top = levels[-1][0].digest if levels else digests[0]
            yield _batch([{"grp": rows[0]["grp"], "pos": rows[0]["block"], "n": -(-n // FANOUT ** depth),
                           "digest": top.decode()}], schema)

    plain = nodes.select("grp", "pos", "n", "digest", F.lit(None).cast("long").alias("block"))
    return _by_block(plain, depth).mapInArrow(run, schema)


def climb(nodes: DataFrame, name: str, depth: int = LEVELS) -> list[DataFrame]:
    """The nodes of every pass, from the given ones to one node per group."""
    passes = [nodes]
    while (most := passes[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        passes.append(materialize(reduce_blocks(passes[-1], depth), f"{name}-pass"))
    return passes


def _descend(nodes: DataFrame, ups: DataFrame, schema: T.StructType,
             emit: Callable[[dict, list, dict], dict], depth: int) -> DataFrame:
    """``emit(row, own, up)`` for every node: its own parents inside the block, as (Parent, slot),
    and the row that holds what is above the block."""

    def run(batches):
        for up, *rows in _blocks(batches):
            levels, out = subtree([r["digest"].encode() for r in rows], rows[0]["n"], depth), []
            up["resumed"] = [(hashlib.sha256(s["left"]), s["right"]) for s in up["up"]]
            up["beside"] = b"".join(s["left"] + s["right"] for s in up["up"])
            for at, row in enumerate(rows):
                own = []
                for parents in levels:
                    own.append((parents[at // FANOUT], at % FANOUT))
                    at //= FANOUT
                out.append(emit(row, own, up))
            yield _batch(out, schema)

    # A block's way up is one more row of it, before its nodes.
    above = ups.select("grp", F.lit(-1).cast("long").alias("pos"), F.col("pos").alias("block"), "up", "subroot", "root")
    return _by_block(nodes.unionByName(above, allowMissingColumns=True), depth).mapInArrow(run, schema)


def _ways(passes: list[DataFrame], top: DataFrame, depth: int) -> DataFrame:
    """The way up of every block of the lowest pass, from that of each group's top."""
    schema = T._parse_datatype_string(f"grp string, pos long, {_UP}")

    def emit(row, own, up):
        steps = [dict(zip(("left", "right"), parent.beside(slot))) for parent, slot in own]
        return {"grp": row["grp"], "pos": row["pos"], "up": steps + up["up"], "subroot": up["subroot"],
                "root": up["root"]}

    ways = top
    for nodes in reversed(passes[1:]):
        ways = _descend(nodes, ways, schema, emit, depth)
    return ways


def manifest(docs: DataFrame, replacement: Column | None = None, fields: tuple[str, ...] = FIELDS,
             group: str = "lang", id_col: str = "doc_id", text_col: str = "text", depth: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    ``replacement`` is the text whose leaf is folded in place of the original one (default:
    the original). ``proof_sha256`` is the digest of all siblings on the way to the root,
    ``folded_root`` the root recomputed with the replacement from them.
    """
    text = F.col(f"`{text_col}`")
    columns = {c: F.col(f"`{c}`") for c in fields}
    changed = {**columns, text_col: text if replacement is None else replacement}
    leaves = docs.select(
        columns[id_col].alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), columns[group].cast("string")), F.lit("")).alias("grp"),
        leaf_digest(*columns.values()).alias("digest"), leaf_digest(*changed.values()).alias("other"))
    schema = T.StructType([id_field(leaves, "doc_id"), *[T.StructField(c, T.StringType()) for c in (
        "leaf", "subroot", "root", "proof_sha256", "folded_root")], T.StructField("verified", T.BooleanType())])
    nodes = ranked(leaves, ["doc_id", "digest"], "merkle")
    if nodes.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    by_group = climb(nodes, "merkle", depth)
    subroots = ranked(by_group[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), ["of"], "subroots")
    over = climb(subroots.select("grp", "pos", "n", "digest"), "root", depth)
    root = over[-1].first()["digest"]

    # The root's way is empty; each group's top is a node of the tree over the groups.
    whole = over[-1].select("grp", "pos", F.expr("CAST(array() AS array<struct<left:binary,right:binary>>)").alias("up"),
                            F.lit(None).cast("string").alias("subroot"), F.lit(root).alias("root"))
    top_schema = T._parse_datatype_string(f"grp string, pos long, {_UP}")

    def emit_top(row, own, up):
        steps = [dict(zip(("left", "right"), parent.beside(slot))) for parent, slot in own]
        return {"grp": row["of"], "pos": 0, "up": steps + up["up"], "subroot": row["digest"], "root": up["root"]}

    tops = _descend(subroots, _ways(over, whole, depth), top_schema, emit_top, depth)

    def emit(row, own, up):
        folded, proof = row["other"].encode(), hashlib.sha256()
        for parent, slot in own:
            proof.update(b"".join(parent.beside(slot)))
            folded = parent.fold(slot, folded)
        proof.update(up["beside"])
        for kept, right in up["resumed"]:
            state = kept.copy()
            state.update(folded + right)
            folded = state.hexdigest().encode()
        folded = folded.decode()
        return {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": up["subroot"], "root": up["root"],
                "proof_sha256": proof.hexdigest(), "folded_root": folded, "verified": folded == up["root"]}

    return _descend(nodes, _ways(by_group, tops, depth), schema, emit, depth)
