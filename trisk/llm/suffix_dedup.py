"""Exact substring dedup: blockwise suffix sorting with a difference cover.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else too is found, in
memory that does not depend on the corpus:

1. Pruning. A string's anchor is the least hash of its ``GRAM``-byte grams, which depends on
   its bytes alone, so equal strings have equal anchors. Strings whose anchor occurs at one
   place only cannot repeat and are dropped; this loses nothing. What is left, runs of
   starting places with a common anchor and the text they read, is cut out as snippets.
2. Suffix buckets. An anchor's snippets form a bucket; buckets are dealt over the tasks and
   sorted one block of buckets at a time (``BLOCK_BYTES`` of text).
3. Sorting a block. Places t with t mod 13 in the difference cover {0, 1, 3, 9} are ranked by
   their next 419 bytes (doubling: 16 bytes, then pairs of ranks). Suffixes are sorted by
   bucket and 16 bytes; longer ties are split around pivots: for any two residues mod 13 some
   shift d <= 12 takes both suffixes to cover places, so their ranks there decide. Neighbours
   in the order that share ``LENGTH`` bytes repeat.

4. Large buckets. One of more than ``MAX_BUCKET`` snippets (a passage in a large part of all
   documents) is split before it is sorted. Equal strings hold their anchor at the same offset,
   so a snippet is cut where that offset passes a multiple of a width, and the pieces are dealt
   by the bytes that all strings of such a piece share: 64 at the first width, all ``LENGTH``
   at the last, which is 1. Pieces of the same bytes are whole repeats, and one of them stands for
   all in what follows. Parts that are small enough are sorted as in 3, larger ones go to the
   next width, so any bucket ends in parts of bounded size, and no string is left out.

Texts are UTF-8 bytes; strings never cross documents; copies of a whole text of at least
``LENGTH`` bytes are removed entirely and are read once. Shorter texts have nothing to remove and are
hashed where they are. The others are dealt out once, by their hash, into a bucketed table of distinct
texts with their anchors; the snippets, the pieces of large buckets and what is kept are cut out of
that table's files without a further exchange of texts.

Defined cases: null or empty text has 0 bytes and keeps the empty string; null or repeated
ids and rows are ordinary documents (a repeated row is a copy); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisk.llm.store import STEP, columns, materialize, text_batches
from trisk.session import materialize_bucketed

LENGTH = 400
GRAM = 64
#: Bytes of text whose suffixes are sorted at a time.
BLOCK_BYTES = 2 << 20
#: Snippets of one bucket that a task sorts (under 800 bytes each); larger ones are split first.
MAX_BUCKET = 30_000
#: Offsets of the anchor that the strings of a piece may have, as a large bucket is split.
WIDTHS = (LENGTH - GRAM + 1, 84, 21, 5, 1)
#: Starting places of one snippet, and bytes of a text hashed at a time.
MAX_RUN = 4096
PIECE = 1 << 20

# The cover: every difference mod 13 is one of two members' (checked in the tests).
PERIOD = 13
COVER = (0, 1, 3, 9)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: [i, j]: least shift that takes residues i and j into the cover.
SHIFT = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(i + d) % PERIOD] and _IN_COVER[(j + d) % PERIOD])
                   for j in range(PERIOD)] for i in range(PERIOD)])

_ODD = np.random.default_rng(7).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POS_BITS = np.uint64((1 << 21) - 1)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, inverse: bool, n: int) -> np.ndarray:
    """Powers 0 .. n - 1 of a base or of its inverse mod 2**64."""
    held = _powers.get((which, inverse))
    if held is None or len(held) < n:
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        held = np.full(max(n, 1 << 17), base, dtype=np.uint64)
        held[0] = 1
        held = _powers[which, inverse] = np.multiply.accumulate(held)
    return held[:n]


def string_hashes(raw: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each ``k`` bytes in a row."""
    terms = _ODD[which][raw] * _power(which, False, len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    h = (sums[k:] - sums[:-k]) * _power(which, True, len(raw) - k + 1)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` values in a row, from running minima inside blocks of ``w``."""
    n, blocks = len(x), -(-len(x) // w)
    padded = np.full(blocks * w, ~np.uint64(0))
    padded[:n] = x
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Yield (offset, anchor hash, anchor place) of the strings starting in each piece of a text."""
    for at in range(0, len(raw) - length + 1, PIECE):
        piece = raw[at:at + PIECE + length - 1]
        h = string_hashes(piece, gram)
        # Least hash, leftmost place: the place replaces the low bits.
        least = _sliding_min((h & ~_POS_BITS) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        place = (least & _POS_BITS).astype(np.int64)
        yield at, h[place].view(np.int64), place


def anchor_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hashes, places of each) of one text."""
    raw, found = np.frombuffer(text, dtype=np.uint8), []
    for _, key, place in anchors(raw):
        found.append(key[np.flatnonzero(np.diff(place, prepend=-1))])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def runs(raw: np.ndarray, wanted: np.ndarray):
    """Yield (anchor hash, first start, end of starts) of the runs with a wanted anchor."""
    wanted = np.sort(wanted)
    for at, key, _ in anchors(raw):
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        end = np.append(first[1:], len(key))
        where = np.minimum(np.searchsorted(wanted, key[first]), len(wanted) - 1)
        for k in np.flatnonzero(wanted[where] == key[first]).tolist():
            for a in range(first[k], end[k], MAX_RUN):
                yield int(key[first[k]]), at + a, at + min(a + MAX_RUN, int(end[k]))


def anchor_runs(raw: np.ndarray, wanted: np.ndarray):
    """Yield (anchor hash, first start, end of starts, anchor's place) of the runs at one place of a wanted anchor."""
    wanted = np.sort(wanted)
    for at, key, place in anchors(raw):
        first = np.flatnonzero(np.diff(place, prepend=-1))
        end = np.append(first[1:], len(key))
        where = np.minimum(np.searchsorted(wanted, key[first]), len(wanted) - 1)
        for k in np.flatnonzero(wanted[where] == key[first]).tolist():
            yield int(key[first[k]]), at + int(first[k]), at + int(end[k]), at + int(place[first[k]])


def pieces(key: int, lead: int, snippet: bytes, width: int, length: int = LENGTH):
    """Yield (key, shift, lead, piece) of a snippet whose first string has its anchor at offset ``lead``:
    the strings with offsets in [j * width, (j + 1) * width), under a key of the bytes they all share."""
    least = lead - (len(snippet) - length)
    for j in range(least // width, lead // width + 1):
        high, low = min(lead, j * width + width - 1), max(least, j * width)
        shared = snippet[lead - j * width:lead - j * width + length + 1 - width]
        digest = hashlib.blake2b(shared, digest_size=8, key=b"%d,%d" % (key, j)).digest()
        yield (int.from_bytes(digest, "big", signed=True), lead - high, high,
               snippet[lead - high:lead - low + length])


def cover_ranks(words: np.ndarray, n: int) -> np.ndarray:
    """Ranks of the cover places of a text by their next 419 bytes; zeros follow the text.

    ``words`` holds the next 8 bytes of every place as a big-endian number.
    """
    last = n + int(np.argmax(_IN_COVER[(n + np.arange(PERIOD)) % PERIOD]))  # a place in the zeros
    places = np.flatnonzero(_IN_COVER[np.arange(last + 1) % PERIOD])
    order = np.lexsort((words[places + 8], words[places]))
    a, b = words[places[order]], words[places[order] + 8]
    rank = np.empty(len(places), dtype=np.int64)
    rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
    by_place = np.empty(n + 1024, dtype=np.int64)
    for step in (13, 26, 52, 104, 208):
        by_place[last:] = rank[-1]
        by_place[places] = rank
        pairs = (rank << 32) | by_place[np.minimum(places + step, last)]
        rank = np.unique(pairs, return_inverse=True)[1].reshape(-1)
    by_place[last:] = rank[-1]
    by_place[places] = rank
    return by_place


def repeated_starts(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int = LENGTH,
                    seed: int = 0) -> np.ndarray:
    """Which places of a block's text start a string of ``length`` bytes that another start of
    the same bucket has too (a flag per place)."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(1024, np.uint8)])
    words = np.ndarray((n + 1000,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    rank = cover_ranks(words, n)
    order = np.lexsort((words[starts + 8], words[starts], bucket))
    pos, bucket = starts[order], bucket[order]
    w0, w1 = words[pos], words[pos + 8]
    tied = (bucket[1:] == bucket[:-1]) & (w0[1:] == w0[:-1]) & (w1[1:] == w1[:-1])
    group = np.concatenate([[0], np.cumsum(~tied)])
    same = np.zeros(max(len(pos) - 1, 0), dtype=bool)  # proven equal to the next in order
    rng = np.random.default_rng(seed)
    active = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if len(pos) else np.empty(0, int)
    group = group[active]
    while len(active):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(first, len(group)))
        pivot = np.repeat(pos[active[first + (rng.random(len(first)) * size).astype(np.int64)]], size)
        own = pos[active]
        shift = SHIFT[own % PERIOD, pivot % PERIOD]
        side = np.sign(rank[own + shift] - rank[pivot + shift]) + 1
        key = np.repeat(np.arange(len(first)), size) * 3 + side
        perm = np.argsort(key, kind="stable")
        pos[active] = own[perm]
        key = key[perm]
        equal = key % 3 == 1  # equal to the pivot over more than ``length`` bytes
        pairs = equal[1:] & (key[1:] == key[:-1])
        same[active[:-1][pairs]] = True
        new = np.concatenate([[True], key[1:] != key[:-1]])
        new_size = np.diff(np.append(np.flatnonzero(new), len(key)))
        left = ~equal & (np.repeat(new_size, new_size) > 1)
        active, group = active[left], np.cumsum(new)[left]
    # Neighbours of one 16-byte group that the ranks put apart may still share ``length`` bytes.
    near = np.flatnonzero(tied & ~same)
    for k in range(16, length - 7, 8):
        near = near[words[pos[near] + k] == words[pos[near + 1] + k]]
    for k in range(length - length % 8, length):
        near = near[padded[pos[near] + k] == padded[pos[near + 1] + k]]
    same[near] = True
    flags = np.zeros(n + 1, dtype=bool)
    pairs = np.flatnonzero(same)
    flags[pos[pairs]] = True
    flags[pos[pairs + 1]] = True
    return flags


def _spans_of_block(rows: list) -> tuple[list, list, list]:
    """(texts' hashes, span starts, span ends) found in one block of (key, hash, start, snippet) rows."""
    text = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    offsets = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    keys = np.array([r[0] for r in rows], dtype=np.int64)
    bucket = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    flags = repeated_starts(text, np.repeat(offsets, counts) + within, np.repeat(bucket, counts))
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0))
    first, end = edges[::2], edges[1::2]
    home = np.searchsorted(offsets, first, side="right") - 1
    base = np.array([r[2] for r in rows], dtype=np.int64)[home] - offsets[home]
    return [rows[k][1] for k in home.tolist()], (first + base).tolist(), (end - 1 + LENGTH + base).tolist()


def _bucket_spans(snippets: DataFrame) -> DataFrame:
    """(h, a, b): repeated byte spans found by sorting the snippets of each anchor."""

    def run(batches):
        held, size = [], 0

        def block(rows):
            hashes, a, b = _spans_of_block(rows)
            return pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(a, pa.int64()),
                                               pa.array(b, pa.int64())], names=["h", "a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if size >= BLOCK_BYTES and held[-1][0] != row[0]:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield block(held)

    return (snippets.repartition("key").sortWithinPartitions("key").select("key", "h", "start", "snippet")
            .mapInArrow(run, "h binary, a long, b long"))


def _piece_batches(rows):
    """(key, h, start, lead, snippet) rows as batches of bounded bytes; a row without a snippet is a
    known repeat of ``lead`` bytes."""
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    held, size = [], 0
    for row in itertools.chain(rows, [None]):
        if held and (row is None or size >= BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kind) for k, kind in enumerate(kinds)],
                                             names=["key", "h", "start", "lead", "snippet"])
            held, size = [], 0
        if row is not None:
            held.append(row)
            size += 64 + len(row[4] or b"")


_SPANS = "array<struct<a: long, b: long>>"
_PIECES = "key long, h binary, start long, lead long, snippet binary"


def _split_spans(found: DataFrame, max_bucket: int) -> list[DataFrame]:
    """Frames of (h, a, b): repeated byte spans of large buckets, given as pieces of the first width."""
    spans, place = [], F.struct("h", "start")
    for k, _ in enumerate(WIDTHS):
        marked = found.withColumn("digest", F.md5("snippet"))
        same = marked.groupBy("key", "digest").agg(F.min(place).alias("low"), F.max(place).alias("high"))
        marked = materialize(marked.join(same, ["key", "digest"]), "pieces")
        spans.append(marked.filter(F.col("low") != F.col("high"))
                     .select("h", F.col("start").alias("a"), (F.col("start") + F.length("snippet")).alias("b")))
        alone = marked.filter(place == F.col("low")).select("key", "h", "start", "lead", "snippet")
        large = materialize(alone.groupBy("key").count().filter(F.col("count") > max_bucket).select("key"), "large")
        if k + 1 == len(WIDTHS) or large.isEmpty():
            return [*spans, _bucket_spans(alone)]
        spans.append(_bucket_spans(alone.join(large, "key", "left_anti")))

        def split(batches, width=WIDTHS[k + 1]):
            yield from _piece_batches(
                (new, h, start + shift, ahead, part)
                for batch in batches for at in range(0, batch.num_rows, STEP)
                for key, h, start, lead, snippet in zip(*(c.to_pylist() for c in batch.slice(at, STEP).columns))
                for new, shift, ahead, part in pieces(key, lead, snippet, width))

        found = materialize(alone.join(large, "key").select("key", "h", "start", "lead", "snippet")
                            .mapInArrow(split, _PIECES), "split")
    return spans


def distinct_texts(docs: DataFrame) -> DataFrame:
    """A table bucketed by ``h`` of (h, copies, n_bytes, text, keys, counts): each text once, how often it came, and
    its anchors with the places of each. ``docs`` has (h, text)."""

    def count(batches):
        for batch, texts in text_batches(batches, "text"):
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            found = [anchor_counts(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(r) for r in raw], pa.int64()), batch.column(2),
                 pa.array([k for k, _ in found], pa.list_(pa.int64())),
                 pa.array([c for _, c in found], pa.list_(pa.int64()))],
                names=["h", "copies", "n_bytes", "text", "keys", "counts"])

    once = docs.groupBy("h").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    return materialize_bucketed(once.mapInArrow(
        count, "h binary, copies long, n_bytes long, text string, keys array<long>, counts array<long>"),
        "texts", "h", dealt=True)


def repeated_spans(texts: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(h, spans): the repeated byte spans of each distinct text that has any."""
    places = texts.select("h", F.inline(F.arrays_zip("keys", "counts")))
    live = (places.groupBy("keys").agg(F.sum("counts").alias("n")).filter("n > 1")
            .select("keys", (F.col("n") > max_bucket).alias("hot")))
    wanted = materialize(places.select("h", "keys").join(live, "keys").groupBy("h").agg(
        F.collect_list(F.when(~F.col("hot"), F.col("keys"))).alias("live"),
        F.collect_list(F.when(F.col("hot"), F.col("keys"))).alias("hot")), "live-anchors")
    cut_from = texts.select("h", "text").join(wanted, "h").select("h", "text", "live", "hot")

    def snippets(batches):
        for batch, texts in text_batches(batches, "text"):
            out = []
            hashes, live_keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for h, text, keys in zip(hashes, texts, live_keys):
                if not keys:
                    continue
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                out += [(key, h, a, raw[a:b - 1 + LENGTH].tobytes()) for key, a, b in runs(raw, np.array(keys))]
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)],
                                             names=["key", "h", "start", "snippet"])

    def large_pieces(h, raw, keys):
        seen, known = {}, []
        for key, a, b, place in anchor_runs(raw, np.array(keys)):
            for new, shift, ahead, part in pieces(key, place - a, raw[a:b - 1 + LENGTH].tobytes(), WIDTHS[0]):
                at = a + shift
                before = seen.setdefault((new, part), at)
                if before == at:
                    yield new, h, at, ahead, part
                else:  # twice in one text
                    known += [(before, before + len(part)), (at, at + len(part))]
        for a, b in merged(known):
            yield 0, h, a, b - a, None

    def large(batches):
        def rows():
            for batch, texts in text_batches(batches, "text"):
                for h, text, keys in zip(batch.column(0).to_pylist(), texts, batch.column(3).to_pylist()):
                    if keys:
                        yield from large_pieces(h, np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), keys)

        yield from _piece_batches(rows())

    spans = _bucket_spans(cut_from.mapInArrow(snippets, "key long, h binary, start long, snippet binary"))
    if not wanted.filter(F.size("hot") > 0).isEmpty():
        hot = materialize(cut_from.filter(F.size("hot") > 0).mapInArrow(large, _PIECES), "split")
        known = hot.filter("snippet IS NULL").select("h", F.col("start").alias("a"),
                                                     (F.col("start") + F.col("lead")).alias("b"))
        for more in [known, *_split_spans(hot.filter("snippet IS NOT NULL"), max_bucket)]:
            spans = spans.unionByName(more)
    return spans.groupBy("h").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs covered by byte spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans), one row per document."""
    rows = columns(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.unhex(F.md5("text")).alias("h"),
                       F.octet_length("text").cast("long").alias("n_bytes"))
    texts = distinct_texts(rows.filter(F.col("n_bytes") >= LENGTH).select("h", "text"))
    marks = materialize(repeated_spans(texts, max_bucket), "repeats")

    def run(batches):
        for batch, whole in text_batches(batches, "text"):
            out = []
            for text, spans in zip(whole, batch.column(2).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                gone = merged([(s["a"], s["b"]) for s in spans])
                edges = [0, *(x for ab in gone for x in ab), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(raw) - len(kept), hashlib.sha256(kept).hexdigest(), [{"a": a, "b": b} for a, b in gone]))
            kinds = (pa.int64(), pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]],
                names=["h", "n_removed", "kept_sha256", "spans"])

    part = (texts.filter("copies = 1").select("h", "text").join(marks, "h").select("h", "text", "spans")
            .mapInArrow(run, f"h binary, n_removed long, kept_sha256 string, spans {_SPANS}"))
    whole = texts.filter("copies > 1").select(
        "h", F.col("n_bytes").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"),
        F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b"))).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(_SPANS))
    return (rows.select("doc_id", "h", "n_bytes", F.sha2("text", 256).alias("unchanged"))
            .join(part.unionByName(whole), "h", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.size(spans).cast("long").alias("n_spans"),
                    F.coalesce("kept_sha256", "unchanged").alias("kept_sha256"), spans.alias("spans")))
