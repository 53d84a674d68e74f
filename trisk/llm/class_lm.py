"""Language-model scores by Brown classes: exchange clustering and a class bigram model.

Tokens are a text's words (A-Z lower-cased, cut at ASCII white space) and one end token, which
also stands before the first word. Words get ``CLASSES`` classes such that the class bigram
likelihood sum(N(c, d) log N(c, d)) - 2 sum(N(c) log N(c)) is large; the model is

    p(w | v) = t(c(w) | c(v)) n(w) / N(c(w))

with transitions t from the class bigrams, smoothed by the classes' own frequencies. Unseen
words are one class of a single word, of probability u = (n1 + 1) / (N + V + 1) everywhere
(n1 words were seen once); t leaves that much, so p sums to 1 over all words and the unseen
one. After an unseen word the classes' frequencies stand for the transitions.

Exchange on Spark. A move of one word changes the likelihood by an amount that the class
bigram matrix (bounded by ``CLASSES`` squared) and the word's own counts with each class give
exactly (``gains``).

1. Texts are encoded once, in rows of about ``BLOCK_BYTES`` of text with a word list of their own.
   Only blocks' distinct words are ever joined to the vocabulary, never tokens.
2. Words with at least 1 / ``SHARE`` of all tokens, of which there are ``SHARE`` at most at any
   size, start in classes by rank and are exchanged for ``ROUNDS`` rounds on the table of their
   bigrams, half of them per round, all others counting as one class; the best assignment
   of all rounds stays.
3. Every other word is then moved from that class to the best one, by all its contexts.
   Their counts are made per block before they are shuffled, and a word there has less than
   1 / ``SHARE`` of all tokens, so no task gets a hot word.

Texts then become class sequences of a byte a token; their bigrams are the transitions, and
their sums the scores.

Vocabulary, counts, bigrams and contexts cover all training texts. Words are told apart by
themselves in all counts; only step 3 knows them by a 64-bit hash, where two words of one
hash would share a class.

Defined cases: null and empty texts are the end token alone; a null id counts as an empty
one for the held-out rule; repeated ids and rows are ordinary rows; without training texts
every token is unseen; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import columns, materialize

CLASSES = 48
ROUNDS = 8
SHARE = 10_000
#: Weight, in tokens, of the classes' own frequencies in a transition.
PRIOR = 20.0
#: Text of one block, and tokens of a block handled at a time.
BLOCK_BYTES = 8 << 20
TOKENS_AT_ONCE = 1 << 18
#: Class sequences scored at a time.
ROWS_AT_ONCE = 512
#: The end token: no word has white space.
END = "\n"
_LOWER = bytes(range(256)).lower()


# ---------------------------------------------------------------- blocks of encoded texts

def held_out(id_column: Column) -> Column:
    """Texts that nothing is learned from: CRC-32 of the id as text is 2 mod 7."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 7 == 2


class _Places(dict):
    """Words numbered as they come, the end token first."""

    def __init__(self):
        super().__init__({END.encode(): 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _planes(codes: np.ndarray) -> bytes:
    """4-byte numbers byte by byte, the bytes of one weight together: compresses well."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _codes(planes: bytes) -> np.ndarray:
    """The numbers of ``_planes``."""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of texts: (block, ids, held, sizes, codes, words, counts). ``sizes`` are the texts'
    numbers of tokens, ``codes`` the places of all tokens in the block's ``words`` (the end token first),
    ``counts`` how often each word stands in texts that are not held out."""
    rows = columns(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")) if held is None else held, F.lit(False)).alias("held"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()),
                           T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType)),
                           T.StructField("held", T.ArrayType(T.BooleanType())),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType()),
                           T.StructField("words", T.ArrayType(T.StringType())),
                           T.StructField("counts", T.ArrayType(T.LongType()))])

    def block(number, ids, flags, parts, words):
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        codes = np.concatenate(parts)
        counts = np.bincount(codes[np.repeat(~np.array(flags), sizes)], minlength=len(words))
        whole = pa.concat_arrays(ids)
        one = pa.array([0, len(whole)], pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.ListArray.from_arrays(one, whole), pa.array([flags]), pa.array([sizes]),
            pa.array([_planes(codes)], pa.binary()), pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
            pa.array([counts], pa.list_(pa.int64()))], names=schema.names)

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        ids, flags, parts, words, size = [], [], [], _Places(), 0
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(2)[k].as_py()
                tokens = raw.translate(_LOWER).split()
                tokens.append(END.encode())
                parts.append(np.fromiter(map(words.__getitem__, tokens), dtype=np.uint32, count=len(tokens)))
                ids.append(batch.column(0).slice(k, 1))
                flags.append(batch.column(1)[k].as_py())
                size += len(raw)
                if size >= block_bytes:
                    yield block(number, ids, flags, parts, words)
                    ids, flags, parts, words, size, number = [], [], [], _Places(), 0, number + 1
        if parts:
            yield block(number, ids, flags, parts, words)

    return rows.mapInArrow(run, schema)


def block_words(encoded: DataFrame) -> DataFrame:
    """(block, code, word, n): the word lists of all blocks."""
    return (encoded.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "at"))
            .select("block", "code", F.col("at.words").alias("word"), F.col("at.counts").alias("n")))


def _training_tokens(held: list[bool], sizes: list[int], planes: bytes) -> np.ndarray:
    """The codes of a block's texts that are not held out, one after the other; each ends with the end
    token, which so stands before the next one (before the first one: the last one's)."""
    codes = _codes(planes)
    return codes[np.repeat(~np.array(held, dtype=bool), sizes)]


def frequent_pairs(encoded: DataFrame, ids: dict[str, int]) -> DataFrame:
    """(v, w, n): how often the word of id w follows that of id v in training texts; all words without
    an id have 0."""
    kinds = len(ids) + 1

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                held, sizes, planes, words = (batch.column(c)[k].as_py() for c in range(4))
                label = np.fromiter((ids.get(w, 0) for w in words), dtype=np.int64, count=len(words))
                tokens = _training_tokens(held, sizes, planes)
                keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for at in range(0, len(tokens), TOKENS_AT_ONCE):
                    here = label[tokens[at:at + TOKENS_AT_ONCE]]
                    before = np.concatenate([[label[tokens[at - 1]]], here[:-1]])  # at 0: the last one
                    key, count = np.unique(before * kinds + here, return_counts=True)
                    keys.append(key)
                    counts.append(count)
                key = np.concatenate(keys)
                yield pa.RecordBatch.from_arrays([pa.array(key // kinds), pa.array(key % kinds),
                                                  pa.array(np.concatenate(counts))], names=["v", "w", "n"])

    counted = encoded.select("held", "sizes", "codes", "words").mapInArrow(run, "v long, w long, n long")
    return counted.groupBy("v", "w").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- exchange

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Class bigram log likelihood, up to what no class changes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def gains(matrix: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """[word, class]: likelihood of the word in that class less that without the word.

    ``left`` and ``right`` count each word's neighbours by class, other than itself;
    ``itself`` counts its pairs with itself. The counts of ``matrix`` have every word in its class
    ``own``.
    """
    f, m, kinds = _xlogx, len(own), len(matrix)
    rows = np.arange(m)
    n = left.sum(1) + itself
    totals = matrix.sum(1)
    out = np.zeros((m, kinds))
    # Cells that only gain: (d, b) by left[d] and (b, d) by right[d], read from tables for small counts.
    for counts, cells in ((left, matrix), (right, matrix.T)):
        at, d = np.nonzero(counts)
        c = counts[at, d]
        base = f(cells)
        terms = np.empty((len(c), kinds))
        for value in np.unique(c[c <= 8]).tolist():
            pick = c == value
            terms[pick] = (f(cells + value) - base)[d[pick]]
        large = c > 8
        terms[large] = f(cells[d[large]] + c[large, None]) - base[d[large]]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        if len(starts):
            out[at[starts]] += np.add.reduceat(terms, starts, axis=0)
    # The corner (b, b) takes both, and the pairs with itself.
    corner = np.diagonal(matrix)[None, :]
    out += (f(corner + left + right + itself[:, None]) + f(corner)
            - f(corner + left) - f(corner + right))
    # Cells of the word's own class have lost the word's pairs before.
    own_row, own_col = matrix[own], matrix[:, own].T
    l_own, r_own = left[rows, own][:, None], right[rows, own][:, None]
    out += (f(own_row - right + l_own) - f(own_row - right)) - (f(own_row + l_own) - f(own_row))
    out += (f(own_col - left + r_own) - f(own_col - left)) - (f(own_col + r_own) - f(own_col))
    out -= 2 * (f(totals[None, :] + n[:, None]) - f(totals)[None, :])
    # Staying: what the word adds where it is.
    stay_col, stay_row = f(own_col) - f(own_col - left), f(own_row) - f(own_row - right)
    stay_col[rows, own] = stay_row[rows, own] = 0
    center = matrix[own, own]
    out[rows, own] = (stay_col.sum(1) + stay_row.sum(1) + f(center)
                      - f(center - left[rows, own] - right[rows, own] - itself)
                      - 2 * (f(totals[own]) - f(totals[own] - n)))
    return out


def _choose(words: np.ndarray, own: np.ndarray, cell: np.ndarray, n: np.ndarray, matrix: np.ndarray,
            targets: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, best classes) from sorted (word, own class, cell, count) rows; a cell is a class to the
    left, a class to the right, or the word itself. A tie keeps the own class, else the first."""
    kinds = len(matrix)
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    dense = np.bincount(which * (2 * kinds + 1) + cell, weights=n, minlength=len(first) * (2 * kinds + 1))
    dense = np.rint(dense).astype(np.int64).reshape(len(first), 2 * kinds + 1)
    own = own[first]
    gain = gains(matrix, own, dense[:, :kinds], dense[:, kinds:-1], dense[:, -1])
    if targets < kinds:
        gain = gain[:, :targets]
        return words[first], gain.argmax(1)
    best = gain.argmax(1)
    rows = np.arange(len(own))
    return words[first], np.where(gain[rows, best] > gain[rows, own] + 1e-9 * np.abs(gain[rows, own]), best, own)


#: Words whose gains are computed at a time.
WORDS_AT_ONCE = 2048


def choose_classes(contexts: DataFrame, matrix: np.ndarray, targets: int, kind: np.dtype) -> DataFrame:
    """(w, cls) from contexts (w, own, cells), where cells are (cell, count) pairs of a dtype and a word
    may have many rows."""

    def run(batches):
        held = (np.empty(0, np.int64),) * 4

        def emit(rows):
            words, best = _choose(*rows, matrix, targets)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(best.astype(np.int32))], names=["w", "cls"])

        for batch in batches:
            lengths = pc.binary_length(batch.column(2)).to_numpy() // kind.itemsize
            cells = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=kind)
            new = (np.repeat(batch.column(0).to_numpy(), lengths), np.repeat(batch.column(1).to_numpy(), lengths),
                   cells["cell"].astype(np.int64), cells["n"].astype(np.int64))
            held = tuple(np.concatenate(x) for x in zip(held, new))
            starts = np.flatnonzero(np.concatenate([[True], held[0][1:] != held[0][:-1]])) if len(held[0]) else held[0]
            for k in range(0, max(len(starts) - 1, 0), WORDS_AT_ONCE):  # the last word may go on in the next batch
                low, high = starts[k], starts[min(k + WORDS_AT_ONCE, len(starts) - 1)]
                yield emit(tuple(x[low:high] for x in held))
            if len(starts):
                held = tuple(x[starts[-1]:] for x in held)
        if len(held[0]):
            yield emit(held)

    return (contexts.repartition("w").sortWithinPartitions("w").select("w", "own", "cells")
            .mapInArrow(run, "w long, cls int"))


#: Cells and counts of one block, where words are rare, and of the whole corpus.
SMALL = np.dtype([("cell", "u1"), ("n", "u1")])
LARGE = np.dtype([("cell", "<u2"), ("n", "<i8")])


def _packed(owner: np.ndarray, cell: np.ndarray, n: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, pa.Array]:
    """Cells of each owner (sorted rows) as one binary; a count that the type cannot hold takes
    several pairs."""
    most = np.iinfo(kind["n"]).max
    times = np.maximum(-(-n // most), 1)
    at = np.repeat(np.arange(len(n)), times)
    last = np.cumsum(times) - 1
    data = np.empty(len(at), dtype=kind)
    data["cell"], data["n"] = cell[at], most
    data["n"][last] = n - (times - 1) * most
    owner = owner[at]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.empty(0, int)
    offsets = (np.append(first, len(owner)) * kind.itemsize).astype(np.int32)
    return owner[first], pa.Array.from_buffers(pa.binary(), len(first),
                                               [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def cluster_frequent(pairs: DataFrame, words: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the frequent words 1 .. ``words`` (index 0, all other words, has a class of its own) and
    the class bigram matrix, by exchange on their bigrams (v, w, n)."""
    spark, kinds = pairs.sparkSession, classes + 1
    now = np.concatenate([[classes], np.arange(words) % classes])
    best = None
    for turn in range(rounds + 1):
        of = F.broadcast(spark.createDataFrame(  # ``words`` rows, SHARE at most
            [(int(k), int(c)) for k, c in enumerate(now)], "id long, cls int"))
        both = (pairs.join(of.select(F.col("id").alias("v"), F.col("cls").alias("cv")), "v")
                .join(of.select(F.col("id").alias("w"), F.col("cls").alias("cw")), "w"))
        matrix = np.zeros((kinds, kinds), dtype=np.int64)
        for r in both.groupBy("cv", "cw").agg(F.sum("n").alias("n")).collect():  # kinds squared rows at most
            matrix[r.cv, r.cw] = r.n
        value = likelihood(matrix)
        if best is None or value > best[0]:
            best = (value, now, matrix)
        if turn == rounds or not words:
            break
        itself = F.col("v") == F.col("w")
        cells = both.select(F.explode(F.array(
            F.struct(F.col("w").alias("w"), F.col("cw").alias("own"),
                     F.when(itself, 2 * kinds).otherwise(F.col("cv")).alias("cell"), "n"),
            F.struct(F.col("v").alias("w"), F.col("cv").alias("own"),
                     F.when(~itself, F.col("cw") + kinds).alias("cell"), "n"))).alias("c")).select("c.*")
        moving = cells.where(F.col("cell").isNotNull() & (F.col("w") > 0) & (F.col("w") % 2 == turn % 2))
        summed = moving.groupBy("w", "own", "cell").agg(F.sum("n").alias("n"))

        def pack(batches):
            for batch in batches:
                w, own, cell, n = (batch.column(k).to_numpy() for k in range(4))
                row, packed = _packed(np.arange(len(w)), cell, n, LARGE)
                yield pa.RecordBatch.from_arrays([pa.array(w[row]), pa.array(own[row]), packed], names=["w", "own", "cells"])

        moved = choose_classes(summed.mapInArrow(pack, "w long, own int, cells binary"), matrix, classes, LARGE)
        after = now.copy()
        for r in moved.collect():  # half of the words, SHARE / 2 at most
            after[r.w] = r.cls
        now = after
    return best[1], best[2]


def rest_contexts(encoded: DataFrame, known: dict[str, int], classes: int) -> DataFrame:
    """(w, own, cells): contexts of all words but the ``known`` ones (word: class), block by block; w is a
    hash of the word, and its class that of the rest."""
    kinds = classes + 1

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                held, sizes, planes, words, names = (batch.column(c)[k].as_py() for c in range(5))
                label = np.fromiter((known.get(w, classes) for w in words), dtype=np.int64, count=len(words))
                tokens, keys = _training_tokens(held, sizes, planes), []
                for at in range(0, len(tokens), TOKENS_AT_ONCE):
                    here = tokens[at:at + TOKENS_AT_ONCE].astype(np.int64)
                    end = at + len(here)
                    before = np.append(tokens[at - 1], here[:-1]).astype(np.int64)
                    after = np.append(here[1:], tokens[end % len(tokens)]).astype(np.int64)
                    rest = label[here] == classes
                    to_left = np.where(before == here, 2 * kinds, label[before])
                    to_right = rest & (after != here)
                    keys += [here[rest] * (2 * kinds + 1) + to_left[rest],
                             here[to_right] * (2 * kinds + 1) + kinds + label[after[to_right]]]
                key, count = np.unique(np.concatenate(keys or [np.empty(0, np.int64)]), return_counts=True)
                codes, cells = _packed(key // (2 * kinds + 1), key % (2 * kinds + 1), count, SMALL)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(names, dtype=np.int64)[codes]),
                    pa.array(np.full(len(codes), classes, dtype=np.int32)), cells], names=["w", "own", "cells"])

    return (encoded.select("held", "sizes", "codes", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("names"))
            .mapInArrow(run, "w long, own int, cells binary"))


# ---------------------------------------------------------------- model

@dataclass
class Model:
    """``vocab`` (word, n, cls), each class's tokens, and the numbers of all tokens, words, and words
    seen once."""

    vocab: DataFrame
    totals: np.ndarray
    tokens: int
    words: int
    once: int

    def transitions(self, bigrams: np.ndarray) -> np.ndarray:
        """[class before, class] from class bigrams; the last class is that of unseen words."""
        unseen = (self.once + 1) / (self.tokens + self.words + 1)
        frequency = self.totals / max(self.tokens, 1)
        step = (bigrams + PRIOR * frequency) / (self.totals[:, None] + PRIOR)
        seen = (1 - unseen) * np.vstack([step, frequency])
        return np.hstack([seen, np.full((len(seen), 1), unseen)])


def fit(encoded: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, share: int = SHARE) -> Model:
    """Vocabulary and classes of the texts that are not held out."""
    if not 1 <= classes <= 126:
        raise ValueError("classes must be 1 to 126: a cell has one byte")
    vocab = materialize(block_words(encoded).groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "lm-vocabulary")
    total = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                      F.count_if(F.col("n") == 1).alias("once")).first()
    frequent = [r.word for r in vocab.where(F.col("n") * share >= total.n).orderBy(F.desc("n"), "word")
                .select("word").collect()]  # their shares sum to 1 at most, so ``share`` rows at most
    pairs = materialize(frequent_pairs(encoded, {w: k + 1 for k, w in enumerate(frequent)}), "lm-frequent-pairs")
    found, matrix = cluster_frequent(pairs, len(frequent), classes, rounds)
    known = {w: int(found[k + 1]) for k, w in enumerate(frequent)}
    rest = choose_classes(rest_contexts(encoded, known, classes), matrix, classes, SMALL)
    rest = materialize(rest.withColumnRenamed("cls", "rest_cls"), "lm-rest-classes")
    frequent_classes = F.broadcast(encoded.sparkSession.createDataFrame(list(known.items()), "word string, cls int"))
    classed = materialize(
        vocab.join(frequent_classes, "word", "left").withColumn("w", F.when(F.col("cls").isNull(), F.xxhash64("word")))
        .join(rest, "w", "left").select("word", "n", F.coalesce("cls", "rest_cls").alias("cls")), "lm-classes")
    totals = np.zeros(classes, dtype=np.int64)
    for r in classed.groupBy("cls").agg(F.sum("n").alias("n")).collect():
        totals[r.cls] = r.n
    return Model(classed, totals, int(total.n), int(total.v), int(total.once))


def class_sequences(encoded: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, emission, classes) per text: the sum of its words' log10
    emissions, and the class of every token as a byte."""
    totals, tokens_all, words_all, unseen = model.totals, model.tokens, model.words, len(model.totals)
    ids = encoded.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", ids), T.StructField("held_out", T.BooleanType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("emission", T.DoubleType()),
                           T.StructField("classes", T.BinaryType())])

    def run(text, found):
        sizes, codes = np.array(text["sizes"][0].as_py(), dtype=np.int64), _codes(text["codes"][0].as_py())
        places, width = found["code"].to_numpy(), int(codes.max()) + 1
        n, cls = np.zeros(width, dtype=np.int64), np.full(width, unseen, dtype=np.uint8)
        n[places], cls[places] = found["n"].to_numpy(), found["cls"].to_numpy()
        base = np.log10((n + 1) / (tokens_all + words_all + 1))
        emission = np.where(n > 0, np.log10(np.maximum(n, 1) / np.append(np.maximum(totals, 1), 1)[cls]), 0.0)
        starts = np.cumsum(sizes) - sizes
        sequence, ends = cls[codes], np.cumsum(sizes)
        return pa.table([
            text["ids"].combine_chunks().flatten(), text["held"].combine_chunks().flatten(), pa.array(sizes),
            pa.array(np.add.reduceat((n > 0)[codes].astype(np.int64), starts)),
            pa.array(np.add.reduceat(base[codes], starts)), pa.array(np.add.reduceat(emission[codes], starts)),
            pa.array([sequence[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
            names=schema.names)

    labels = (block_words(encoded).join(model.vocab.select("word", F.col("n").alias("seen"), "cls"), "word")
              .select(F.col("block").alias("of"), "code", F.col("seen").alias("n"), "cls"))
    texts = encoded.select("block", "ids", "held", "sizes", "codes")
    return texts.groupBy("block").cogroup(labels.groupBy("of")).applyInArrow(run, schema)


def _before(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before, class, start of each text) over texts, each led by its own last class, the end's."""
    sizes = np.array([len(s) for s in sequences], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    here = np.frombuffer(b"".join(sequences), dtype=np.uint8)
    before = np.empty(len(here), dtype=np.uint8)
    before[1:] = here[:-1]
    before[starts] = here[starts + sizes - 1]
    return before, here, starts


def class_bigrams(sequences: DataFrame, classes: int) -> np.ndarray:
    """[class before, class] over the texts that are not held out."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                before, here, _ = _before(batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist())
                key, n = np.unique(before.astype(np.int64) * classes + here, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    out = np.zeros(classes * classes, dtype=np.int64)
    counted = sequences.where("NOT held_out").select("classes").mapInArrow(run, "key long, n long")
    for r in counted.groupBy("key").agg(F.sum("n").alias("n")).collect():  # classes squared rows at most
        out[r.key] = r.n
    return out.reshape(classes, classes)


def score_sequences(sequences: DataFrame, model: Model, step: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    logs = np.log10(np.where(step > 0, step, 1.0)).astype(float)  # no word has a class of no words
    schema = T.StructType([*sequences.schema.fields[:5], T.StructField("transition", T.DoubleType()),
                           T.StructField("emission", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                before, here, starts = _before(part.column(6).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    *[part.column(k) for k in range(5)], pa.array(np.add.reduceat(logs[before, here], starts)),
                    part.column(5)], names=schema.names)

    return sequences.mapInArrow(run, schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("transition") + F.col("emission")).alias("score"))


def score(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          classes: int = CLASSES, rounds: int = ROUNDS, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all texts by the model of those that are not ``held`` out (default: ``held_out`` of the id)."""
    encoded = materialize(encode(docs, held, id_col, text_col, block_bytes), "lm-texts")
    model = fit(encoded, classes, rounds, share)
    sequences = materialize(class_sequences(encoded, model), "lm-sequences")
    return score_sequences(sequences, model, model.transitions(class_bigrams(sequences, classes)))
