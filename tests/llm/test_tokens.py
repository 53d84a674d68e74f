"""Token files, token spans and the encoder against the tokenizers library itself."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trisk.llm import bpe, token_files, token_spans
from trisk.llm.store import work_path

LIBRARY = bpe.Encoder(bpe.default_vocab()).tokenizer


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Zé,.!\n\t'sl1 日́-<|>") | st.characters(codec="utf-8"), max_size=60),
                max_size=5))
def test_encoder_equals_the_library(texts):
    enc = bpe.encoder(bpe.default_vocab())
    flat, lengths = enc.encode(texts)
    ends = np.cumsum(lengths)
    assert [flat[e - n:e].tolist() for e, n in zip(ends, lengths)] == [ids_of(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(st.sampled_from("abZ\u00e9\u00c0\u00f7\u00d7\u00aa\u00ba,.'s1\u65e5\u0301"), min_size=1, max_size=6),
                         min_size=1, max_size=12), min_size=1, max_size=4), st.sampled_from([1, 7, 1 << 12]))
def test_cut_words_equal_the_library(texts, joined):
    enc, before = bpe.encoder(bpe.default_vocab()), bpe.JOINED_BYTES
    bpe.JOINED_BYTES = joined
    try:
        texts = ["".join(w + " \n"[len(w) % 2] for w in t)[:-1] for t in texts]
        enc._reset()
        enc.word_ids = {}
        flat, lengths = enc.encode(texts)
    finally:
        bpe.JOINED_BYTES = before
    ends = np.cumsum(lengths)
    assert [flat[e - n:e].tolist() for e, n in zip(ends, lengths)] == [ids_of(t) for t in texts]


def test_encoder_tables_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 2)
    monkeypatch.setattr(bpe, "MAX_WORDS", 2)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 9)  # texts are handled in several parts
    enc = bpe.Encoder(bpe.default_vocab())
    for text in ("one two three, four.\nOne two", "two five six", "one <|endoftext|> two", "", "averyverylongword x"):
        assert enc.encode([text])[0].tolist() == ids_of(text)


def test_plain_pieces_are_cut_out_together(monkeypatch):
    """A space and ASCII letters, with or without a comma or full stop, are not looked at one by one."""
    enc, alone = bpe.Encoder(bpe.default_vocab()), []
    one_by_one = enc._encode_new
    monkeypatch.setattr(enc, "_encode_new", lambda pieces: alone.extend(pieces) or one_by_one(pieces))
    text = "first plain words, and more. a , b. caf\u00e9 it's x1 y.. z,. Q"
    assert enc.encode([text])[0].tolist() == ids_of(text)
    assert set(alone) == {"\nfirst", " ,", " caf\u00e9", " it's", " x1", " y..", " z,."}


def test_older_words_go_first(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 10)
    enc = bpe.Encoder(bpe.default_vocab())
    words = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
    for k, word in enumerate(words):
        enc.encode(["x " + word])
        assert all("\u0120" + w in enc.word_ids for w in words[max(0, k - 1):k + 1])
        assert len(enc.word_ids) <= 16
    assert "\u0120one" not in enc.word_ids
    for text in ("x one, seven. two", "x six five, eight"):
        assert enc.encode([text])[0].tolist() == ids_of(text)


def test_new_words_share_a_call(monkeypatch):
    """New pieces are encoded many at a time, and a stop after a letter does not make another piece."""
    enc = bpe.Encoder(bpe.default_vocab())
    whole, model, calls = enc.tokenizer, enc.model, []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **named):
            calls.extend(texts)
            return self.inner.encode_batch_fast(texts, **named)

    enc.tokenizer, enc.model = Counted(whole), Counted(model)
    text = "x " + " ".join(f"{a}ou{b} {a}ou{b}, {a}\u00e9{b}." for a in "bcdfghjk" for b in "lmnpqrst") + "\ny1 z2, 7."
    before = len(enc.hashes)
    assert enc.encode([text])[0].tolist() == ids_of(text)
    assert len(calls) <= 3
    assert len(enc.hashes) - before == 1 + 64 + 64 + 3


def test_long_lists_of_new_pieces_are_cut(monkeypatch):
    monkeypatch.setattr(bpe, "JOINED_BYTES", 5)
    enc = bpe.Encoder(bpe.default_vocab())
    text = "a bc def, ghij \u00e9\u00f7\u00d7 \u00c0klmno. \u00fcber 12, x\u00d7. \u00aa, \u00ba. it's, 't. p\nq"
    assert enc.encode([text])[0].tolist() == ids_of(text)


def test_pieces_met_again_stay(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 8)
    enc = bpe.Encoder(bpe.default_vocab())
    for text in ("x one two three", "x one four five six", "x one seven"):
        assert enc.encode([text])[0].tolist() == ids_of(text)
    new = enc._encode_spans
    monkeypatch.setattr(enc, "_encode_spans", lambda buffer, starts, ends: learned.extend(
        buffer[a:b] for a, b in zip(starts, ends)) or new(buffer, starts, ends))
    learned = []
    assert enc.encode(["x one two"])[0].tolist() == ids_of("x one two")
    assert learned == [b" two"]


def test_a_model_that_joins_words_is_not_used_alone(tmp_path):
    """Where a merge could join the end of a word and the next one's space, the whole tokenizer cuts all words."""
    import json
    spec = json.loads(LIBRARY.to_str())
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    vocab["q\u0120"] = max(vocab.values()) + 2
    merges.insert(0, ["q", "\u0120"])
    path = tmp_path / "joins.json"
    path.write_text(json.dumps(spec))
    enc = bpe.Encoder(str(path))
    assert bpe.Encoder(bpe.default_vocab()).model is not None and enc.model is None
    text = "aq bq cq, q dq"
    assert enc.encode([text])[0].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids == ids_of(text)


def expected_files(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, [*ids_of(t), 0]) for i, t in order]


def digests(found):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found)


def test_files_round_trip(spark, awkward):
    path = work_path(spark, "test-tokens")
    found = token_files.token_files(awkward, path).collect()
    want = expected_files([(r.doc_id, r.text) for r in awkward.collect()])
    assert digests(found) == sorted((i is not None, i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                                    for i, x in want)
    # Starts tile the whole line of ids in ascending id order.
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start[:-1]]).tolist()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in by_start]
    assert keys == sorted(keys)
    assert sorted(len(r.ids) for r in token_files.lookup(spark, path, [5, 7]).collect()) == sorted(
        len(x) for i, x in want if i in (5, 7))


def test_files_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    found = {r.doc_id: r for r in token_files.token_files(docs, work_path(spark, "test-tokens")).collect()}
    start = 0
    for i, ids in expected_files([(r.doc_id, r.text) for r in docs.collect()]):
        assert (found[i].start, found[i].n_tokens) == (start, len(ids))
        assert found[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files_of_nothing(spark, empty):
    assert token_files.token_files(empty, work_path(spark, "test-tokens")).collect() == []


def spans_brute(text):
    """Per line (tokens, crossing) by walking the tokens of the library byte by byte."""
    raw = (text or "").encode()
    line_of = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint8) == 10)])
    lines = raw.count(b"\n") + 1
    tokens, crossing, at = [0] * lines, [0] * lines, 0
    sizes = bpe.encoder(bpe.default_vocab()).byte_lengths()
    for i in ids_of(text):
        piece = raw[at:at + sizes[i]]
        body = piece.lstrip(b" \n\t\r\x0b\x0c")
        home = line_of[at + (len(piece) - len(body) if body else 0)]
        tokens[home] += 1
        crossing[home] += line_of[at] != line_of[at + len(piece) - 1]
        at += len(piece)
    assert at == len(raw)
    return list(zip(tokens, crossing))


@pytest.mark.parametrize("table", ["awkward", "documents"])
def test_line_counts(spark, awkward, table):
    docs = awkward if table == "awkward" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.section, r.n_tokens, r.n_crossing)
                 for r in token_spans.line_token_counts(docs).collect())
    want = sorted((r.doc_id is not None, r.doc_id or 0, k, n, c) for r in docs.select("doc_id", "text").collect()
                  for k, (n, c) in enumerate(spans_brute(r.text)))
    assert got == want


def test_line_counts_of_nothing(empty, nothing_but_nulls):
    assert token_spans.line_token_counts(empty).collect() == []
    assert [tuple(r) for r in token_spans.line_token_counts(nothing_but_nulls).collect()] == [(None, 0, 0, 0, 0, 0)] * 3


def test_field_counts_sum_to_the_whole(spark):
    rows = spark.createDataFrame([(1, "A title", "and a body\n\ntext"), (2, None, "x"), (3, "", "")],
                                 "id long, title string, body string")
    got = {(r.doc_id, r.field): r.n_tokens for r in token_spans.field_token_counts(rows, "id", ["title", "body"]).collect()}
    for i, t, b in ((1, "A title", "and a body\n\ntext"), (2, "", "x"), (3, "", "")):
        assert got[i, "title"] + got[i, "body"] == len(ids_of(f"{t}\n{b}"))


def test_only_odd_texts_are_looked_at_one_by_one(monkeypatch):
    """Texts without adjacent white space, other white space or a special token's first byte are cut unseen."""
    enc, seen = bpe.Encoder(bpe.default_vocab()), []
    plain = enc._whole
    monkeypatch.setattr(enc, "_whole", lambda text: seen.append(text) or plain(text))
    odd = ["", " a", "a ", "a\n", "\na", "a  b", "a\n\nb", "a \nb", "a\n b", "a\tb", "a\x1cb", "a\x85b", "a\xa0b",
           "a b", "a b", "a b", "a　b", "<|endoftext|>", "x <|endoftext|> y"]
    texts = [t for k, o in enumerate(odd) for t in (f"plain text, {k}.", o, "caf\xe9 au\nlait")]
    flat, lengths = enc.encode(texts)
    ends = np.cumsum(lengths)
    assert [flat[e - n:e].tolist() for e, n in zip(ends, lengths)] == [ids_of(t) for t in texts]
    assert seen == odd
