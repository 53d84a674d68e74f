"""Whole-text byte-level BPE by the tokenizers library, each distinct piece encoded once.

The byte-level pre-tokenizer always starts a new piece at a single space between two
non-space characters, and a single newline between two non-space characters is a piece
of its own before a fresh start. A text without adjacent white space is therefore cut
there, and so is a comma or full stop after a letter, which is a piece of its own; every
distinct piece is encoded by the library, many in one call, and
the ids are laid out with numpy: pieces are found by a 64-bit hash, checked by their
length and first eight bytes. A text with adjacent white space, at an end, or with a special
token's text in it goes to the library whole. Both ways give the library's ids for the
whole text.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np

from trisk.llm.store import held

#: Distinct pieces, and distinct pre-tokens, kept by one Python worker before the pieces met once
#: and the older pre-tokens are dropped, and bytes handled at a time; memory bounds only, ids do not depend on them.
MAX_PIECES = 250_000
MAX_WORDS = 150_000
CHUNK_BYTES = 5 << 17
#: Bytes of new pieces that one call of the library encodes, as they are written one after the other.
JOINED_BYTES = 1 << 12
#: Characters of the texts whose pieces are laid out at a time (one text at least).
GROUP_CHARS = 1 << 19
#: Byte to sign of a byte-level vocabulary: printable Latin-1 bytes stand for themselves, the
#: others, in order, for the characters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(b) for b in _PRINTABLE}
_BYTE_SIGNS |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _BYTE_SIGNS)}
_SPACE, _NEWLINE = _BYTE_SIGNS[32], _BYTE_SIGNS[10]
_LETTERS = np.zeros(256, dtype=np.int32)
_LETTERS[[*range(65, 91), *range(97, 123)]] = 1
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0  -     　]")

_ODD = np.random.default_rng(2).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def letter_bytes(raw: np.ndarray) -> np.ndarray:
    """1 for every byte of an ASCII or Latin-1 letter (two bytes from U+00C0 on), else 0."""
    out = _LETTERS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    out[lead] = out[lead + 1] = 1
    return out


def piece_starts(raw: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start, each text after a newline: at every space and newline, and at a comma or
    full stop between a letter (ASCII or Latin-1) and white space or the end, which is a pre-token of its own."""
    space = (raw == 32) | (raw == 10)
    stops = np.flatnonzero(((raw == 44) | (raw == 46)) & np.append(space[1:], True))
    space[stops[letter_bytes(raw)[stops - 1] > 0]] = True
    return np.flatnonzero(space)


class Encoder:
    """Encodes lists of texts into one flat id array and a length per text."""

    def __init__(self, vocab_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocab_path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd_bytes = np.zeros(256, dtype=bool)
        self.odd_bytes[[9, *range(11, 14), *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3,
                        *(s.encode()[0] for s in self.specials)]] = True
        self.token_bytes = self.byte_lengths()
        self.model = Tokenizer(self.tokenizer.model) if self._merge_inside() else None
        self.word_ids: dict[str, bytes] = {}  # ids as int32 bytes, a third of a tuple's memory
        self._reset()

    def _reset(self) -> None:
        # Hashes of known pieces, ascending, with their place in the arrays after them: check value, whether
        # met again since it was learned, and the bounds of their ids.
        self.hashes = np.empty(0, dtype=np.uint64)
        self.places = np.empty(0, dtype=np.int64)
        self.checks = np.empty(0, dtype=np.uint64)
        self.again = np.empty(0, dtype=bool)
        self.bounds = np.zeros(1, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.int32)
        for stop in (b",", b"."):  # the pieces that do not begin with white space
            self._lookup(stop, np.array([0]), np.array([1]))

    def _drop_once_met(self) -> None:
        """Where there are too many pieces, those not met again go; all do where that leaves over half of them."""
        if len(self.hashes) <= MAX_PIECES:
            return
        self.again[:2] = True  # the stops
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > MAX_PIECES:
            self._reset()
            return
        counts = np.diff(self.bounds)[kept]
        self.flat = self._ids_of(kept, counts)
        self.bounds = np.concatenate([[0], np.cumsum(counts)])
        left = self.again[self.places]
        self.hashes, self.places = self.hashes[left], (np.cumsum(self.again) - 1)[self.places[left]]
        self.checks, self.again = self.checks[kept], np.zeros(len(kept), dtype=bool)

    def _ids_of(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of known pieces, one after the other; ``counts`` has the number of each."""
        upto = np.cumsum(counts)
        return self.flat[np.arange(upto[-1] if len(upto) else 0) + np.repeat(self.bounds[places] - (upto - counts), counts)]

    def _whole(self, text: str) -> bool:
        """Whether the text must be encoded in one call."""
        return (not text or text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text
                or " \n" in text or "\n " in text or _OTHER_SPACE.search(text) is not None
                or any(s in text for s in self.specials))

    def _drop_old_words(self) -> None:
        """Where the room for pre-tokens is full, the half that was learned first goes."""
        if len(self.word_ids) >= MAX_WORDS:
            self.word_ids = dict(itertools.islice(self.word_ids.items(), len(self.word_ids) // 2, None))

    def _merge_inside(self) -> bool:
        """Whether the model alone, given words of ASCII or Latin-1 letters one after the other, each with a space or
        newline before it, never joins bytes of two words: plain merges, and no token of such bytes that could."""
        model = self.tokenizer.model
        if type(model).__name__ != "BPE" or model.ignore_merges or model.dropout or (
                model.continuing_subword_prefix or model.end_of_word_suffix):
            return False
        letters = "".join(_BYTE_SIGNS[b] for b in (*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)))
        across = re.compile(f"[{letters}][{_SPACE}{_NEWLINE}]|{_NEWLINE}[{letters}]")
        made = re.compile(f"[{letters}{_SPACE}{_NEWLINE}]+")  # what the model can make of such words
        return not any(across.search(t) and made.fullmatch(t)
                       for t in self.tokenizer.get_vocab(with_added_tokens=False))

    def _encode_joined(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces written one after the other, each with its leading space or newline, and how many each has.
        Words of letters need no pre-tokenizer, so the library's model has them alone; the whole tokenizer cuts and
        encodes the others. Either gets ``JOINED_BYTES`` at a time."""
        starts = np.append(0, np.flatnonzero((raw[1:] == 32) | (raw[1:] == 10)) + 1)
        sizes = np.diff(np.append(starts, len(raw)))
        counts = np.zeros(len(starts), dtype=np.int64)
        lettered = np.zeros(len(starts), dtype=bool)
        if self.model is not None:
            lettered = (np.add.reduceat(letter_bytes(raw), starts, dtype=np.int64) == sizes - 1) & (sizes > 1)
        ids, kinds = [], ((lettered, self.model), (~lettered, self.tokenizer))
        for kind, encode_with in kinds:
            own = np.flatnonzero(kind)
            if not len(own):
                ids.append(np.empty(0, dtype=np.int32))
                continue
            part, ends = raw[np.repeat(kind, sizes)], np.cumsum(sizes[own])
            cuts = np.unique(np.append(np.searchsorted(ends, np.arange(JOINED_BYTES, ends[-1], JOINED_BYTES)) + 1, len(own)))
            upto = [0, *ends[cuts - 1].tolist()]
            texts = [part[x:y].tobytes().decode() for x, y in zip(upto, upto[1:])]
            if encode_with is self.model:
                texts = [t.encode().decode("latin-1").translate(_BYTE_SIGNS) for t in texts]
            found = encode_with.encode_batch_fast(texts, add_special_tokens=False)
            ids.append(np.concatenate([np.array(f.ids, dtype=np.int32) for f in found]))
            to = np.cumsum(self.token_bytes[ids[-1]])
            at = np.searchsorted(to, ends)
            if (to[at] != ends).any():
                raise ArithmeticError("a token of two pieces")
            counts[own] = np.diff(at, prepend=-1)
        out, of_words = np.empty(counts.sum(), dtype=np.int32), np.repeat(lettered, counts)
        out[of_words], out[~of_words] = ids
        return out, counts

    def _learn(self, words: list[str]) -> None:
        """Encode the words that are not known yet: each a space and letters, or a stop alone."""
        known = self.word_ids
        missing = [w for w in words if w not in known]
        if missing:
            ids, counts = self._encode_joined(np.frombuffer("".join(missing).replace(_SPACE, " ").encode(), dtype=np.uint8))
            raw, ends = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
            known.update(zip(missing, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def _encode_spans(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces [start, end) of a buffer and how many each has. A space and ASCII letters are told by
        sums over the bytes and kept as pre-tokens, and so is a stop; all others are written one after the other
        and encoded anew."""
        self._drop_old_words()
        raw = np.frombuffer(buffer, dtype=np.uint8)
        letters = np.concatenate([np.zeros(1, np.int32), np.cumsum(_LETTERS[raw], dtype=np.int32)])
        plain = (raw[starts] == 32) & (ends > starts + 1) & (letters[ends] - letters[starts] == ends - starts - 1)
        plain |= (raw[starts] == 44) | (raw[starts] == 46)
        own, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        shown = buffer.decode("latin-1").replace(" ", _SPACE)
        words = [shown[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist())]
        self._learn(words)
        ids = [self.word_ids[w] for w in words]
        counts = np.empty(len(starts), dtype=np.int64)
        counts[own] = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype=np.int32)
        if not len(other):
            return flat, counts
        more, counts[other] = self._encode_new(
            [buffer[x:y].decode() for x, y in zip(starts[other].tolist(), ends[other].tolist())])
        out, of_own = np.empty(len(flat) + len(more), dtype=np.int32), np.repeat(plain, counts)
        out[of_own], out[~of_own] = flat, more
        return out, counts

    def _encode_new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, each with its leading space or newline, and how many each has."""
        return self._encode_joined(np.frombuffer("".join(pieces).encode(), dtype=np.uint8))

    def _lookup(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places in the tables of the pieces [start, end) of a buffer, learning new ones."""
        raw = np.frombuffer(buffer, dtype=np.uint8)
        n = len(raw)
        room = max(n, CHUNK_BYTES)
        sums = np.concatenate([np.zeros(1, np.uint64),
                               np.cumsum(_ODD[raw] * _powers(_BASE, room)[:n], dtype=np.uint64)])
        sizes = (ends - starts).astype(np.uint64)
        h = (sums[ends] - sums[starts]) * _powers(pow(_BASE, -1, 1 << 64), room)[starts]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + sizes
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        head = np.ndarray((n + 1,), dtype=">u8", buffer=padded, strides=(1,))[starts].astype(np.uint64)
        head >>= (np.uint64(64) - np.minimum(sizes, np.uint64(8)) * np.uint64(8))
        check = head * np.uint64(_BASE) + sizes
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        which, own = which.reshape(-1), check[first]
        at = np.searchsorted(self.hashes, distinct)
        held = at < len(self.hashes)
        held[held] = self.hashes[at[held]] == distinct[held]
        found = self.places[at[held]]
        if (own[which] != check).any() or (self.checks[found] != own[held]).any():
            raise ArithmeticError("two pieces of one hash")
        self.again[found] = True
        places = np.empty(len(distinct), dtype=np.int64)
        places[held] = found
        new = np.flatnonzero(~held)
        if len(new):
            ids, counts = self._encode_spans(buffer, starts[first[new]], ends[first[new]])
            places[new] = len(self.checks) + np.arange(len(new))
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.places = np.insert(self.places, at[new], places[new])
            self.checks = np.concatenate([self.checks, own[new]])
            self.again = np.concatenate([self.again, np.zeros(len(new), dtype=bool)])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])
            self.flat = np.concatenate([self.flat, ids])
        return places[which]

    def _encode_cut(self, encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of texts, each after a newline, that may be cut at their white space."""
        buffer = b"".join(encoded)
        starts = piece_starts(np.frombuffer(buffer, dtype=np.uint8))
        ends = np.append(starts[1:], len(buffer))
        doc_at = np.cumsum([0, *map(len, encoded)])
        parts, sizes, k = [], [], 0
        while k < len(starts):
            to = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK_BYTES, side="right")))
            low = int(starts[k])
            self._drop_once_met()
            at = self._lookup(buffer[low:int(ends[to - 1])], starts[k:to] - low, ends[k:to] - low)
            n = self.bounds[at + 1] - self.bounds[at]
            parts.append(self._ids_of(at, n))
            sizes.append(n)
            k = to
        flat, upto = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        bounds = upto[np.searchsorted(starts, doc_at)]
        # The newline put before every text is its first id; it goes.
        return np.delete(flat, bounds[:-1]), np.diff(bounds) - 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids int32, ids per text int64), a group of texts at a time."""
        flat, lengths, at = [np.empty(0, np.int32)], [np.empty(0, np.int64)], 0
        while at < len(texts):
            to, chars = at + 1, len(texts[at])
            while to < len(texts) and chars + len(texts[to]) <= GROUP_CHARS:
                chars += len(texts[to])
                to += 1
            ids, n = self._encode_group(texts[at:to])
            flat.append(ids)
            lengths.append(n)
            at = to
        return np.concatenate(flat), np.concatenate(lengths)

    def _encode_group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [("\n" + t).encode() for t in texts]
        # Only these may have to be encoded whole: with adjacent white space (the newlines put before them and at the
        # end count), or a byte that other white space or a special token begins with.
        raw = np.frombuffer(b"".join([*encoded, b"\n"]), dtype=np.uint8)
        space = (raw == 32) | (raw == 10)
        odd = self.odd_bytes[raw[:-1]] | (space[1:] & space[:-1])
        at = np.cumsum(list(map(len, encoded)))
        maybe = np.unique(np.searchsorted(at, np.flatnonzero(odd), side="right")).tolist()
        whole = {i: np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, dtype=np.int32)
                 for i in maybe if self._whole(texts[i])}
        cut = [r for i, r in enumerate(encoded) if i not in whole]
        flat, lengths = self._encode_cut(cut) if cut else (np.empty(0, np.int32), np.empty(0, np.int64))
        if not whole:
            return flat, lengths
        pieces, at, each = [], 0, iter(lengths.tolist())
        for i in range(len(texts)):
            n = 0 if i in whole else next(each)
            pieces.append(whole[i] if i in whole else flat[at:at + n])
            at += n
        return np.concatenate(pieces), np.array([len(p) for p in pieces], dtype=np.int64)

    def byte_lengths(self) -> np.ndarray:
        """UTF-8 bytes of each id's token (a byte-level vocabulary writes one character a byte)."""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            out[i] = len(token.encode()) if token in self.specials else len(token)
        return out

    def leading_space(self) -> np.ndarray:
        """White-space bytes each token begins with; 0 where it is nothing else."""
        space = {_BYTE_SIGNS[b] for b in b" \n\t\r\x0b\x0c"}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            n = next((k for k, c in enumerate(token) if c not in space), len(token))
            out[i] = n if n < len(token) else 0
        return out


def encoder(vocab_path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    return held(vocab_path, lambda: Encoder(vocab_path))


def default_vocab() -> str:
    """Path of the public 50k byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
