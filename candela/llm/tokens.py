"""Whole-text encoding with a public tokenizer, a chunk of documents at a time.

The library merges each piece of a text on its own, so a chunk is cut where
its pre-tokenizer always cuts, and only pieces that a worker has not met
lately go to the library; ids are then laid out by array gathers. Texts whose
white space makes a cut unsafe, and texts that hold the string of an added
token (``<|endoftext|>``), go to the library whole.

Cuts: before a space that is followed by no white space; between an ASCII
letter and another ASCII character that is not a letter; after a line feed
that stands alone.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from candela.llm.store import give_back
from candela.llm.text import _VALUE, _pow, mix

CHUNK_BYTES = 1 << 20
#: pieces that a task keeps, in two generations
CACHE_PIECES = 120_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_ASCII_OTHER = np.zeros(256, bool)
_ASCII_OTHER[:128] = ~_LETTER[:128]
_ASCII_OTHER[32] = False
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13, 28, 29, 30, 31]] = True
_UNSAFE = re.compile(r" \s")
#: first bytes of the white space characters beyond ASCII
_WIDE_SPACE = np.zeros(256, bool)
_WIDE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: the same as a translation of Latin-1 decoded bytes
_ALPHABET = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
_LINE = _byte_letters()[10]


def _laid_out(ids: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` one after another."""
    upto = np.cumsum(sizes)
    return ids[np.repeat(begin - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)]


class _Kept:
    """Pieces by their hashes, ascending, with the places of their ids."""

    def __init__(self, hashes: np.ndarray, begin: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        self.hashes, self.begin, self.sizes, self.ids = hashes, begin, sizes, ids

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where every hash would stand, and whether it does."""
        at = np.searchsorted(self.hashes, wanted)
        met = at < len(self.hashes)
        met[met] = self.hashes[at[met]] == wanted[met]
        return at, met

    def plus(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> _Kept:
        begin = len(self.ids) + np.cumsum(sizes) - sizes
        by = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[by])
        return _Kept(np.insert(self.hashes, at, hashes[by]), np.insert(self.begin, at, begin[by]),
                     np.insert(self.sizes, at, sizes[by]), np.append(self.ids, ids))


_NONE = _Kept(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))


class Encoder:
    """Token ids of texts by the tokenizer file ``path``, as the library gives
    them: the strings of its added tokens are those tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        #: an added token's string; in any case where the library looks for it in normalized text
        self.added = re.compile(b"|".join(
            (b"(?i:%s)" if x["normalized"] else b"%s") % re.escape(x["content"].encode()) for x in added) or rb"(?!)")
        normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        #: whether a word of letters is one piece for the merges, and how it gets there
        self.folds = [x["type"] for x in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.direct = self.folds or not normal and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
        self.young = self.old = _NONE
        del spec
        give_back()  # what reading the file took, several times its size

    def _merged(self, texts: list[str]) -> list[bytes | None]:
        """ids of words of letters, straight from the library's merges; None
        for what has to take the whole way. Words are folded in one go, between
        line feeds."""
        out: list[bytes | None] = [None] * len(texts)
        if not self.direct:
            return out
        stems = [t[1:] if t[0] == " " else t for t in texts]
        at = [i for i, w in enumerate(stems) if w.isalpha()]
        if self.folds:
            joined = "\n".join([stems[i] for i in at])
            plain = joined.isascii()
            if not plain:
                # the lower case of a capital sigma depends on what follows
                at = [i for i in at if "\u03a3" not in stems[i]]
                joined = unicodedata.normalize("NFC", "\n".join([stems[i] for i in at]))
            words = joined.lower().split("\n") if at else []
            if not plain:  # there may be letters whose lower case has a mark of its own
                both = [(i, w) for i, w in zip(at, words, strict=True) if w.isalpha()]
                at, words = [i for i, _ in both], [w for _, w in both]
        else:
            words = [texts[i] for i in at]
        if not at:
            return out
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], []
        for word in "\n".join(words).encode().decode("latin-1").translate(_ALPHABET).split(_LINE):
            ids += [t.id for t in tokenize(word)]
            ends.append(4 * len(ids))
        raw, lo = np.array(ids, "<u4").tobytes(), 0
        for i, hi in zip(at, ends, strict=True):
            out[i] = raw[lo:hi]
            lo = hi
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids (uint32) of the chunk's documents one after another, and the
        offset of each document's first id, with one more at the end."""
        n = len(buf)
        if n == 0:
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        space = buf == 32
        letter, white = _LETTER[buf], _SPACE[buf]
        cut = space.copy()
        cut[1:] |= letter[:-1] & _ASCII_OTHER[buf[1:]]
        line = buf == 10
        if n > 2:
            lone = line[1:-1] & ~white[:-2] & ~white[2:] & ~_WIDE_SPACE[buf[2:]] & ~_WIDE_SPACE[buf[:-2]]
            # a space character beyond ASCII may end just before the line feed
            lone &= (buf[:-2] < 128) & (buf[2:] < 128)
            cut[2:] |= lone
        cut[offsets[offsets < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        power, inverse = _pow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.multiply(_VALUE[buf], power[:n], out=sums[1:])
        np.cumsum(sums, out=sums)
        h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        # any of equal pieces stands for all, so the sort need not be stable
        order = np.argsort(h)
        h = h[order]
        new = np.append(True, h[1:] != h[:-1])
        index = np.empty(len(h), np.int64)
        index[order] = np.cumsum(new) - 1
        at, sizes, pool = self._pieces(h[new], order[new], buf, starts, ends)
        upto = np.cumsum(sizes[index])
        ids = _laid_out(pool, at[index], sizes[index])
        first = np.append(0, upto)[np.searchsorted(starts, offsets)]
        return self._whole(ids, first, buf, offsets, space, white)

    def _pieces(self, known, where, buf, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and number of the ids of every piece in an array of ids, and
        that array."""
        at, met = self.young.find(known)
        rest = np.flatnonzero(~met)
        if len(rest):
            there, met = self.old.find(known[rest])
            again, fresh = rest[met], rest[~met]
            held, sizes = self.old.begin[there[met]], self.old.sizes[there[met]]
            new = self._fresh(where[fresh], buf, starts, ends)
            self.young = self.young.plus(
                known[np.concatenate([again, fresh])], np.append(sizes, np.fromiter(map(len, new), np.int64, len(new)) // 4),
                np.append(_laid_out(self.old.ids, held, sizes), np.frombuffer(b"".join(new), "<u4")))
            at, _ = self.young.find(known)
        young = self.young
        if len(young) > CACHE_PIECES:
            self.old, self.young = young, _NONE
        return young.begin[at], young.sizes[at], young.ids

    def _fresh(self, where, buf, starts, ends) -> list[bytes]:
        """ids of pieces that are not kept."""
        raw = buf.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        out = self._merged(texts)
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._ids([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _whole(self, ids, first, buf, offsets, space, white):
        """Replace the ids of documents where a space meets white space, or
        that hold an added token's string."""
        n = len(buf)
        hit = np.flatnonzero(space[:-1] & (white[1:] | _WIDE_SPACE[buf[1:]])) if n > 1 else np.zeros(0, np.int64)
        held = np.array([m.start() for m in self.added.finditer(buf.tobytes())], np.int64)
        if not len(hit) and not len(held):
            return ids, first
        named = set((np.searchsorted(offsets, held, side="right") - 1).tolist())
        docs = np.unique(np.searchsorted(offsets, np.append(hit, held), side="right") - 1)
        parts, lens, last = [], np.diff(first), 0
        for d in docs.tolist():
            text = buf[offsets[d]:offsets[d + 1]].tobytes().decode()
            if d not in named and not _UNSAFE.search(text):
                continue
            whole = np.frombuffer(self._ids([text])[0], "<u4")
            parts += [ids[last:first[d]], whole]
            last = first[d + 1]
            lens[d] = len(whole)
        return np.concatenate([*parts, ids[last:]]), np.append(0, np.cumsum(lens))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a task and file."""
    return Encoder(path)


def drop_encoders() -> None:
    encoder.cache_clear()
