import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candela.llm import text, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PATTERNS = [(text.NOT_SPACE, re.compile(r"[^\x20\x09-\x0D]+")),
            (text.ALNUM, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT = st.text(alphabet=st.sampled_from("aAbzÉéß \t\n.,'\"09-_  中😀Σς́"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_are_those_of_the_patterns(texts):
    for kind, pattern in PATTERNS:
        for lo, _, buf, offs in text.chunks(pa.array(texts, pa.string()), 64):
            w = text.words(buf, offs, kind)
            hashes = {}
            for d in range(len(offs) - 1):
                expected = pattern.findall((texts[lo + d] or "").translate(LOWER))
                span = range(w.first[d], w.first[d + 1])
                got = [bytes(text.LOWER[buf[w.starts[i]:w.ends[i]]]).decode() for i in span]
                assert got == expected
                for i, x in zip(span, got, strict=True):
                    assert hashes.setdefault(x, w.hashes[i]) == w.hashes[i]
            assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
@pytest.mark.parametrize("file", FILES)
def test_ids_are_the_library_s(file, texts):
    enc = tokens.encoder(public_tokenizers.path(file))
    expected = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from the kept pieces
        got = []
        for _, _, buf, offs in text.chunks(pa.array(texts), 50):
            ids, first = enc.encode(buf, offs)
            got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == expected


@pytest.mark.parametrize("file", FILES)
def test_ids_of_awkward_texts(file):
    texts = ["", " ", "a  b", "a \n b", "x\n\ny", "trail ", " lead", "don't isn's I'll 12ab34", "é.\nÉ", "ΑΣ ΑΣΑ",
             "<|endoftext|> x<|startoftext|>", "a\r\nb \t c", "ﬁ ² ½ İ", "word " * 5000, "　x  y"]
    enc = tokens.encoder(public_tokenizers.path(file))
    expected = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    (_, _, buf, offs), = text.chunks(pa.array(texts))
    ids, first = enc.encode(buf, offs)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == expected


@pytest.mark.parametrize("file", FILES)
def test_ids_of_texts_that_hold_added_tokens(file):
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "plain words", "<|startoftext|>Word<|endoftext|><|endoftext|>", "<|endof", "text|> b", "",
             "<|ENDOFTEXT|> x", "<<|endoftext|>>\n<|startoftext|> ", "é<|endoftext|>\n\ny", "it's <|end oftext|>"]
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    enc = tokens.encoder(public_tokenizers.path(file))
    for limit in (20, 1 << 20):
        got = []
        for _, _, buf, offs in text.chunks(pa.array(texts), limit):
            ids, first = enc.encode(buf, offs)
            got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == expected


@pytest.mark.parametrize("file", FILES)
def test_words_are_merged_in_one_go(file):
    """Letters that compose, fold or change in number next to each other."""
    enc = tokens.Encoder(public_tokenizers.path(file))
    words = [" The", "the", "THE", "e", "\u0301x", " \u1100", "\u1161", "\u0130", " \u03a3\u0391\u03a3", "Stra\u00dfe",
             "\u01c5", "\ufb01x", "\u1e9e", "\u0e01", "a1", " ", "don't", "\U00010400", "\u4e2d\u6587", " z"]
    got = enc._merged(words)
    assert sum(x is not None for x in got) >= 8 and got[words.index("a1")] is None
    for word, ids in zip(words, got, strict=True):
        assert ids is None or np.frombuffer(ids, "<u4").tolist() == enc.tokenizer.encode(word, add_special_tokens=False).ids
    assert enc._merged([]) == [] and enc._merged(["1", "-"]) == [None, None]


@pytest.mark.parametrize("most", [3, 40, 10_000])
def test_kept_pieces_give_the_same_ids_again(most, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", most)
    enc = tokens.Encoder(public_tokenizers.path(FILES[0]))
    texts = [" ".join(f"word{i % 7} {'abcdefgh'[i % 8] * (i % 5 + 1)} caf\u00e9 {i * k}" for i in range(30)) for k in (1, 2, 1, 3, 2, 1)]
    for t in texts:
        (_, _, buf, offs), = text.chunks(pa.array([t]))
        assert enc.encode(buf, offs)[0].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids
        for kept in (enc.young, enc.old):
            assert len(kept.begin) == len(kept.sizes) == len(set(kept.hashes.tolist())) and kept.sizes.sum() == len(kept.ids)


def test_kept_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    enc = tokens.Encoder(public_tokenizers.path(FILES[0]))
    for k in range(20):
        (_, _, buf, offs), = text.chunks(pa.array([" ".join(f"q{k}x{i}" for i in range(9))]))
        enc.encode(buf, offs)
        assert len(enc.young) + len(enc.old) < 100
    assert np.iinfo(np.uint32).max > enc.vocabulary
