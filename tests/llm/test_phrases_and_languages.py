import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candela.llm import collocations, langid
from candela.llm.text import chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- phrase collocations -----------------------------------------------------

def _phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(w[i:i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {g: c for g, c in counts.items() if c >= least}
        inside = Counter()
        for g, c in often.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[g[i:i + m]] = max(inside[g[i:i + m]], c)
        found = []
        for g, a in often.items():
            if len(g) < 2 or 100 * inside[g] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (often[g[:k]] * often[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), often[g[:k]], often[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def _texts(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "ß", "x_", "Zz"]
    passage = [" ".join(rng.choices(vocabulary, k=9)) for _ in range(3)]
    rows = []
    for i in range(count):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=rng.randrange(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in words)
        rows.append((rng.choice(["en", "de", None]), text + rng.choice(passage) * rng.randrange(0, 3)))
    return [*rows, ("en", None), ("en", ""), ("fr", " .,; "), (None, "w1 " * 3000), ("en", "A b c a B C")]


@pytest.mark.parametrize("at_once", [4_000_000, 7])
def test_phrases_against_brute_force(spark, at_once, monkeypatch):
    monkeypatch.setattr(collocations, "WORDS_AT_ONCE", at_once)  # the word table in one block and in several
    if at_once < 100:
        monkeypatch.setattr(collocations, "GRAMS_AT_ONCE", 500)
        monkeypatch.setattr(collocations, "GRAMS_A_RANGE", 50)
        monkeypatch.setattr(collocations, "BITMAP_BITS", 256)  # errs often, and nothing is lost
    rows = _texts(3, 150)
    df = spark.createDataFrame([(i % 7, t, lang, "x") for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, ids string").repartition(5)
    got = [tuple(r) for r in collocations.mine(df, least=4, top=40).collect()]
    want = _phrases(rows, 4, 40)
    assert sorted(got) == want and {len(r[2].split()) for r in want} == {2, 3, 4, 5}


def test_phrases_of_clashing_columns_and_nothing(spark):
    rows = [(1, "x y", "no", "x y x y", "en")] * 3
    df = spark.createDataFrame(rows, "doc_id long, TEXT string, LANG string, text string, lang string")
    got = [tuple(r) for r in collocations.mine(df, least=5, top=5).collect()]
    assert got == _phrases([("en", "x y x y")] * 3, 5, 5) and got[0][2] == "x y"
    for nothing in ([], [(1, None, None)], [(1, "one two", "en")]):
        empty = collocations.mine(spark.createDataFrame(nothing, "doc_id long, text string, lang string"), least=2)
        assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.count() == 0


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 9), (3, 15), (4, 16), (5, 13), (5, 25)])
def test_filters_give_back_what_they_hold(n, bits):
    rng = np.random.default_rng(n * bits)
    p = collocations.Packing(n, bits)
    ids = [rng.integers(0, 1 << bits, 3000).astype(np.uint32) for _ in range(n)]
    ids = [np.concatenate([w, w[:1000], np.repeat(w[:1], 400)]) for w in ids]
    rho = p.ranges(1)
    assert np.array_equal(collocations.unpacked(*collocations.packed(ids, p), p), np.stack(ids, axis=1))
    high, low = collocations.permuted(*collocations.packed(ids, p), p.half)
    want = Counter(map(tuple, np.stack(ids, axis=1).tolist()))
    got = Counter()
    for r in range(1 << rho):
        mine = (high >> np.uint64(p.half - rho)) == r
        blobs = [collocations.written(*collocations.summed(high[part], low[part], p.half), p.half, rho)
                 for part in (np.flatnonzero(mine)[::2], np.flatnonzero(mine)[1::2]) if len(part)]
        if blobs:
            h, l, c = collocations.merged(blobs, r, p.half, rho)
            assert (np.diff(h.astype(object) * (1 << p.half) + l.astype(object)) > 0).all()
            back = collocations.unpacked(*collocations.restored(h, l, p.half), p)
            got.update({tuple(x): int(k) for x, k in zip(back.tolist(), c)})
    assert got == want and max(want.values()) > 255


# --- language identification -------------------------------------------------

def _brute_bundle(text):
    """The bundle of a text, one n-gram at a time."""
    letters = [c.lower()[0] if c.isalpha() else None for c in text]
    vector = lambda c: langid.letter_vectors(np.array([0 if c is None else ord(c)]))[0].astype(np.int64)
    out = np.zeros(langid.DIMENSIONS, np.int64)
    for i, c in enumerate(letters):
        if c is not None:
            a = letters[i - 1] if i else None
            b = letters[i + 1] if i + 1 < len(letters) else None
            out += np.roll(vector(a), 2) * np.roll(vector(c), 1) * vector(b)
    return out


def test_bundles_against_one_gram_at_a_time(monkeypatch):
    monkeypatch.setattr(langid, "GRAMS_AT_ONCE", 3)
    texts = ["Hello, wörld! ÀÉ ßx", "", None, "a", "  7 .", "日本 語 😀 𐐀b", "aa aa aa", "İstanbul Ⅷ"]
    for limit in (1 << 20, 10):
        for lo, hi, buf, offsets in chunks(pa.array(texts, pa.string()), limit):
            made = langid.bundles(langid.grams(buf, offsets, np.arange(hi - lo)), hi - lo)
            for one, text in zip(made, texts[lo:hi]):
                assert np.array_equal(one, _brute_bundle(text or ""))


LANGS = {"aa": ["the", "and", "thing", "with", "her"], "bb": ["der", "und", "ein", "schö", "licht"], "cc": ["que", "été", "les", "eau"]}


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(9)
    rows = []
    for i in range(400):
        lang = rng.choice(list(LANGS))
        parts = LANGS[lang] * 3 + [w for other in LANGS.values() for w in other]
        rows.append((i, " ".join("".join(rng.choices(parts, k=2)).title() for _ in range(rng.randrange(3, 40))), lang))
    return rows


def test_languages_of_held_out_texts(spark, labelled, monkeypatch):
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 + 3!", "cc"), (1003, "THE", None), (None, "und der", "bb"), (5, "que les", "cc"),
           (1004, "schölicht " * 40_000, "bb")]
    schema = "doc_id long, text string, lang string, TEXT string, lang_pred string"
    df = spark.createDataFrame([(*r, "z", "old") for r in labelled + odd], schema).repartition(4)
    model = langid.fit(df)
    assert [p.names for p in model] == [["aa", "bb", "cc"]]
    rows = langid.annotate(df, model).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    assert len(rows) == len(df.collect()) and all(0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert len(out) > 50 and sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is None or r["doc_id"] >= 1000}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000]["score"] == 0
    assert by[1003]["lang_pred"] == "aa" and by[1004]["lang_pred"] == "bb" and by[None]["out"]
    # the same in blocks of one language, but for what rounding moves
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 1)
    blocks = langid.fit(df)
    assert sorted(n for p in blocks for n in p.names) == ["aa", "bb", "cc"] and len(blocks) > 1
    plain = spark.createDataFrame(labelled, "doc_id long, text string, lang string")
    one, several = (langid.annotate(plain, m).orderBy("doc_id").collect() for m in (model, blocks))
    assert [r["lang_pred"] for r in one] == [r["lang_pred"] for r in several]


def test_languages_learned_from_nothing(spark):
    df = spark.createDataFrame([(0, "some text", None), (None, "x", "aa")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model == [] and {(r["lang_pred"], r["score"]) for r in langid.annotate(df, model).collect()} == {("und", 0.0)}
    assert langid.annotate(df.limit(0), model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
