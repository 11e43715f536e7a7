"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of ``DIMENSIONS`` signs, drawn from a
generator seeded by its code point, so that all tasks agree without sharing
anything.  An n-gram of three letters binds them, each rotated by its place:
``rotate(a, 2) * rotate(b, 1) * c``.  A text is the bundle (sum) of its
n-grams' vectors, a language the bundle of its training texts, and a text
gets the language whose prototype has the greatest cosine with it, all less
what the languages have in common (the mean direction of their prototypes).

Letters are code points that Unicode calls letters, in lower case; everything
else is a gap, and an n-gram reaches one gap beyond a word at most.  Bundles
of training texts are sums of whole numbers, so the order of tasks does not
matter, and every labelled row outside the held-out fold counts (no sample).

What goes to every task: prototypes of at most ``LANGUAGES_AT_ONCE``
languages; with more, the texts are scored block by block.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text when nothing was learned.  Equal cosines go to the
smaller name.  Rows with a null language train nothing; a null doc_id counts
as held out.  Repeated rows are rows of their own.  Other columns of the table,
whatever their names, are kept by ``annotate`` and never read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.store import extended, fitted, flat, numbered, position, released, staged
from candela.llm.text import CHUNK_BYTES, chunks

DIMENSIONS = 2048
UNKNOWN = "und"
LANGUAGES_AT_ONCE = 1024
#: distinct n-grams whose vectors stand in memory at once
GRAMS_AT_ONCE = 2048
FOLDS = 5
_SEED = 20260113

_fold_of = np.full(0x110000, -1, np.int32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """Signs of the given letters; 0, the gap, is a letter of its own here."""
    return np.stack([np.random.default_rng([_SEED, int(c)]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1
                     for c in letters]) if len(letters) else np.zeros((0, DIMENSIONS), np.int8)


def _letters(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0: anything else) of a chunk by code point, and
    the documents' offsets among them."""
    lead = (buf & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    code = buf[at].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        first, p, last = code[wide], at[wide], len(buf) - 1
        follow = [(buf[np.minimum(p + k, last)] & 0x3F).astype(np.int32) for k in (1, 2, 3)]
        two = (first & 0x1F) << 6 | follow[0]
        three = (first & 0x0F) << 12 | follow[0] << 6 | follow[1]
        four = (first & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2]
        code[wide] = np.minimum(np.where(first < 0xE0, two, np.where(first < 0xF0, three, four)), 0x10FFFF)
    folded = _fold_of[code]
    if (folded < 0).any():
        for c in np.unique(code[folded < 0]).tolist():
            _fold_of[c] = ord(chr(c).lower()[0]) if chr(c).isalpha() else 0
        folded = _fold_of[code]
    places = np.concatenate([[0], np.cumsum(lead)])
    return folded, places[offsets]


class Grams(NamedTuple):
    row: np.ndarray     #: group of each entry, ascending
    gram: np.ndarray    #: place in ``parts``
    count: np.ndarray
    parts: np.ndarray   #: distinct n-grams, three letter places each
    letters: np.ndarray  #: code points of the letter places


def grams(buf: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Grams:
    """N-gram counts of a chunk by group; ``group`` numbers its documents'
    groups (-1: leave the document out)."""
    folded, begins = _letters(buf, offsets)
    n = len(folded)
    before, after = np.zeros(n, np.int32), np.zeros(n, np.int32)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    inner = begins[(begins > 0) & (begins < n)]
    before[inner] = after[inner - 1] = 0
    owner = np.repeat(group, np.diff(begins))
    at = np.flatnonzero((folded > 0) & (owner >= 0))
    seen = np.zeros(0x110000, bool)
    seen[0] = True
    seen[folded[at]] = seen[before[at]] = seen[after[at]] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int64)
    place[letters] = np.arange(len(letters))
    m = len(letters)
    gram = (place[before[at]] * m + place[folded[at]]) * m + place[after[at]]
    # below 2**63: Unicode has fewer than 2**18 letters, a chunk of many of them few groups
    key, count = np.unique(owner[at] * (m * m * m) + gram, return_counts=True)
    row, gram = np.divmod(key, m * m * m)
    distinct, gram = np.unique(gram, return_inverse=True)
    parts = np.stack([distinct // (m * m), distinct // m % m, distinct % m], axis=1)
    return Grams(row, gram, count, parts, letters)


def bundles(g: Grams, rows: int, dtype=np.float32) -> np.ndarray:
    """The bundle of every group: rows x DIMENSIONS."""
    out = np.zeros((rows, DIMENSIONS), dtype)
    if not len(g.row):
        return out
    by_gram = np.argsort(g.gram, kind="stable")
    row, gram, count = g.row[by_gram], g.gram[by_gram], g.count[by_gram]
    for lo in range(0, len(g.parts), GRAMS_AT_ONCE):
        parts = g.parts[lo:lo + GRAMS_AT_ONCE]
        used, local = np.unique(parts, return_inverse=True)
        vectors, local = letter_vectors_of(g.letters[used]), local.reshape(parts.shape)
        bound = np.roll(vectors, 2, axis=1)[local[:, 0]]
        bound *= np.roll(vectors, 1, axis=1)[local[:, 1]]
        bound *= vectors[local[:, 2]]
        span = slice(*np.searchsorted(gram, [lo, lo + len(parts)]))
        counts = np.zeros((rows, len(parts)), dtype)
        counts[row[span], gram[span] - lo] = count[span]
        out += counts @ bound.astype(dtype)
    return out


_known: dict[int, np.ndarray] = {}


def letter_vectors_of(letters: np.ndarray) -> np.ndarray:
    """``letter_vectors``, keeping those of a few thousand letters."""
    new = [c for c in letters.tolist() if c not in _known]
    if new:
        if len(_known) + len(new) > 8192:
            _known.clear()
            new = letters.tolist()
        _known.update(zip(new, letter_vectors(np.array(new))))
    return np.stack([_known[c] for c in letters.tolist()])


class Profiles(NamedTuple):
    names: list[str]       #: languages, sorted
    vectors: np.ndarray    #: languages x DIMENSIONS, unit length, less the common part
    common: np.ndarray     #: unit vector of what the languages share (zero for one language)


def _bundle_rows(batches):
    """(lang, bundle) of a task's texts."""
    sums: dict[str, np.ndarray] = {}

    def flush():
        names = list(sums)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([sums[k].tolist() for k in names], pa.list_(pa.float64()))],
            names=["lang", "bundle"])
        sums.clear()
        return batch

    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), np.asarray(langs.indices.fill_null(-1), np.int64)
        for lo, hi, buf, offsets in chunks(batch.column(0)):
            made = bundles(grams(buf, offsets, codes[lo:hi]), len(names), np.float64)
            for name, one in zip(names, made):
                if name is not None:
                    sums[name] = sums[name] + one if name in sums else one
            if len(sums) > LANGUAGES_AT_ONCE:
                yield flush()
    if sums:
        yield flush()


def fit(docs: DataFrame) -> list[Profiles]:
    """Prototypes of all languages in the training folds, in blocks."""
    train = fitted(docs, doc_id="string", text="string", lang="string").where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    parts = train.mapInArrow(released(_bundle_rows), "lang string, bundle array<double>")
    summed = staged(parts.select("lang", F.posexplode("bundle").alias("dim", "v")).groupBy("lang", "dim").agg(
        F.sum("v").alias("v")), "language-profiles")
    length = summed.groupBy("lang").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size")).where("size > 0")
    length = staged(numbered(length, [F.col("lang")], "place", 0, "languages"), "language-lengths")
    unit = summed.join(length, "lang").select("lang", "dim", "place", (F.col("v") / F.col("size")).alias("v"))
    found = []
    for k in range(0, length.count(), LANGUAGES_AT_ONCE):
        got = unit.where(F.col("place").between(k, k + LANGUAGES_AT_ONCE - 1)).drop("place").toPandas()
        wide = got.pivot(index="lang", columns="dim", values="v")
        found.append((wide.index.tolist(), wide.to_numpy()))
    common = sum(v.sum(axis=0) for _, v in found) if sum(len(names) for names, _ in found) > 1 else np.zeros(DIMENSIONS)
    common = common / max(np.linalg.norm(common), 1e-300)
    out = []
    for names, vectors in found:
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        own = vectors[order] - np.outer(vectors[order] @ common, common)
        own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-300)
        out.append(Profiles([names[i] for i in order], own.astype(np.float32), common.astype(np.float32)))
    return out


def cosines(vectors: np.ndarray, profiles: Profiles) -> np.ndarray:
    """Cosine of every text's bundle with every prototype, both less the common part."""
    own = vectors - np.outer(vectors @ profiles.common, profiles.common)
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-30)
    return own @ profiles.vectors.T


def annotate(docs: DataFrame, profiles: list[Profiles], text: str = "text", language: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` with the language found and its cosine as 0 to 1 (half of one
    more than the cosine; 0 for ``und``)."""
    taken = (language.lower(), score.lower())
    df, read = flat(docs), f"c{position(docs, text)}"
    for k, block in enumerate(profiles):
        sent = docs.sparkSession.sparkContext.broadcast(block)  # of at most LANGUAGES_AT_ONCE languages

        def make(column, sent=sent):
            best, cosine = [], []
            for _, _, buf, offsets in chunks(column, CHUNK_BYTES):
                n = len(offsets) - 1
                g = grams(buf, offsets, np.arange(n))
                close = cosines(bundles(g, n), sent.value)
                top = close.argmax(axis=1)
                lettered = np.zeros(n, bool)
                lettered[g.row] = True
                best += [sent.value.names[t] if ok else None for t, ok in zip(top, lettered)]
                cosine += [float(close[i, t]) if ok else None for i, (t, ok) in enumerate(zip(top, lettered))]
            return [pa.array(best, pa.string()), pa.array(cosine, pa.float64())]

        df = extended(df, read, {f"lang{k}": "string", f"cosine{k}": "double"}, make)
    # the greatest cosine, then the smaller name: the first of the sorted pairs
    pairs = [F.struct((-F.col(f"cosine{k}")).alias("far"), F.col(f"lang{k}").alias("lang")) for k in range(len(profiles))]
    best = F.array_min(F.array(*pairs)) if pairs else F.lit(None).cast("struct<far:double,lang:string>")
    df = df.withColumn("best", best)
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken]
    share = F.least(F.greatest((F.lit(1.0) - F.col("best.far")) / 2, F.lit(0.0)), F.lit(1.0))
    return df.select(*keep, F.coalesce(F.col("best.lang"), F.lit(UNKNOWN)).alias(language),
                     F.coalesce(share, F.lit(0.0)).alias(score))
