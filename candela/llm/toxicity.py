"""Toxicity by a convolutional text classifier (operator 7), trained in numpy.

A word's vector is the sum of two hashed embeddings, one of the lower-cased
word and one of its first bytes. Filters of several widths run over the whole
text; each filter's largest response in the text (max pooling) feeds a
logistic layer.

The first dimension of both embeddings is no free weight: it is the smoothed
log-odds of the word, or of its beginning, in toxic texts. While the network
learns, a text sees odds counted without the part of the rows that it is in, so
that a word's odds are worth in training what they are worth in a new text. The
other dimensions start small and decay. Words never seen have odds of 0.

A second, linear head over the same hashed words guesses the language of a
text. It is fitted on the languages of the training rows; scoring sees the
text alone. Thresholds are calibrated for each guessed language on all labelled
rows of a fold that no gradient saw, at the rates the classes have there: the
tasks count labels by language and bin of the logit, and the cut between bins
with the best F1 is taken. A language's cut is drawn to that of all languages by
as much as it has few positive rows, and never comes near the logit of a text
without words. The score is the logistic of the distance to the guessed
language's threshold, so 0.5 is that threshold.

Training uses at most ``TRAIN_ROWS`` labelled rows of each class, those with
the smallest hash of their id, outside the held-out fold; of these, the rows of
the calibration fold are not learnt from. Everything else covers all rows and
whole texts.

Defined cases: a text without words (null and empty ones too) scores the share of
toxic rows in the calibration fold, below 0.5 in any case; rows
without a label are scored and not learnt from; a null doc_id counts as the
text "" (its crc32 is 0: held out) and is not learnt from; contradicting
labels of one id are all learnt from; without training rows of both classes
every score is 0; empty tables give no rows; ``annotate`` keeps extra columns.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.store import extended, fitted, give_back, released
from candela.llm.text import ALNUM, chunks, mix, words

#: bound of the sample, by class
TRAIN_ROWS = 4500
FOLDS = 5
WORD_BUCKETS = 1 << 16
PREFIX_BUCKETS = 1 << 13
PREFIX_BYTES = 5
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
EPOCHS = 3
BATCH = 64
RATE = 0.02
DECAY = 0.004
#: parts of the training rows for odds that leave a text's own part out
PARTS = 5
#: rows that a word's odds are smoothed with
SMOOTHING = 1.0
#: a language needs so many positive calibration rows for a threshold of its own
LEAST_POSITIVES = 10
#: positive rows that the cut of all languages counts in each, and the least
#: distance of a cut from the logit of a text without words
SHRINKAGE = 20
LEAST_GAP = 0.1
#: fold of the rows that thresholds are calibrated on
CALIBRATION = 1
#: bins of logits in a unit, and the logit beyond which they are one
BINS, FAR_LOGIT = 32, 64


class Model(NamedTuple):
    words: np.ndarray  #: (buckets, DIM), as are the prefixes
    prefixes: np.ndarray
    filters: np.ndarray  #: (offsets of all widths, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: list[str]
    language_weights: np.ndarray  #: (word buckets, languages)
    thresholds: np.ndarray
    prior: float = 0.0  #: score of a text without words


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and prefix buckets of the chunk's words; first word of each document."""
    w = words(buf, offs, ALNUM)
    if not len(w.starts):
        return np.zeros(0, np.uint16), np.zeros(0, np.uint16), np.zeros(len(offs), np.int64)
    ends = np.minimum(w.starts + PREFIX_BYTES, w.ends)
    low = np.zeros(len(w.starts), np.uint64)
    lower = buf | np.where((buf >= 65) & (buf <= 90), 32, 0).astype(np.uint8)
    for k in range(PREFIX_BYTES):
        at = w.starts + k
        low = low * np.uint64(257) + np.where(at < ends, lower[np.minimum(at, len(buf) - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return ((w.hashes >> np.uint64(20)) % np.uint64(WORD_BUCKETS)).astype(np.uint16), \
        ((mix(low) >> np.uint64(17)) % np.uint64(PREFIX_BUCKETS)).astype(np.uint16), w.first


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    """Whether a row is outside the training folds."""
    return _fold(doc_id) == 0


def fold(doc_id: object) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS


PAD = max(WIDTHS) - 1
_SPANS = [(w, sum(WIDTHS[:i])) for i, w in enumerate(WIDTHS)]
#: rows of words whose responses stand in memory at once
BLOCK_WORDS = 1 << 16


def _padded(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after another, at least one row and PAD rows each: the row
    of every word, the first row of every text (one more at the end), and
    whether a filter may start in a row."""
    n = np.diff(first)
    rows = np.maximum(n, 1) + PAD
    begin = np.append(0, np.cumsum(rows))
    at = np.arange(first[-1]) + np.repeat(begin[:-1] - first[:-1], n)
    starts = np.ones(begin[-1], bool)
    for k in range(PAD):
        starts[begin[1:] - 1 - k] = False
    return at, begin, starts


def _responses(v: np.ndarray, filters: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Per width, the response of each filter in each row that may start one;
    ``v`` has PAD more rows than ``starts``."""
    r = (v @ filters.transpose(1, 0, 2).reshape(DIM, -1)).reshape(len(v), -1, FILTERS)
    n, out = len(starts), []
    for w, at in _SPANS:
        s = r[:n, at].copy()
        for k in range(1, w):
            s += r[k:n + k, at + k]
        s[~starts] = -np.inf
        out.append(s)
    return out


def _odds(rows: list[tuple], column: int, buckets: int) -> np.ndarray:
    """Smoothed log-odds of toxic texts by bucket, half of them: a word's and
    its beginning's add up."""
    counts = np.zeros((2, buckets))
    for r in rows:
        counts[r[2], np.unique(r[column])] += 1
    toxic = sum(r[2] for r in rows)
    q = min(max(toxic / max(len(rows), 1), 1e-3), 1 - 1e-3)
    odds = np.log((counts[1] + SMOOTHING * q) / (counts[0] + SMOOTHING * (1 - q))) - np.log(q / (1 - q))
    return (odds / 2).astype(np.float32)


class _Network:
    """Adam over the embeddings and filters; gradients are sparse: a text
    touches only the words under its largest responses."""

    def __init__(self, rng, word_odds: np.ndarray, prefix_odds: np.ndarray):
        """Odds of every part: parts x buckets."""
        self.word_odds, self.prefix_odds = word_odds, prefix_odds
        self.e = rng.normal(0, 0.03, (WORD_BUCKETS, DIM)).astype(np.float32)
        self.p = rng.normal(0, 0.03, (PREFIX_BUCKETS, DIM)).astype(np.float32)
        self.e[:, 0] = self.p[:, 0] = 0
        self.f = rng.normal(0, 0.1, (sum(WIDTHS), DIM, FILTERS)).astype(np.float32)
        for w, at in _SPANS:  # some filters begin as the mean odds of their words
            self.f[at:at + w, 0, :FILTERS // 2] += 1 / w
        self.b = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.o = np.abs(rng.normal(0, 0.06, len(WIDTHS) * FILTERS)).astype(np.float32)
        self.c = np.full(1, -1, np.float32)
        self.state = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in "epfboc"}
        self.t = self.epoch = 0

    def _vectors(self, w, p, part):
        v = self.e[w] + self.p[p]
        v[:, 0] = self.word_odds[part, w] + self.prefix_odds[part, p]
        return v

    def step(self, w, p, first, part, y, weight):
        """One batch of texts: buckets of their words, first word of each, the
        texts' parts. Responses stand in memory for a block of words at a time."""
        at, begin, starts = _padded(first)
        word = np.full(len(starts) + PAD, -1, np.int32)
        word[at] = np.arange(len(at))
        n = len(y)
        doc = np.repeat(np.arange(n), np.diff(begin))
        own = np.repeat(part, np.diff(first))
        best = np.full((len(WIDTHS), n, FILTERS), -np.inf, np.float32)
        where = np.zeros((len(WIDTHS), n, FILTERS), np.int64)
        for a in range(0, len(starts), BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, len(starts))
            held = word[a:b + PAD]
            v = np.zeros((len(held), DIM), np.float32)
            v[held >= 0] = self._vectors(w[held[held >= 0]], p[held[held >= 0]], own[held[held >= 0]])
            here, begins = np.unique(doc[a:b], return_index=True)
            for i, s in enumerate(_responses(v, self.f, starts[a:b])):
                top = np.maximum.reduceat(s, begins)
                row, column = np.nonzero(s == top[doc[a:b] - here[0]])
                _, j = np.unique((doc[a + row] - here[0]) * FILTERS + column, return_index=True)  # the first of equal ones
                place = (a + row[j]).reshape(len(here), FILTERS)
                better = top > best[i, here]
                where[i, here] = np.where(better, place, where[i, here])
                best[i, here] = np.where(better, top, best[i, here])
        x = np.maximum(best.transpose(1, 0, 2).reshape(n, -1) + self.b, 0)
        score = 1 / (1 + np.exp(-np.clip(x @ self.o + self.c[0], -30, 30)))
        d = ((score - y) * weight).astype(np.float32)
        dx = d[:, None] * self.o * (x > 0)
        g = {"c": d.sum(keepdims=True), "o": d @ x, "b": dx.sum(axis=0), "f": np.zeros_like(self.f)}
        rows, grads = [], []
        column = np.tile(np.arange(FILTERS), n)
        for i, (width, at) in enumerate(_SPANS):
            di = dx[:, i * FILTERS:(i + 1) * FILTERS].ravel()
            for k in range(width):
                found = word[where[i].ravel() + k]
                live = (di != 0) & (found >= 0)
                found, dl, c = found[live], di[live][:, None], column[live]
                part_f = np.zeros((FILTERS, DIM), np.float32)
                np.add.at(part_f, c, self._vectors(w[found], p[found], own[found]) * dl)
                g["f"][at + k] += part_f.T
                rows.append(found)
                grads.append(self.f[at + k].T[c] * dl)
        self.t += 1
        rows, grads = np.concatenate(rows), np.concatenate(grads)
        grads[:, 0] = 0  # odds are counted, not learnt
        for k, bucket in (("e", w), ("p", p)):
            unique, index = np.unique(bucket[rows], return_inverse=True)
            total = np.zeros((len(unique), DIM), np.float32)
            np.add.at(total, index, grads)
            self._adam(k, unique, total)
        for k in "fboc":
            self._adam(k, slice(None), g[k])

    def _adam(self, k, rows, grad):
        grad, rate = grad / BATCH, RATE * (1 if self.epoch == 0 else 0.25)
        if k not in "bc":
            grad = grad + DECAY * getattr(self, k)[rows]
        m, v = self.state[k]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
        getattr(self, k)[rows] -= rate * (m[rows] / (1 - 0.9 ** self.t)) / (np.sqrt(v[rows] / (1 - 0.99 ** self.t)) + 1e-6)


def _logits(model: Model, w, p, first) -> tuple[np.ndarray, np.ndarray]:
    """Logit and language number of every text; long ones in blocks of rows."""
    n = len(first) - 1
    at, begin, starts = _padded(first)
    e, q = np.full(len(starts) + PAD, -1, np.int32), np.full(len(starts) + PAD, -1, np.int32)
    e[at], q[at] = w, p
    doc = np.repeat(np.arange(n), np.diff(begin))
    best = np.full((n, len(WIDTHS), FILTERS), -np.inf, np.float32)
    for a in range(0, len(starts), BLOCK_WORDS):
        b = min(a + BLOCK_WORDS, len(starts))
        v = model.words[e[a:b + PAD]] + model.prefixes[q[a:b + PAD]]
        v[e[a:b + PAD] < 0] = 0
        here, begins = np.unique(doc[a:b], return_index=True)
        for i, s in enumerate(_responses(v, model.filters, starts[a:b])):
            best[here, i] = np.maximum(best[here, i], np.maximum.reduceat(s, begins))
    x = np.maximum(best.reshape(n, -1) + model.bias, 0)
    votes = np.zeros((n, model.language_weights.shape[1]))
    some = np.flatnonzero(np.diff(first))
    if len(some):
        votes[some] = np.add.reduceat(model.language_weights[w], first[some])
    return x @ model.out + model.out_bias, votes.argmax(axis=1)


def _language_head(rows, languages: list[str]) -> np.ndarray:
    """Log-odds of each word bucket for each language, from training texts."""
    counts = np.ones((WORD_BUCKETS, max(1, len(languages))))
    number = {x: i for i, x in enumerate(languages)}
    for w, _, _, lang in rows:
        np.add.at(counts, (w, number[lang]), 1)
    odds = np.log(counts / counts.sum(axis=0))
    return (odds - odds.mean(axis=1, keepdims=True)).astype(np.float32)


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple]:
    """At most TRAIN_ROWS labelled rows of each class outside the held-out
    fold, those with the smallest hash of the id: (doc_id, word buckets, prefix
    buckets, lang, toxic). Texts become buckets in the tasks."""
    known = (fitted(labels, doc_id="long", toxic="int")
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .withColumn("h", F.xxhash64("doc_id")))
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(TRAIN_ROWS)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = fitted(docs, doc_id="long", text="string", lang="string")
    # at most 2 * TRAIN_ROWS ids go to the tasks
    joined = texts.join(F.broadcast(chosen.drop("h")), "doc_id")
    # ids may repeat in either table: the bound holds for the rows as well
    part = None
    for y in (0, 1):
        some = (joined.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
                .limit(TRAIN_ROWS).select("text", "doc_id", "lang", "toxic"))
        part = some if part is None else part.unionByName(some)

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0)):
                w, p, first = features(buf, offs)
                ranges = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[1:]),
                     *(pa.array([x[a:b].tobytes() for a, b in ranges], pa.binary()) for x in (w, p))],
                    names=["doc_id", "lang", "toxic", "w", "p"])

    rows = part.mapInArrow(released(run), "doc_id long, lang string, toxic int, w binary, p binary").toArrow()
    return [(i, np.frombuffer(w, np.uint16), np.frombuffer(p, np.uint16), lang, y) for i, lang, y, w, p in zip(
        *(rows.column(c).to_pylist() for c in ("doc_id", "lang", "toxic", "w", "p")), strict=True)]


def labelled(texts: list[tuple]) -> list[tuple]:
    """Rows for ``train`` of (doc_id, text, lang, toxic)."""
    out = []
    for lo, hi, buf, offs in chunks(pa.array([r[1] for r in texts], pa.string())):
        w, p, first = features(buf, offs)
        out += [(r[0], w[a:b], p[a:b], r[2], r[3]) for r, a, b in zip(texts[lo:hi], first[:-1], first[1:], strict=True)]
    return out


def train(rows: list[tuple], seed: int = 7) -> Model | None:
    """A model from the rows of ``sample``, its thresholds at 0 until
    ``calibrated``; None without both classes."""
    rows = sorted(rows, key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0]), r[1].tobytes()))
    data = [(w, p, y, lang or "") for _, w, p, lang, y in rows]
    part = [fold(r[0]) for r in rows]
    fit = [x for x, k in zip(data, part, strict=True) if k != CALIBRATION]
    positives = sum(x[2] for x in fit)
    if not positives or positives == len(fit):
        return None
    rng = np.random.default_rng(seed)
    parts = np.array([zlib.crc32(f"part {i}".encode()) % PARTS for i in range(len(fit))])
    rest = [[x for x, k in zip(fit, parts, strict=True) if k != j] for j in range(PARTS)]
    net = _Network(rng, np.stack([_odds(r, 0, WORD_BUCKETS) for r in rest]), np.stack([_odds(r, 1, PREFIX_BUCKETS) for r in rest]))
    # the classes weigh the same
    share = (len(fit) / (2 * (len(fit) - positives)), len(fit) / (2 * positives))
    for net.epoch in range(EPOCHS):
        order = rng.permutation(len(fit))
        for i in range(0, len(order), BATCH):
            batch = [fit[j] for j in order[i:i + BATCH]]
            net.step(*_joined(batch), parts[order[i:i + BATCH]], np.array([x[2] for x in batch]), np.array([share[x[2]] for x in batch]))
    net.e[:, 0], net.p[:, 0] = _odds(fit, 0, WORD_BUCKETS), _odds(fit, 1, PREFIX_BUCKETS)
    languages = sorted({x[3] for x in fit})
    return Model(net.e, net.p, net.f, net.b, net.o, float(net.c[0]), languages, _language_head(fit, languages),
                 np.zeros(len(languages)))


def _joined(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.append(0, np.cumsum([len(x[0]) for x in batch]))
    return np.concatenate([x[0] for x in batch]), np.concatenate([x[1] for x in batch]), first


def _best(bins: np.ndarray, n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The cut between bins with the best F1, in the middle of its gap: of
    every bin's rows, the number, the positives, the least and the largest
    logit; a bin may come in several parts."""
    order, index = np.unique(-bins, return_inverse=True)
    n, hits = np.bincount(index, n), np.bincount(index, hits)
    least, most = np.full(len(order), np.inf), np.full(len(order), -np.inf)
    np.minimum.at(least, index, low)
    np.maximum.at(most, index, high)
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    k = int(f1.argmax())
    below = most[k + 1] if k + 1 < len(order) else least[k] - 1
    return float((least[k] + below) / 2)


def _thresholds(languages: int, counts: np.ndarray, empty: float) -> np.ndarray:
    """Of rows (language, bin, rows, positives, least and largest logit), and
    the logit of a text without words. A language's own cut counts as many rows
    as it has positives, that of all languages SHRINKAGE."""
    known, (n, hits) = counts[:, 0], counts[:, 2:4].T
    common = _best(*counts[:, 1:].T) if 0 < hits.sum() < n.sum() else empty + 1
    common = max(common, empty + LEAST_GAP)
    out = np.full(languages, common)
    for k in range(languages):
        mine = known == k
        positives = hits[mine].sum()
        if LEAST_POSITIVES <= positives < n[mine].sum():
            cut = (positives * _best(*counts[mine, 1:].T) + SHRINKAGE * common) / (positives + SHRINKAGE)
            out[k] = max(cut, (empty + common) / 2)
    return out


def calibrated(model: Model, docs: DataFrame, labels: DataFrame) -> Model:
    """``model`` with thresholds from all labelled rows of the calibration
    fold. Texts become bins in the tasks; the driver gets a row a language and
    bin."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(1), 1 << 19):
                logits, language = _logits(shared.value, *features(buf, offs))
                bins = np.floor(np.clip(logits, -FAR_LOGIT, FAR_LOGIT) * BINS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(language.astype(np.int32)), pa.array(bins),
                     pa.array(logits.astype(np.float64))], names=["doc_id", "language", "bin", "logit"])

    tuned = lambda df: df.where(F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) == CALIBRATION))
    # ids may repeat in either table: counted before they meet
    known = (tuned(fitted(labels, doc_id="long", toxic="int")).where(F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.count("*").alias("rows"), F.sum("toxic").alias("hits")))
    scored = (tuned(fitted(docs, doc_id="long", text="string")).mapInArrow(
        released(run), "doc_id long, language int, bin int, logit double")
        .groupBy("doc_id", "language", "bin").agg(F.count("*").alias("times"), F.min("logit").alias("low"), F.max("logit").alias("high")))
    counts = (scored.join(known, "doc_id").groupBy("language", "bin")
              .agg(F.sum(F.col("rows") * F.col("times")), F.sum(F.col("hits") * F.col("times")), F.min("low"), F.max("high")).collect())
    counts = np.array(counts, np.float64).reshape(-1, 6)
    nothing = np.zeros(0, np.uint16)
    empty = float(_logits(model, nothing, nothing, np.zeros(2, np.int64))[0][0])
    share = counts[:, 3].sum() / max(counts[:, 2].sum(), 1)
    return model._replace(thresholds=_thresholds(len(model.languages), counts, empty), prior=min(share, 0.49))


def scores(model: Model | None, column: pa.Array) -> np.ndarray:
    """Score of every text: 0.5 is the threshold of its guessed language."""
    out = [np.zeros(0)]
    for lo, hi, buf, offs in chunks(column, 1 << 19):
        if model is None:
            out.append(np.zeros(hi - lo))
            continue
        w, p, first = features(buf, offs)
        logits, language = _logits(model, w, p, first)
        score = 1 / (1 + np.exp(-np.clip(logits - model.thresholds[language], -30, 30)))
        out.append(np.where(np.diff(first) > 0, score, model.prior))
    return np.concatenate(out)


def annotate(docs: DataFrame, model: Model | None, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a further column ``score``; every other column is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    return extended(docs, text, {score: "double"}, lambda column: [pa.array(scores(shared.value, column), pa.float64())])


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    model = train(sample(docs, labels))
    give_back()  # what training held
    return model and calibrated(model, docs, labels)
