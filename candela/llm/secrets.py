r"""Secret scanning by a linear-chain conditional random field (operator 10).

A text is a chain of tokens, maximal runs without white space. Each token has
a shape class, made from its length, its kinds of characters, how mixed they
are, and the marks it holds; the chain's features are the token's own class,
its neighbours' classes, and a class of the whole text (its share of digits
and of assignment marks). Tags are B (a secret begins), I (inside) and O.
Weights are trained in numpy by exact gradients (forward-backward) on a
bounded sample of lines (of long lines, stretches around their secrets), tagged
by the base patterns below; decoding is Viterbi over the whole text.

Viterbi runs between certain tokens only: where O beats B and I by more than
any change of transitions can make good, every best path has O, whatever the
neighbours, so the chain may be cut there and the result stays exact.

``find_secrets`` returns all spans: the base patterns' spans, and the CRF's
spans that overlap none of them. The patterns are

* assign: ``(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)``,
  letters of the word in either case, the second group 6 characters or longer;
* access: ``AKIA[A-Z0-9]+`` of 20 characters or longer;
* hex: ``[0-9a-f]+`` of 24 characters or longer.

Defined cases: a null or empty text has no spans; a null doc_id stays null;
repeated rows are judged each; a corpus without a base span trains no field
and gets the base spans alone (here: none); empty tables give no rows; extra
columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.store import extended, fitted, released

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_HINT = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter run holds no longer one
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as the pattern is greedy

#: bound of the training sample, in lines of each sort
TRAIN_LINES = 3000
#: a longer line is trained on in stretches around its secrets
LINE_CHARS = 4096
EPOCHS = 15
RATE = 0.5
DECAY = 1e-4
CACHE_TOKENS = 100_000

Span = tuple[int, int, int]  # kind, start, end


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    low = text.lower()
    if any(x in low for x in ASSIGN_HINT):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


# --- tokens and features ---------------------------------------------------

#: class 0 is a plain word, 1 an empty stretch between two spaces
PLAIN, EMPTY = 0, 1
_KEYWORD = re.compile("pass|secret|token|key|auth|cred", re.IGNORECASE)
_MARKS = ".,;:!?\"'()[]{}<>*#$%&"
_PLAIN = re.compile(rf"[{re.escape(_MARKS)}]*[^\W\d_]{{0,23}}[{re.escape(_MARKS)}]*")


def shape(token: str) -> tuple:
    """The shape of a token; words of letters, with or without marks around
    them, are plain unless they are long or hold a tell-tale word."""
    if not token:
        return ("empty",)
    word = bool(_KEYWORD.search(token))
    if not word and _PLAIN.fullmatch(token):
        return ("plain",)
    core = token.strip(_MARKS)
    mark = "=" if "=" in token else ":" if ":" in token else ""
    low = core.lower()
    n = len(core)
    kinds = (any(c.isdigit() for c in core), any(c.isupper() for c in core), any(c.islower() for c in core))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(core).values()) if n else 0
    hexlike = n >= 8 and all(c in "0123456789abcdef" for c in low)
    return (min(n, 48) // 6, kinds, min(int(entropy), 5), hexlike, word, mark, token[:1] in "\"'", low.startswith("akia"))


class Classes:
    """Numbers of the shapes met in training; others are the class UNKNOWN."""

    def __init__(self):
        self.number: dict[tuple, int] = {("plain",): PLAIN, ("empty",): EMPTY}
        self.seen: dict[str, int] = {}
        self.frozen = False

    def __call__(self, token: str) -> int:
        k = self.seen.get(token)
        if k is None:
            s = shape(token)
            if not self.frozen:
                self.number.setdefault(s, len(self.number))
            k = self.number.get(s, len(self.number))
            if len(self.seen) >= CACHE_TOKENS:
                self.seen.clear()
            self.seen[token] = k
        return k

    def __len__(self) -> int:
        return len(self.number) + 1  # and UNKNOWN

    def __getstate__(self):
        return {"number": self.number, "seen": {}, "frozen": self.frozen}


_WHITE = re.compile(r"\s")


def split(text: str) -> tuple[list[str], np.ndarray]:
    """Tokens between single white space characters, and their starts."""
    if "\n" in text:
        text = text.replace("\n", " ")
    if not text.isascii() or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        text = _WHITE.sub(" ", text)
    tokens = text.split(" ")
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    return tokens, np.append(0, ends[:-1])


def classes_of(tokens: list[str], classes: Classes) -> np.ndarray:
    got = list(map(classes.seen.get, tokens))
    if None in got:
        got = [classes(t) if k is None else k for t, k in zip(tokens, got, strict=True)]
    return np.array(got, np.int64)


def text_class(text: str) -> int:
    """File features: more or fewer than one assignment mark, and one digit,
    in a hundred characters."""
    n = max(len(text), 1)
    marks = text.count("=") + text.count(":")
    digits = sum(map(text.count, "0123456789"))
    return 2 * (100 * marks > n) + (100 * digits > n)


# --- the field --------------------------------------------------------------

B, I, O = 0, 1, 2  # noqa: E741
TAGS = 3
FORBIDDEN = -1e4  # I after O, or at the start


class Field(NamedTuple):
    own: np.ndarray    #: (classes, tags), as are the next three
    before: np.ndarray
    after: np.ndarray
    text: np.ndarray   #: (4, tags)
    step: np.ndarray   #: (tag, next tag)
    first: np.ndarray
    certain: float     #: by how much O must win to be O in every best path
    classes: Classes


def _step(raw: np.ndarray) -> np.ndarray:
    out = raw.copy()
    out[O, I] = FORBIDDEN
    return out


def _first(raw: np.ndarray) -> np.ndarray:
    out = raw.copy()
    out[I] = FORBIDDEN
    return out


def emissions(field: Field, c: np.ndarray, kind: int) -> np.ndarray:
    e = field.own[c] + field.text[kind]
    e[1:] += field.before[c[:-1]]
    e[:-1] += field.after[c[1:]]
    return e


def viterbi(e: np.ndarray, step: np.ndarray, first: np.ndarray) -> list[int]:
    """The best tags of one chain; of equal ones, that of the lowest tags from the end."""
    score, back = e[0] + first, []
    for row in e[1:]:
        through = score[:, None] + step
        back.append(through.argmax(axis=0))
        score = through.max(axis=0) + row
    tag = int(score.argmax())
    tags = [tag]
    for b in reversed(back):
        tag = int(b[tag])
        tags.append(tag)
    return tags[::-1]


def _certain(s: np.ndarray, first: np.ndarray) -> float:
    """How much O must win by so that no transitions can make up for it:
    the largest gain of any tag over O between any two neighbours. A tag I
    after the cut would follow O, so what follows is re-begun with B."""
    gains = [s[a, t] - s[a, O] + s[t, z] - s[O, z if z != I else B]
             for a in (B, I, O) for t in (B, I) for z in (B, I, O) if s[a, t] > FORBIDDEN / 2]
    edge = [first[B] - first[O] + s[B, z] - s[O, z if z != I else B] for z in (B, I, O)]
    return float(max([0.0, *gains, *edge, *(s[a, t] - s[a, O] for a in (B, I, O) for t in (B, I))]))


def tag(field: Field, c: np.ndarray, kind: int) -> list[tuple[int, int]]:
    """Runs of tokens (first, after the last) that the best path tags as a
    secret. Chains are cut at tokens that are O in every best path."""
    e = emissions(field, c, kind)
    # re-beginning with B what followed costs at most the gap of that token's B and I
    rebegin = np.append(np.maximum(e[1:, I] - e[1:, B], 0), 0)
    open_ = np.flatnonzero(e[:, O] - np.maximum(e[:, B], e[:, I]) <= field.certain + rebegin)
    out = []
    if not len(open_):
        return out
    for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
        lo, hi = int(run[0]), int(run[-1]) + 1
        # the neighbours are O: they stand in the chain with no other choice
        sub = e[max(lo - 1, 0):hi + 1].copy()
        if lo > 0:
            sub[0, [B, I]] = FORBIDDEN
        if hi < len(c):
            sub[-1, [B, I]] = FORBIDDEN
        first = field.first if lo == 0 else np.zeros(TAGS)
        tags = viterbi(sub, field.step, first)
        at = max(lo - 1, 0)
        begin = None
        for k, t in enumerate([*tags, O]):
            if begin is not None and t != I:
                out.append((begin + at, k + at))
                begin = None
            if t == B:
                begin = k
    return out


def crf_spans(field: Field | None, text: str) -> list[Span]:
    if field is None or not text:
        return []
    tokens, starts = split(text)
    c = classes_of(tokens, field.classes)
    return [(3, int(starts[a]), int(starts[b - 1]) + len(tokens[b - 1])) for a, b in tag(field, c, text_class(text))]


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans, and those of ``more`` that overlap none of them."""
    out = list(base)
    for s in more:
        if not any(s[1] < b[2] and b[1] < s[2] for b in base):
            out.append(s)
    return sorted(out, key=lambda s: (s[1], s[0]))


# --- training ---------------------------------------------------------------

def gold(text: str) -> tuple[list[str], list[int]]:
    """Tokens of a line and their tags: a base span's tokens are B, then I."""
    tokens, starts = split(text)
    tags = [O] * len(tokens)
    last = -1
    for _, s, e in base_spans(text):
        a = int(np.searchsorted(starts, s, side="right")) - 1
        b = int(np.searchsorted(starts, e - 1, side="right"))
        for i in range(a, b):
            if tags[i] == O:
                tags[i] = B if i == a else I
        last = max(last, b)
    return tokens, tags


def train(lines: list[tuple[str, int]]) -> Field | None:
    """A field from (line, class of its whole text)."""
    classes = Classes()
    chains = []
    for text, kind in lines:
        tokens, tags = gold(text)
        chains.append((classes_of(tokens, classes), kind, np.array(tags)))
    classes.frozen = True
    if not any((t != O).any() for _, _, t in chains):
        return None
    chains.sort(key=lambda x: len(x[0]))
    k = len(classes)
    p = {"own": np.zeros((k, TAGS)), "before": np.zeros((k, TAGS)), "after": np.zeros((k, TAGS)),
         "text": np.zeros((4, TAGS)), "step": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
    squares = {n: np.full_like(a, 1e-6) for n, a in p.items()}
    groups = [chains[i:i + 256] for i in range(0, len(chains), 256)]
    for _ in range(EPOCHS):
        for group in groups:
            g = _gradient(p, group)
            for n, a in p.items():
                grad = g[n] / len(group) + DECAY * a
                squares[n] += grad * grad
                a -= RATE * grad / np.sqrt(squares[n])
    step, first = _step(p["step"]), _first(p["first"])
    return Field(p["own"], p["before"], p["after"], p["text"], step, first, _certain(step, first), classes)


def _gradient(p, group) -> dict[str, np.ndarray]:
    """Expected minus observed features of a group of chains, by
    forward-backward over all of them side by side."""
    n, longest = len(group), max(len(c) for c, _, _ in group)
    c = np.zeros((n, longest), np.int64)
    live = np.zeros((n, longest), bool)
    y = np.full((n, longest), O)
    kind = np.array([k for _, k, _ in group])
    for i, (ci, _, ti) in enumerate(group):
        c[i, :len(ci)], live[i, :len(ci)], y[i, :len(ti)] = ci, True, ti
    e = p["own"][c] + p["text"][kind][:, None]
    e[:, 1:] += p["before"][c[:, :-1]]
    e[:, :-1] += np.where(live[:, 1:, None], p["after"][c[:, 1:]], 0)
    step, first = _step(p["step"]), _first(p["first"])
    top = lambda a, axis: np.log(np.exp(a - a.max(axis=axis, keepdims=True)).sum(axis=axis)) + a.max(axis=axis)
    f = np.empty_like(e)
    f[:, 0] = e[:, 0] + first
    for t in range(1, longest):
        new = top(f[:, t - 1, :, None] + step, 1) + e[:, t]
        f[:, t] = np.where(live[:, t, None], new, f[:, t - 1])
    b = np.zeros_like(e)
    for t in range(longest - 2, -1, -1):
        new = top(step + (e[:, t + 1] + b[:, t + 1])[:, None], 2)
        b[:, t] = np.where(live[:, t + 1, None], new, 0)
    z = top(f[:, -1], 1)
    m = np.exp(f + b - z[:, None, None]) * live[:, :, None]
    pair = np.exp(f[:, :-1, :, None] + step + (e[:, 1:] + b[:, 1:])[:, :, None] - z[:, None, None, None]) \
        * live[:, 1:, None, None]
    d = m - np.eye(TAGS)[y] * live[:, :, None]
    g = {x: np.zeros_like(p[x]) for x in p}
    np.add.at(g["own"], c, d)
    np.add.at(g["before"], c[:, :-1], d[:, 1:])
    np.add.at(g["after"], c[:, 1:], d[:, :-1] * live[:, 1:, None])
    np.add.at(g["text"], kind, d.sum(axis=1))
    g["step"] = pair.sum(axis=(0, 1))
    np.add.at(g["step"], (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), -1)
    g["first"] = d[:, 0].sum(axis=0)
    return g


def windows(line: str, spans: list[Span]) -> list[str]:
    """A line for training; of one longer than LINE_CHARS, a stretch around
    each of its spans (of one without, around its middle), cut between tokens
    where there is white space near its ends."""
    if len(line) <= LINE_CHARS:
        return [line]
    out, done = [], 0
    for start, end in sorted((s, e) for _, s, e in spans) or [(len(line) // 2, len(line) // 2)]:
        if start < done:
            continue  # stands in the stretch before
        a, b = max(0, start - LINE_CHARS // 4), min(len(line), end + LINE_CHARS // 4)
        gap = re.compile(r"\s")
        if a and (m := gap.search(line, a, start)):
            a = m.end()
        if b < len(line):
            cuts = [m.start() for m in gap.finditer(line, end, b)]
            b = cuts[-1] if cuts else b
        out.append(line[a:b])
        done = b
    return [x for x in out if x]


def fit(docs: DataFrame) -> Field | None:
    """A field from at most TRAIN_LINES lines with a base span and as many
    without, those with the smallest hash; long lines come in stretches."""
    lines = fitted(docs, text="string")

    def cut(batches):
        for batch in batches:
            text, kind, has = [], [], []
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                k = text_class(t)
                some = bool(base_spans(t))
                parts = t.split("\n")
                # of a text without secrets, one line; its choice follows the text
                for line in parts if some else [parts[len(t) % len(parts)]]:
                    for x in windows(line, base_spans(line) if some and len(line) > LINE_CHARS else []) if line else ():
                        text.append(x)
                        kind.append(k)
                        has.append(some and bool(base_spans(x)))
            yield pa.RecordBatch.from_pydict({"text": pa.array(text, pa.string()), "kind": pa.array(kind, pa.int32()),
                                              "has": pa.array(has, pa.bool_())})

    # a line that many texts share counts once
    cuts = (lines.mapInArrow(released(cut), "text string, kind int, has boolean").withColumn("h", F.xxhash64("text", "kind"))
            .groupBy("has", "h").agg(F.min("text").alias("text"), F.min("kind").alias("kind")))
    chosen = None
    for has in (True, False):
        part = cuts.where(F.col("has") == has).orderBy("h", "text", "kind").limit(TRAIN_LINES)
        chosen = part if chosen is None else chosen.unionByName(part)
    return train([(r["text"], r["kind"]) for r in chosen.select("text", "kind").collect()])


# --- scanning ---------------------------------------------------------------

def all_spans(field: Field | None, text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a whole text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, merged(base, crf_spans(field, text))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_secrets(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base and spans (both as
    kind:start:end by start, then kind; code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # of bounded size

    def make(column):
        found = [all_spans(shared.value, t) for t in column.to_pylist()]
        return [*(pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in range(3)),
                pa.array([listed(b) for b, _ in found], pa.string()),
                pa.array([listed(a) for _, a in found], pa.string())]

    return extended(docs, text, {"n_assign": "long", "n_access": "long", "n_hex": "long",
                                 "base": "string", "spans": "string"}, make)


def redact(text: str | None, listed: str, mark: str = "[SECRET]") -> str | None:
    """``text`` with every span of ``listed`` (as in ``spans``) replaced."""
    if not text or not listed:
        return text
    out, at = [], 0
    for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in listed.split(",")):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])
