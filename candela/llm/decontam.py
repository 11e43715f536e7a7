"""Benchmark decontamination by a positional inverted index (operator 5).

``build_index`` stores, for every segment of the corpus (about half a megabyte
of whole documents), the sorted positions of each word: postings partitioned by
document, as in a sharded search engine, so building needs no shuffle and a
word of any frequency is split over all segments. Documents are set apart by a
gap in the positions, so that no match crosses them.

``search`` runs the test items' windows against every segment: the lists of a
window's words, each shifted back by the word's offset, are intersected from
the rarest word of the segment on; what is left are the exact occurrences.
Proximity matches ask that all words of a window lie in a stretch of ``slop``
words more than the window, in any order.

The test items are a stated query set: they go to the tasks in blocks of about
``BLOCK_CHARS`` characters, one pass over the stored index each. With a single
block the index holds the postings of its words alone, else of every word.

Defined cases: null or empty texts have no words and are never hit; an item
without words matches nothing; a null item_id marks hits but is not counted
among items; items that share an id count once; repeated document rows are
judged each; empty tables give no rows, or no hits; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.store import fitted, released, staged
from candela.llm.text import ALNUM, chunks, words

BLOCK_CHARS = 2_000_000
SEGMENT_BYTES = 1 << 19
GAP = 64

_INDEX = "segment long, doc_ids array<long>, first binary, terms binary, counts binary, positions binary"
_ROW = pa.schema([("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                  *((c, pa.binary()) for c in ("first", "terms", "counts", "positions"))])


def _shuffled(a: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, which the file format compresses well."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unshuffled(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text), a row per segment: document
    ids, words before each document,
    terms (64-bit word hashes, ascending),
    postings of each, and all positions as differences. ``vocabulary`` keeps
    the postings of those terms only."""
    def segments(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(1), SEGMENT_BYTES):
                w = words(buf, offs, ALNUM)
                n = np.diff(w.first)
                at = np.arange(len(w.hashes)) + GAP * np.repeat(np.arange(hi - lo), n)
                h = w.hashes
                if vocabulary is not None:
                    i = np.minimum(np.searchsorted(vocabulary, h), max(len(vocabulary) - 1, 0))
                    known = vocabulary[i] == h if len(vocabulary) else np.zeros(len(h), bool)
                    at, i = at[known], i[known]
                    terms = vocabulary
                else:
                    terms, i = np.unique(h, return_inverse=True)
                order = np.argsort(i.astype(np.uint16) if len(terms) < 1 << 16 else i, kind="stable")
                counts = np.bincount(i, minlength=len(terms))
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({
                    "segment": [number], "doc_ids": [batch.column(0).slice(lo, hi - lo).to_pylist()],
                    "first": [w.first.astype("<i8").tobytes()], "terms": [terms[seen].astype("<u8").tobytes()],
                    "counts": [counts[seen].astype("<u4").tobytes()],
                    "positions": [_shuffled(np.diff(at[order], prepend=0))]}, schema=_ROW)
                number += 1

    return staged(fitted(docs, doc_id="long", text="string").mapInArrow(released(segments), _INDEX), "postings")


class Items:
    """Windows of test items: word hashes, and the items that hold each."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int):
        ids = [r[0] for r in rows]
        self.names = sorted({x for x in ids if x is not None})
        number = {x: i for i, x in enumerate(self.names)}
        holds: dict[tuple[int, ...], set[int]] = {}
        column = pa.array([r[1] for r in rows], pa.string())
        for lo, hi, buf, offs in chunks(column):
            w = words(buf, offs, ALNUM)
            for d in range(hi - lo):
                h = w.hashes[w.first[d]:w.first[d + 1]].tolist()
                for s in range(max(1, len(h) - window + 1) if h else 0):
                    holds.setdefault(tuple(h[s:s + window]), set()).add(number.get(ids[lo + d], -1))
        self.vocabulary = np.unique(np.array([x for k in holds for x in k], np.uint64))
        self.groups = []  # (length, words of each window as vocabulary numbers, items of each)
        for size in sorted({len(k) for k in holds}):
            keys = [k for k in holds if len(k) == size]
            self.groups.append((size, np.searchsorted(self.vocabulary, np.array(keys, np.uint64)),
                                [sorted(holds[k] - {-1}) for k in keys]))


class Segment:
    """The postings of one stored row, by vocabulary number."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        self.first = np.frombuffer(row["first"], "<i8")
        n = len(self.first) - 1
        self.begin = self.first[:-1] + GAP * np.arange(n)
        terms = np.frombuffer(row["terms"], "<u8")
        counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        at = np.append(0, np.cumsum(counts))
        # differences start anew, possibly downwards, at each term: 32-bit wrap-around undoes it
        self.positions = np.cumsum(_unshuffled(row["positions"]), dtype=np.uint32).astype(np.int64)
        i = np.minimum(np.searchsorted(terms, vocabulary), max(len(terms) - 1, 0))
        known = terms[i] == vocabulary if len(terms) else np.zeros(len(vocabulary), bool)
        self.lo = np.where(known, at[i], 0)
        self.counts = np.where(known, counts[i] if len(terms) else 0, 0)

    def list(self, term: int) -> np.ndarray:
        return self.positions[self.lo[term]:self.lo[term] + self.counts[term]]

    def exact(self, window: np.ndarray) -> np.ndarray:
        """Positions where the window starts: lists intersected from the rarest term on."""
        starts = None
        for j in np.argsort(self.counts[window], kind="stable").tolist():
            p = self.list(window[j])
            if starts is None:
                starts = p - j
            else:
                i = np.searchsorted(p, starts + j)
                starts = starts[(i < len(p)) & (p[np.minimum(i, len(p) - 1)] == starts + j)]
            if not len(starts):
                break
        return starts

    def near(self, window: np.ndarray, stretch: int) -> np.ndarray:
        """Starts of stretches of ``stretch`` words that hold all words of the window."""
        terms = np.unique(window)
        terms = terms[np.argsort(self.counts[terms], kind="stable")].tolist()
        starts = np.unique((self.list(terms[0])[:, None] - np.arange(stretch)).ravel())
        for t in terms[1:]:
            p = self.list(t)
            i = np.searchsorted(p, starts)
            starts = starts[(i < len(p)) & (p[np.minimum(i, len(p) - 1)] < starts + stretch)]
            if not len(starts):
                break
        return starts


def _search_block(index: DataFrame, items: Items, slop: int | None) -> DataFrame:
    """Matches of one block of items, a row per document."""
    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(row, items.vocabulary)
                n = len(seg.first) - 1
                cover = np.zeros(int(seg.first[-1]) + GAP * n + 2, np.int64)
                exact: list[set[int]] = [set() for _ in range(n)]
                near: list[set[int]] = [set() for _ in range(n)]

                def held(found, at, holders):
                    for d in np.unique(np.searchsorted(seg.begin, at, side="right") - 1).tolist():
                        found[d].update(holders)

                for length, windows, holders in items.groups:
                    for k in np.flatnonzero((seg.counts[windows] > 0).all(axis=1)).tolist():
                        starts = seg.exact(windows[k])
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, starts + length, -1)
                        held(exact, starts, holders[k])
                        if slop is not None:
                            held(near, seg.near(windows[k], length + slop) + length + slop - 1, holders[k])
                covered = np.flatnonzero(np.cumsum(cover) > 0)
                hits = np.split(covered, np.searchsorted(covered, seg.begin[1:]))
                names = [[items.names[i] for i in sorted(x)] for x in exact]
                yield pa.RecordBatch.from_pydict({
                    "segment": np.full(n, row["segment"], np.int64), "nth": np.arange(n), "doc_id": row["doc_ids"],
                    "n_words": np.diff(seg.first), "hits": [x - b for x, b in zip(hits, seg.begin, strict=True)],
                    "items": names, "near": [[items.names[i] for i in sorted(x)] for x in near]}, schema=_FOUND)

    return index.mapInArrow(released(search), "segment long, nth long, doc_id long, n_words long, hits array<long>, items array<string>, near array<string>")


_FOUND = pa.schema([("segment", pa.int64()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string()))])


def match_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int | None = 2) -> DataFrame:
    """A row per document: doc_id, n_words, hits (numbers of the words inside
    an occurrence of a window), items and near (ids, as strings, of the items
    with an exact, or proximity, match; ``slop`` None: no proximity search)."""
    if window + (slop or 0) > GAP:
        raise ValueError(f"a window and its slop may not exceed {GAP} words")
    tests = fitted(benchmark, item_id="string", text="string")
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_CHARS) or 1
    # one block of the stated query set at a time: at most about BLOCK_CHARS of it stand on the driver
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    load = lambda b: Items([tuple(r) for r in tests.where(block == b).collect()], window)
    if blocks == 1:
        items = load(0)
        return _search_block(build_index(docs, items.vocabulary), items, slop).drop("segment", "nth")
    index = build_index(docs)
    found = None
    for b in range(blocks):
        part = _search_block(index, load(b), slop)
        found = part if found is None else found.unionByName(part)
    ids = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("segment", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), ids("hits"), ids("items"),
        ids("near")).drop("segment", "nth")


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"))
