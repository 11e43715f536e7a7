"""Removal of long repeated byte strings with a run-length index (operator 4).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in whatever document, is removed.

1. *Anchors.* The anchor of a string is its leftmost 32-byte piece with the
   smallest hash, so equal strings have equal anchors at the same place, and
   the starts of a document fall into ranges with one anchor each. A range's
   *segment* are the bytes of all its strings. Documents are read once and
   give a small row for each range, or run of equal ranges.
2. *Groups.* Only segments whose anchor occurs again can hold a repeat.
   Segments that occur twice or more are repeats as a whole. Of groups with
   several segments, near copies around an edit, those go on that share a
   *core* with another: the starts of a range fall into parts of CORE_STARTS by
   their distance from the anchor, and a part's core are the bytes that all its
   strings have in common, so equal strings have equal cores.
3. *Index.* The distinct segments of such groups, one text per shard, get a
   run-length compressed Burrows-Wheeler transform with the text positions at
   both ends of every run. Matching statistics of the text against itself are
   streamed from these samples: along the text, the longest match with the
   lexicographic neighbour falls by one from byte to byte, except where the
   transform begins (or, for the other neighbour, ends) a run, and there the
   sample says where to compare. Matches of ``length`` or more are marked.
4. Marks come back to every occurrence, and each document to its spans.

A group with more than HOT_SEGMENTS distinct segments is split before it meets
in a task: its starts into parts of WIDTHS[0] by their distance from the
anchor, grouped by a hash of the bytes that all strings of the part share,
which equal strings have in common as well. Parts that occur twice or more are
repeats as a whole, and one of each stands for all in the index. A group that
still has more than HOT_SEGMENTS distinct parts (those at the ends of a shared
passage, where every document goes on differently) is split again, by the next
of WIDTHS, down to single starts: strings of ``length``, which counts by their
hashes settle without an index.

The texts are shuffled once, into a table bucketed by two hashes of the row;
lists of ranges come to it by these, whatever their size.

Defined cases: a null or empty text has no bytes; a document is a row: repeated
rows, and rows that share a doc_id, repeat one another; a null doc_id stays
null; empty tables give no rows; other columns are ignored. Segments, parts
and the strings of a split group are told apart by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.store import fitted, released, shared_dir, staged
from candela.llm.text import _VALUE, _pow, chunks, mix

PIECE = 32
HOT_SEGMENTS = 512
WIDTHS = (32, 8, 1)
#: starts of a part that is asked for a core in common
CORE_STARTS = 64
#: text of one index, which a core's own cache holds while it is sorted
SHARD_BYTES = 1 << 17

_POSITION_BITS = 28
_PART = {"f": "long", "s": "long", "at": "int", "k1": "long", "k2": "long", "q": "int", "lo": "int", "hi": "int",
         "g": "long", "c1": "long", "c2": "long"}


def _sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _pow(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUE[buf] * power[:len(buf)], out=sums[1:])
    return sums, inverse


def _hash(sums, inverse, a, b) -> np.ndarray:
    """Hash of the bytes from a to b, for arrays of positions."""
    return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _cores(sums, inverse, q, lo, hi, length: int) -> tuple[np.ndarray, np.ndarray]:
    width = max(1, min(CORE_STARTS, length - PIECE))
    near = (q - hi) // width
    each = (q - lo) // width - near + 1
    first = np.append(0, np.cumsum(each))
    of = np.repeat(np.arange(len(q)), each)
    part = near[of] + np.arange(first[-1]) - first[of]  # by the distance from the anchor
    at = q[of] - part * width
    core = _hash(sums, inverse, at, at - width + 1 + length)
    return mix(core + part.astype(np.uint64)).astype(np.uint32).view(np.int32), first


def anchors(buf: np.ndarray, offs: np.ndarray, length: int):
    """Anchor position, first start, last start, anchor hash, segment hash and
    document of every range of starts in a chunk, and the 32-bit hashes of the
    cores of all ranges with the place of each range's first, one more at the end."""
    n, window = len(buf), length - PIECE + 1
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64), z, z.astype(np.int32), np.zeros(1, np.int64)
    sums, inverse = _sums(buf)
    at = np.arange(n - PIECE + 1)
    h = _hash(sums, inverse, at, at + PIECE)
    # the smallest hash, of equal ones the leftmost, in every window: the
    # smaller of a running minimum from the left and one from the right
    key = (h >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | at.astype(np.uint64)
    blocks = -(-len(key) // window)
    key = np.append(key, np.full(blocks * window - len(key), np.iinfo(np.uint64).max)).reshape(blocks, window)
    left = np.minimum.accumulate(key, axis=1).ravel()
    right = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    best = np.minimum(right[:starts], left[window - 1:window - 1 + starts]) & np.uint64((1 << _POSITION_BITS) - 1)
    best = best.astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:starts]
    valid = np.flatnonzero(offs[doc + 1] - np.arange(starts) >= length)
    best, doc = best[valid], doc[valid]
    if not len(valid):
        return best, best, best, best.astype(np.uint64), best.astype(np.uint64), doc, best.astype(np.int32), np.zeros(1, np.int64)
    # the anchors of two documents differ, as they lie inside them
    new = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    q, lo, hi = best[new], valid[new], valid[np.append(new[1:], len(valid)) - 1]
    return q, lo, hi, h[q], _hash(sums, inverse, lo, hi + length), doc[new], *_cores(sums, inverse, q, lo, hi, length)


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of byte strings, with
    the text positions of both ends of every run."""

    BASE = 7  # symbols of nine bits in a first key

    def __init__(self, strings: list[bytes]):
        lens = np.array([len(s) for s in strings])
        self.begin = np.append(0, np.cumsum(lens + 1))
        n = int(self.begin[-1])
        symbol = np.zeros(n + self.BASE, np.int64)  # 0 ends a string
        live = np.ones(n, bool)
        live[self.begin[1:] - 1] = False
        symbol[:n][live] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        self.symbol, self.n = symbol, n
        string = np.repeat(np.arange(len(strings)), lens + 1)
        order = self._sort(string, int(lens.max(initial=0)) + 1)
        # ends of strings differ from each other, in the transform too
        before = np.where(np.append(0, symbol[:n - 1]) > 0, np.append(0, symbol[:n - 1]), -1 - string)[order]
        head = np.append(True, before[1:] != before[:-1])
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], n) - 1
        self.run_symbols, self.run_lengths = before[heads], np.diff(np.append(heads, n))
        # samples: (position at a run's end, its lexicographic neighbour outside the run)
        self.head_samples = np.stack([order[heads[1:]], order[heads[1:] - 1]])
        self.tail_samples = np.stack([order[tails[:-1]], order[tails[:-1] + 1]])

    def _sort(self, string: np.ndarray, longest: int) -> np.ndarray:
        """Suffix order by doubling; the ranks of every depth stay for ``match``.
        A rank is the place of the first suffix that shares it, and only shared
        ones are sorted on."""
        n, symbol = self.n, self.symbol
        key, alive = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(self.BASE):
            s = np.where(alive, symbol[j:n + j], 0)
            alive &= s > 0
            key = key << 9 | s
        order = np.argsort(key)
        # suffixes with one key have all ended, or none has; ended ones go by their string
        ended = np.flatnonzero(~alive)
        order[~alive[order]] = ended[np.lexsort((string[ended], key[ended]))]
        head = np.append(True, (np.diff(key[order]) != 0) | ~alive[order[1:]])[:n]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        self.levels, depth = [(self.BASE, rank)], self.BASE
        open_ = order[~(head & np.append(head[1:], True)[:n])]
        while len(open_):
            # an ended suffix has a rank of its own; the others have `depth` symbols before their end
            key = rank[open_] * n + rank[np.minimum(open_ + depth, n - 1)]
            by = np.argsort(key)
            open_, key = open_[by], key[by]
            group, at = rank[open_], np.arange(len(open_))
            head = np.append(True, np.diff(key) != 0)
            first = np.append(True, np.diff(group) != 0)
            rank = rank.copy()
            rank[open_] = group + np.maximum.accumulate(np.where(head, at, 0)) - np.maximum.accumulate(np.where(first, at, 0))
            depth *= 2
            self.levels.append((depth, rank))
            open_ = open_[~(head & np.append(head[1:], True))]
        out = np.empty(n, np.int64)
        out[rank] = np.arange(n)
        return out

    def match(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at p and q."""
        done = np.zeros(len(p), np.int64)
        last = self.n - 1
        for depth, rank in reversed(self.levels):
            same = rank[np.minimum(p + done, last)] == rank[np.minimum(q + done, last)]
            done += depth * same
        going = np.ones(len(p), bool)
        for _ in range(self.BASE):
            a, b = self.symbol[np.minimum(p + done, last)], self.symbol[np.minimum(q + done, last)]
            going &= (a == b) & (a > 0)
            done += going
        return done

    def repeated(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last starts, in the text, of strings of ``length`` that
        occur again: matching statistics streamed from the samples. After a
        sample the match falls by one with every byte until the next one."""
        first, last = [], []
        for p, q in (self.head_samples, self.tail_samples):
            m = self.match(p, q)
            some = m >= length
            first.append(p[some])
            last.append(p[some] + m[some] - length)
        return np.concatenate(first), np.concatenate(last)


def _merge(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of closed ranges; touching ones join."""
    if not len(first):
        return first, last
    by = np.argsort(first, kind="stable")
    first, last = first[by], np.maximum.accumulate(last[by])
    new = np.append(True, first[1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    return first[at], last[np.append(at[1:], len(first)) - 1]


def _bucketed(docs: DataFrame) -> DataFrame:
    """``docs`` with two hashes that name a row's content, in buckets by them:
    a join by these hashes does not shuffle the texts again."""
    spark = docs.sparkSession
    name, buckets = f"repeats_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"),
                        F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"))
    # rows are dealt first, so that each bucket is one file
    (keyed.repartition(buckets, "k1", "k2").write.bucketBy(buckets, "k1", "k2")
     .option("path", shared_dir(spark, "texts")).option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def _onto_texts(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """The bucketed ``docs`` joined with a row of ``lists`` (k1, k2, ranges) each."""
    return docs.join(lists.hint("shuffle_hash"), ["k1", "k2"], how)


def _ranges(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(0)):
                q, first, last, f, s, doc, cores, place = anchors(buf, offs, length)
                # a periodic text repeats a range at once: one row for the run
                again = (f[1:] == f[:-1]) & (s[1:] == s[:-1]) & (doc[1:] == doc[:-1]) & (first[1:] == last[:-1] + 1)
                runs = np.flatnonzero(np.append(True, ~again)[:len(f)])
                stop = np.append(runs[1:], len(f)) if len(f) else runs
                ends, times = last[stop - 1], stop - runs
                q, first, last, f, s, doc = (x[runs] for x in (q, first, last, f, s, doc))
                each = np.diff(place)[runs]
                to = np.append(0, np.cumsum(each))
                cores = cores[np.repeat(place[runs] - to[:-1], each) + np.arange(to[-1])]
                rows = pa.array(lo + doc)
                base = offs[doc]
                yield pa.RecordBatch.from_pydict({
                    "f": f.view(np.int64), "s": s.view(np.int64), "k1": batch.column(1).take(rows),
                    "k2": batch.column(2).take(rows), "q": (q - base).astype(np.int32),
                    "lo": (first - base).astype(np.int32), "hi": (last - base).astype(np.int32),
                    "end": (ends - base).astype(np.int32), "times": times.astype(np.int32),
                    "cores": pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(cores))})

    return docs.select("text", "k1", "k2").mapInArrow(
        released(run), "f long, s long, k1 long, k2 long, q int, lo int, hi int, end int, times int, cores array<int>")


def _segments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted segments or parts (g, f, s, k1, k2, lo, hi): group
    g, f, s, bytes."""
    def run(batches):
        seen = set()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("g", "f", "s", "bytes")}
            for text, ranges, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tuple(key) in seen:  # equal rows give equal segments
                    continue
                seen.add(tuple(key))
                raw = text.encode()
                for r in ranges:
                    for c, v in (("g", r["g"]), ("f", r["f"]), ("s", r["s"]), ("bytes", raw[r["lo"]:r["hi"] + length])):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("g", pa.int64()), ("f", pa.int64()), ("s", pa.int64()), ("bytes", pa.binary())]))

    met = _onto_texts(docs, wanted.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("g", "f", "s", "lo", "hi")).alias("ranges")), "inner")
    return met.select("text", "ranges", "k1", "k2").mapInArrow(released(run), "g long, f long, s long, bytes binary")


def _split(docs: DataFrame, wanted: DataFrame, length: int, width: int) -> DataFrame:
    """The wanted segments or parts (group, f, s, k1, k2, q, lo, hi) cut into parts
    of ``width`` starts by their distance from the anchor: f, s, at (the part's
    first start in what it is cut from), the part's place k1, k2, q, lo, hi, the
    group g that equal strings of a ``group`` have in common, and c1, c2, which
    name the part's bytes."""
    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in _PART}
            for text, k1, k2, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                sums, inverse = _sums(np.frombuffer(raw, np.uint8))
                for r in ranges:
                    far, near = r["q"] - r["lo"], r["q"] - r["hi"]  # distances from the anchor
                    d = np.arange(near // width, far // width + 1)
                    d1, d2 = r["q"] - d * width, r["q"] - (d + 1) * width + 1
                    lo, hi = np.maximum(r["lo"], d2), np.minimum(r["hi"], d1)
                    core = _hash(sums, inverse, d1, d2 + length)
                    out["g"] += (mix(core + d.astype(np.uint64)).view(np.int64) ^ r["group"]).tolist()
                    out["c1"] += _hash(sums, inverse, lo, hi + length).view(np.int64).tolist()
                    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                        name = hashlib.blake2b(raw[a:b + length], digest_size=8).digest()
                        for c, v in (("c2", int.from_bytes(name, "little", signed=True)), ("f", r["f"]), ("s", r["s"]),
                                     ("at", a - r["lo"]), ("k1", k1), ("k2", k2), ("q", r["q"]), ("lo", a), ("hi", b)):
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int32() if k == "int" else pa.int64()) for c, k in _PART.items()]))

    met = _onto_texts(docs, wanted.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("group", "f", "s", "q", "lo", "hi")).alias("ranges")), "inner")
    # equal rows give equal parts
    return met.dropDuplicates(["k1", "k2"]).select("text", "k1", "k2", "ranges").mapInArrow(
        released(run), ", ".join(f"{c} {k}" for c, k in _PART.items()))


def _owned(parts: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks (f, s, first, last) of what ``parts`` were cut from, by marks
    that name the parts' bytes in the same columns."""
    named = marks.select(F.col("f").alias("c1"), F.col("s").alias("c2"), "first", "last")
    return parts.select("f", "s", "at", "c1", "c2").join(named, ["c1", "c2"]).select(
        "f", "s", (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last")).alias("last"))


def _hot_marks(docs: DataFrame, wanted: DataFrame, length: int, widths: tuple[int, ...] | None = None) -> DataFrame:
    """What ``_marks`` gives, for the segments or parts (group, f, s, k1, k2, q,
    lo, hi) of hot groups: no task meets more than HOT_SEGMENTS parts of a group."""
    width, *narrower = widths or WIDTHS
    parts = staged(_split(docs, wanted, length, width), "parts")
    kinds = staged(parts.groupBy("g", "c1", "c2").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2", "q", "lo", "hi")).alias("r"))
                   .select("g", F.col("c1").alias("f"), F.col("c2").alias("s"), "m", "r.*"), "kinds")
    found = kinds.where("m > 1").select("f", "s", F.lit(0).cast("long").alias("first"), (F.col("hi") - F.col("lo")).cast("long").alias("last"))
    if narrower:  # single starts are settled by their counts
        sizes = kinds.groupBy("g").agg(F.count("*").alias("k"))
        # of more than HOT_SEGMENTS rows each, so few
        hot = staged(sizes.where(F.col("k") > HOT_SEGMENTS).select("g"), "hot")
        calm = kinds.join(F.broadcast(hot), "g", "left_anti").join(sizes.where(F.col("k").between(2, HOT_SEGMENTS)).select("g"), "g")
        found = found.union(_marks(_segments(docs, calm, length), length))
        if not hot.isEmpty():
            found = found.union(_hot_marks(docs, kinds.join(F.broadcast(hot), "g", "left_semi").withColumnRenamed("g", "group"), length, tuple(narrower)))
    return _owned(parts, staged(found, "found"))


def _marks(segments: DataFrame, length: int) -> DataFrame:
    """f, s, first, last: starts of segments, by their place, that are
    repeated in the segment's group. Whole groups make one index after another."""
    def run(batches):
        held: list[tuple[int, int, bytes]] = []
        size, group = 0, None

        def marked():
            index = RunLengthIndex([x[2] for x in held])
            first, last = index.repeated(length)
            owner = np.searchsorted(index.begin, first, side="right") - 1
            base = index.begin[owner]
            return pa.RecordBatch.from_pydict({
                "f": np.array([x[0] for x in held])[owner], "s": np.array([x[1] for x in held])[owner],
                "first": first - base, "last": last - base})

        for batch in batches:
            for g, f, s, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != group and size >= SHARD_BYTES:
                    yield marked()
                    held, size = [], 0
                if group == g and held and held[-1][:2] == (f, s):  # of equal rows in two tasks
                    continue
                group = g
                held.append((f, s, raw))
                size += len(raw)
        if held:
            yield marked()

    return segments.repartition("g").sortWithinPartitions("g", "f", "s").mapInArrow(released(run), "f long, s long, first long, last long")


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """k1, k2, ranges (first byte, byte after the last): what is removed of
    the bucketed documents that hold repeats, by the rows' hashes."""
    # written once; counts by anchor combine in the tasks, and the join back may split a hot anchor
    dealt = staged(_ranges(docs, length), "all-ranges")
    twice = dealt.groupBy("f").agg(F.sum("times").alias("k"), F.min("s").alias("a"), F.max("s").alias("b")).where("k > 1")
    shared = staged(dealt.join(twice.select("f", (F.col("a") != F.col("b")).alias("mixed")), "f")
                    .withColumn("cores", F.when(F.col("mixed"), F.col("cores"))), "ranges")
    kinds = shared.groupBy("f", "s").agg(F.sum("times").alias("m"))
    whole = shared.join(kinds.where("m > 1").select("f", "s"), ["f", "s"]).select(
        "k1", "k2", F.col("lo").cast("long").alias("a"), (F.col("end") + length).cast("long").alias("b"))
    # one occurrence of each segment of a mixed group stands for all
    one = staged(shared.where("mixed").groupBy("f", "s").agg(F.min(F.struct("k1", "k2", "lo", "hi", "q", "cores")).alias("r"))
                 .select(F.col("f").alias("g"), "f", "s", "r.*"), "segments")
    held = one.select("f", "s", F.explode("cores").alias("core"))
    common = held.groupBy("f", "core").agg(F.count("*").alias("n")).where("n > 1").select("f", "core")
    likely = held.join(common, ["f", "core"], "left_semi").select("f", "s").distinct()
    one = staged(one.drop("cores").join(likely, ["f", "s"], "left_semi"), "likely")
    # of more than HOT_SEGMENTS rows each, so few
    hot = staged(one.groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") > HOT_SEGMENTS).select("f"), "hot")
    calm = one.join(F.broadcast(hot), "f", "left_anti")
    marks = _marks(_segments(docs, calm, length), length)
    if not hot.isEmpty():
        marks = marks.union(_hot_marks(docs, one.join(F.broadcast(hot), "f", "left_semi").withColumnRenamed("g", "group"), length))
    marks = staged(marks, "marks")
    part = shared.join(marks, ["f", "s"]).select(
        "k1", "k2", (F.col("lo") + F.col("first")).alias("a"), (F.col("lo") + F.col("last") + length).alias("b"))
    return staged(whole.union(part).groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("ranges")), "spans")


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining
    bytes) of every row of ``docs`` (doc_id, text)."""
    docs = _bucketed(fitted(docs, doc_id="long", text="string"))
    met = _onto_texts(docs, repeated_spans(docs, length), "left")

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                first, last = _merge(np.array([r["a"] for r in ranges or ()], np.int64),
                                     np.array([r["b"] - 1 for r in ranges or ()], np.int64))
                kept, at = [], 0
                for a, b in zip(first.tolist(), last.tolist(), strict=True):
                    kept.append(raw[at:a])
                    at = b + 1
                left = b"".join([*kept, raw[at:]])
                for c, v in (("n_bytes", len(raw)), ("n_removed", len(raw) - len(left)), ("n_spans", len(first)),
                             ("kept_sha256", hashlib.sha256(left).hexdigest()), ("kept", left)):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                 pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())],
                names=["doc_id", *out])

    return met.select("doc_id", "text", "ranges").mapInArrow(released(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
