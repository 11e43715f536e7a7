"""Phrases of two to five words that occur more often than their parts would
have it, mined with counting quotient filters.

1. **Words.**  Tasks count the words of their texts per language; words with at
   least ``least`` occurrences get a number.  A phrase with that many
   occurrences has no other words, so all others only interrupt.
2. **Runs.**  Texts become word numbers (0 between pieces and in place of other
   words), written down once.
3. **Filters.**  The numbers of an n-gram are packed into one whole number, and a
   Feistel network permutes it invertibly.  Its upper bits are the quotient, the
   rest the remainder, kept in full: a filter stores, for quotients in order,
   the remainders and an exact count of each, so nothing is approximate and
   every n-gram can be read back.  Tasks cut their filters by ranges of
   quotients; a range's filters from all tasks are merged in order.  Ranges are
   as many as the n-grams ask for, and the permutation spreads frequent phrases
   over all of them.
4. **Levels.**  n-grams are counted only where both (n-1)-grams within reached
   ``least``.  A bitmap of bounded size says so; where it errs, it lets an n-gram
   through that the exact count drops.
5. **Scores** are joins over the counted phrases: every cut of a candidate looks
   up its two parts.  A phrase inside a longer one with the same count is inside
   one that is longer by a single word with that count, so only those are looked
   at.

Defined results: null texts are empty, a null language is ``und``; empty texts
and empty tables give no phrase.  Repeated rows count as often as they stand
there.  Other columns of the table are not read.  Ties beyond score and count
are settled by the phrase.  Very long texts are read in chunks as whole texts;
a phrase never crosses a document.

Limits: words are looked up by 64-bit hashes (two frequent words with the same
one are an error, never a wrong count), and word numbers have at most 25 bits,
33 million words with ``least`` occurrences; more is an error.  The word
table goes to the tasks in blocks of ``WORDS_AT_ONCE``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.store import fitted, numbered, released, staged
from candela.llm.text import LOWER, chunks, mix, words

UNKNOWN = "und"
LONGEST = 5
#: bytes that part pieces, and those that part words
PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
IN_WORD = ~PIECE_END
IN_WORD[[0x20, 0x09]] = False

WORDS_AT_ONCE = 4_000_000
MOST_NUMBER_BITS = 25
#: bytes of texts whose word numbers are a row
RUN_BYTES = 1 << 16
#: n-grams a task counts before it writes a filter, and those of a range of quotients
GRAMS_AT_ONCE = 4_000_000
GRAMS_A_RANGE = 2_000_000
LEAST_RANGES = 48
#: bits of the bitmap of frequent n-grams: 16 for each, at most these (32 MiB)
BITMAP_BITS = 1 << 28
#: of each language, phrases kept by every part of a split ranking
RANK_PARTS = 64

U = np.uint64


# --- words -------------------------------------------------------------------

def _language_keys(column: pa.Array) -> tuple[list[str], np.ndarray]:
    langs = column.fill_null(UNKNOWN).dictionary_encode()
    return langs.dictionary.to_pylist(), np.asarray(langs.indices, np.int64)


def _spelled(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at the given places as strings, A-Z in lower case."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    data = LOWER[buf[at]]
    return pa.Array.from_buffers(pa.large_string(), len(size), [
        None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, hash, n) of all words."""
    def run(batches):
        for batch in batches:
            names, codes = _language_keys(batch.column(1))
            for lo, hi, buf, offsets in chunks(batch.column(0)):
                w = words(buf, offsets, IN_WORD)
                lang = np.repeat(codes[lo:hi], np.diff(w.first))
                for k in np.unique(lang).tolist():
                    mine = np.flatnonzero(lang == k)
                    hashes, first, n = np.unique(w.hashes[mine], return_index=True, return_counts=True)
                    at = mine[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k]] * len(n), pa.string()), _spelled(buf, w.starts[at], w.ends[at]),
                         pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "word", "hash", "n"])

    counted = docs.mapInArrow(released(run), "lang string, word string, hash long, n long")
    return counted.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


class Dictionary(NamedTuple):
    """A block of the word table, sorted by key."""
    keys: np.ndarray     #: uint64, hash of language and word
    numbers: np.ndarray  #: uint32


def word_key(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Hash of a language's words; a name is hashed unlike a word."""
    name = f"\n{lang}".encode()
    w = words(np.frombuffer(name, np.uint8), np.array([0, len(name)]), np.ones(256, bool))
    return mix(hashes ^ w.hashes[0])


def dictionary_blocks(table: DataFrame, size: int):
    """The word table, at most about WORDS_AT_ONCE words at a time."""
    blocks = max(1, -(-size // WORDS_AT_ONCE))
    for k in range(blocks):
        part = table if blocks == 1 else table.where(F.col("number") % blocks == k)
        got = part.select("lang", "hash", "number").toArrow()
        names, codes = _language_keys(got.column("lang").combine_chunks())
        hashes = np.asarray(got.column("hash")).view(np.uint64)
        keys = np.zeros(len(hashes), np.uint64)
        for i, name in enumerate(names):
            keys[codes == i] = word_key(name, hashes[codes == i])
        order = np.argsort(keys)
        keys = keys[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two frequent words have the same 64-bit hash")
        yield Dictionary(keys, np.asarray(got.column("number")).astype(np.uint32)[order])


def _encoded(known: Dictionary, texts: pa.Array, langs: pa.Array):
    """Word numbers of a batch's texts, 0 between pieces and texts and in
    place of words not known; with them the number of words. A row a chunk."""
    names, codes = _language_keys(langs)
    for lo, hi, buf, offsets in chunks(texts, RUN_BYTES):
        w = words(buf, offsets, IN_WORD)
        n = len(w.hashes)
        lang = np.repeat(codes[lo:hi], np.diff(w.first))
        key = np.zeros(n, np.uint64)
        for k in np.unique(lang).tolist():
            key[lang == k] = word_key(names[k], w.hashes[lang == k])
        place = np.minimum(np.searchsorted(known.keys, key), len(known.keys) - 1)
        ids = np.where(known.keys[place] == key, known.numbers[place], 0).astype(np.uint32)
        ends = np.concatenate([[0], np.cumsum(PIECE_END[buf])])
        broken = np.flatnonzero(ends[w.starts[1:]] > ends[w.ends[:-1]]) + 1 if n else np.zeros(0, np.int64)
        inner = w.first[(w.first > 0) & (w.first < n)]
        yield np.insert(ids, np.unique(np.concatenate([broken, inner])), 0), n


def _runs(docs: DataFrame, known: Dictionary) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(known)  # at most about WORDS_AT_ONCE words

    def run(batches):
        for batch in batches:
            for ids, n in _encoded(sent.value, batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([n], pa.int64())],
                                                 names=["ids", "words"])

    return docs.mapInArrow(released(run), "ids binary, words long")


def _runs_of_rows(docs: DataFrame, known: Dictionary) -> DataFrame:
    """``_runs`` of every text (text, lang, row) by itself."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                (ids, n), = _encoded(sent.value, one.column(0), one.column(1))
                yield pa.RecordBatch.from_arrays(
                    [one.column(2), pa.array([ids.tobytes()], pa.binary()), pa.array([n], pa.int64())],
                    names=["row", "ids", "words"])

    return docs.mapInArrow(released(run), "row long, ids binary, words long")


def word_runs(docs: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """(ids, words): word numbers of 32 bits, 0 where a run ends, and the words
    they stand for.  Of a word table of several blocks every block numbers its
    own words, and a text's numbers from all of them are put together."""
    if size <= WORDS_AT_ONCE:
        known, = dictionary_blocks(table, size)
        return staged(_runs(docs, known), "word-runs")
    kept = staged(docs.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    made = None
    for known in dictionary_blocks(table, size):
        part = staged(_runs_of_rows(kept, known), "word-runs-part")
        made = part if made is None else made.unionByName(part)

    def together(rows):
        parts = [np.frombuffer(x, np.uint32) for x in rows.column("ids").to_pylist()]
        return pa.table({"ids": pa.array([np.maximum.reduce(parts).tobytes()], pa.binary()),
                         "words": rows.column("words").slice(0, 1)})

    return staged(made.groupBy("row").applyInArrow(together, "ids binary, words long"), "word-runs")


# --- counting quotient filters -------------------------------------------------

class Packing(NamedTuple):
    """How n-grams of ``n`` words of ``bits`` bits stand in two halves."""
    n: int
    bits: int

    @property
    def half(self) -> int:
        return (self.n * self.bits + 1) // 2

    def ranges(self, grams: int) -> int:
        """Bits of the quotient that tell ranges apart."""
        wanted = max(LEAST_RANGES, -(-grams // GRAMS_A_RANGE))
        return min(self.half, (wanted - 1).bit_length())


def packed(ids: list[np.ndarray], p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower half of the whole number that n word numbers make."""
    half, mask = p.half, U((1 << p.half) - 1)
    high, low = np.zeros(len(ids[0]), np.uint64), np.zeros(len(ids[0]), np.uint64)
    for i, word in enumerate(ids):
        word, at = word.astype(np.uint64), i * p.bits
        if at < half:
            low |= (word << U(at)) & mask
            if at + p.bits > half:
                high |= word >> U(half - at)
        else:
            high |= word << U(at - half)
    return high, low


def unpacked(high: np.ndarray, low: np.ndarray, p: Packing) -> np.ndarray:
    """Word numbers, a row an n-gram."""
    mask, out = U((1 << p.bits) - 1), []
    for i in range(p.n):
        at = i * p.bits
        if at >= p.half:
            out.append((high >> U(at - p.half)) & mask)
        elif at + p.bits <= p.half:
            out.append((low >> U(at)) & mask)
        else:
            out.append(((low >> U(at)) | (high << U(p.half - at))) & mask)
    return np.stack(out, axis=1).astype(np.int32)


_KEYS = [U(0x8CB92BA72F3D8DD7), U(0x27D4EB2F165667C5), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]


def permuted(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network over both halves; ``restored`` undoes it."""
    mask = U((1 << half) - 1)
    for key in _KEYS:
        high, low = low, high ^ (mix(low + key) & mask)
    return high, low


def restored(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = U((1 << half) - 1)
    for key in reversed(_KEYS):
        high, low = low ^ (mix(high + key) & mask), high
    return high, low


def summed(high: np.ndarray, low: np.ndarray, half: int, counts: np.ndarray | None = None):
    """Distinct numbers in ascending order, and how often each occurs."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    if 2 * half <= 64:
        key = (high << U(half)) | low
        order = np.argsort(key, kind="stable") if counts is not None else None
        key = key[order] if counts is not None else np.sort(key)
        high, low = key >> U(half), key & U((1 << half) - 1)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    n = np.diff(np.append(new, len(high))) if counts is None else np.add.reduceat(counts[order], new)
    return high[new], low[new], n


def _bytes_of(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _values_of(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def written(high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int, rho: int) -> bytes:
    """A filter of distinct ascending numbers of one range: which quotients
    occur, where the run of each ends, remainders, counts of a byte with the
    larger ones aside."""
    n = len(high)
    spare = half - rho
    s = min(spare, max(0, (n - 1).bit_length()))
    rest = spare - s
    quotient = ((high >> U(rest)) & U((1 << s) - 1)).astype(np.int64)
    occupied = np.zeros(1 << s, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    large = counts[counts >= 255]
    return b"".join([
        np.array([n, s, len(large)], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
        _bytes_of(high & U((1 << rest) - 1), -(-rest // 8)), _bytes_of(low, -(-half // 8)),
        np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype("<i8").tobytes()])


def read(blob: bytes, number: int, half: int, rho: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers and counts of a filter of range ``number``."""
    n, s, larger = np.frombuffer(blob, "<u4", 3).tolist()
    view, at = memoryview(blob), 12
    rest = half - rho - s

    def take(size):
        nonlocal at
        at += size
        return view[at - size:at]

    occupied = np.unpackbits(np.frombuffer(take(-(-(1 << s) // 8)), np.uint8), count=1 << s)
    run_end = np.unpackbits(np.frombuffer(take(-(-n // 8)), np.uint8), count=n)
    run = np.concatenate([[0], np.cumsum(run_end)[:-1]]).astype(np.int64)
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    remainder = _values_of(take(n * -(-rest // 8)), n, -(-rest // 8))
    low = _values_of(take(n * -(-half // 8)), n, -(-half // 8))
    counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * larger), "<i8")
    return (U(number) << U(half - rho)) | (quotient << U(rest)) | remainder, low, counts


def merged(blobs: list[bytes], number: int, half: int, rho: int):
    """Numbers and counts of a range over all its filters."""
    parts = [read(b, number, half, rho) for b in blobs]
    return summed(*(np.concatenate([x[i] for x in parts]) for i in (0, 1)), half, np.concatenate([x[2] for x in parts]))


def _slots(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(high * U(0x9FB21C651E98DF25) + low)


def _windows(ids: np.ndarray, p: Packing, bitmap: np.ndarray | None):
    """The n-grams of word runs, of which both (n-1)-grams may be frequent."""
    if len(ids) < p.n:
        return [ids[:0]] * p.n
    if bitmap is None:
        good = ids[:-1] > 0
        good &= ids[1:] > 0
    else:
        q = Packing(p.n - 1, p.bits)
        m = len(ids) - q.n + 1
        whole = np.ones(m, bool)
        for i in range(q.n):
            whole &= ids[i:i + m] > 0
        at = np.flatnonzero(whole)
        slot = _slots(*permuted(*packed([ids[at + i] for i in range(q.n)], q), q.half)) & U(64 * len(bitmap) - 1)
        frequent = np.zeros(m, bool)
        frequent[at] = (bitmap[slot >> U(6)] >> (slot & U(63))) & U(1)
        good = frequent[:-1] & frequent[1:]
    at = np.flatnonzero(good)
    return [ids[at + i] for i in range(p.n)]


def frequent_grams(runs: DataFrame, p: Packing, grams: int, least: int, bitmap: np.ndarray | None) -> DataFrame:
    """(ids, f, slot) of the n-grams with at least ``least`` occurrences;
    ``grams`` bounds the occurrences of all."""
    half, rho = p.half, p.ranges(grams)
    sent = runs.sparkSession.sparkContext.broadcast(bitmap)  # at most BITMAP_BITS

    def filters(parts):
        high, low, counts = summed(*(np.concatenate([x[i] for x in parts]) for i in (0, 1)), half)
        number = (high >> U(half - rho)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else []
        for a, b in zip(starts, [*starts[1:], len(number)]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number[a]], pa.int32()), pa.array([written(high[a:b], low[a:b], counts[a:b], half, rho)], pa.binary())],
                names=["range", "filter"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for row in batch.column(0):
                ids = np.frombuffer(row.as_buffer(), np.uint32)
                # a long text's windows in steps, so that a task holds no more than it counts at once
                for lo in range(0, max(1, len(ids) - p.n + 1), GRAMS_AT_ONCE):
                    found = _windows(ids[lo:lo + GRAMS_AT_ONCE + p.n - 1], p, sent.value)
                    parts.append(permuted(*packed(found, p), half))
                    held += len(found[0])
                    if held >= GRAMS_AT_ONCE:
                        yield from filters(parts)
                        parts, held = [], 0
        if held:
            yield from filters(parts)

    def together(key, rows):
        high, low, counts = merged([x.as_py() for x in rows.column("filter")], key[0].as_py(), half, rho)
        often = counts >= least
        high, low = high[often], low[often]
        ids = unpacked(*restored(high, low, half), p)
        offsets = np.arange(0, ids.size + 1, p.n, dtype=np.int32)
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.reshape(-1))),
                         "f": pa.array(counts[often]), "slot": pa.array(_slots(high, low).view(np.int64))})

    shards = runs.select("ids").mapInArrow(released(run), "range int, filter binary")
    return staged(shards.groupBy("range").applyInArrow(together, "ids array<int>, f long, slot long"), f"grams-{p.n}")


def bitmap_of(grams: DataFrame, size: int) -> np.ndarray:
    """Bits of the slots of ``size`` n-grams, put together on Spark; the driver
    gets the words of the bitmap."""
    bits = min(BITMAP_BITS, 1 << max(16, (16 * size - 1).bit_length()))
    slot = F.col("slot").bitwiseAND(F.lit(bits - 1))
    got = grams.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 AS INT))").alias("bit")).groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[np.asarray(got.column("word"))] = np.asarray(got.column("bits")).view(np.uint64)
    return out


# --- candidates and scores -----------------------------------------------------

SCHEMA = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def mine(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """Of every language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    texts = fitted(docs, text="string", lang="string").where(F.col("text").isNotNull()).select("text", "lang")
    counted = staged(word_counts(texts), "word-counts")
    totals = staged(counted.groupBy("lang").agg(F.sum("n").alias("n")), "language-words")
    table = numbered(counted.where(F.col("n") >= least), [F.col("lang"), F.col("word")], "number", 1, "frequent-words")
    size, occurrences = table.agg(F.count("*"), F.sum("n")).first()
    bits = int(size).bit_length()
    if not size:
        return spark.createDataFrame([], SCHEMA)
    if bits > MOST_NUMBER_BITS:
        raise ValueError(f"{size} words occur {least} times and more; at most {2 ** MOST_NUMBER_BITS - 1} can be numbered")
    runs = word_runs(texts, table, size)
    levels, bitmap = [], None
    for n in range(2, LONGEST + 1):
        level = frequent_grams(runs, Packing(n, bits), occurrences, least, bitmap)
        found, occurrences = level.agg(F.count("*"), F.sum("f")).first()
        if not found:
            break
        levels.append(level.withColumn("m", F.lit(n)))
        if n < LONGEST:
            bitmap = bitmap_of(level, found)
    if not levels:
        return spark.createDataFrame([], SCHEMA)
    return _ranked(_scored(levels, table), table, totals, top)


def _scored(levels: list[DataFrame], table: DataFrame) -> DataFrame:
    """(ids, a, l, r) of each cut of the candidates that stay."""
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    grams = grams.select("ids", "f", "m")
    counts = grams.where(F.col("m") < LONGEST).select("ids", "f").unionByName(
        table.select(F.array(F.col("number").cast("int")).alias("ids"), F.col("n").alias("f")))
    inside = grams.where("m > 2").select(
        F.explode(F.expr("array(slice(ids, 1, m - 1), slice(ids, 2, m - 1))")).alias("ids"), F.col("f").alias("longer"))
    inside = inside.groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = grams.join(inside, "ids", "left").where("longer IS NULL OR longer < f")
    cuts = kept.select("ids", F.col("f").alias("a"), F.explode(F.expr("sequence(1, m - 1)")).alias("k"), "m").select(
        "ids", "a", "k", F.expr("slice(ids, 1, k)").alias("left"), F.expr("slice(ids, k + 1, m - k)").alias("right"))
    left = counts.select(F.col("ids").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("ids").alias("right"), F.col("f").alias("r"))
    return cuts.join(left, "left").join(right, "right").select("ids", "a", "k", "l", "r")


def _ranked(cuts: DataFrame, table: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    names = table.select("number", "lang", "word")
    langs = names.join(totals, "lang").select(F.col("number").alias("head"), "lang", "n")
    exact = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})")
    best = (cuts.withColumn("head", F.col("ids")[0]).join(langs, "head").withColumn("score", score)
            .groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "ids", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = [F.col("score").desc(), F.col("a").desc()]
    # rank within parts of a language, then of what all of them kept
    for part in ([F.pmod(F.xxhash64("ids"), F.lit(RANK_PARTS))], []):
        best = best.withColumn("place", F.rank().over(Window.partitionBy("lang", *part).orderBy(*order))).where(
            F.col("place") <= top).drop("place")
    best = staged(best, "ranked-phrases")
    spelled = (best.select("ids", F.posexplode("ids").alias("at", "number")).join(names, "number")
               .groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
               .select("ids", F.array_join(F.col("words.word"), " ").alias("phrase")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return best.join(spelled, "ids").withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
