"""Packing documents into sequences (operator 6): shortest pack first over the
histogram of lengths.

Documents are encoded once, without a shuffle, and cut into pieces of the
sequence length with a shorter last piece. The histogram of piece lengths (at
most ``length`` entries, whatever the corpus) is packed on the driver: lengths
longest first, each into the open packs with the most room, as counts of
packing patterns. Patterns come back to the pieces by rank: the n-th piece of
a length takes the n-th place that the patterns hold for that length.

Ranks need no sort and no group: every piece carries its task and its number
among that task's pieces of its length, and bases come from a running sum over
the (task, length) counts. A length that a third of all pieces share is spread
over tasks like any other.

Defined cases: a null or empty text is the end id alone; a null id stays null;
repeated rows are packed each on their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm import tokens
from candela.llm.store import fitted, released, staged
from candela.llm.text import chunks

#: bytes of texts encoded at a time: a task's arrays are some forty times that
ENCODED_BYTES = 1 << 18

Pattern = tuple[tuple[int, int], ...]  # (length, times), longest first


def pack_histogram(histogram: Mapping[int, int], length: int) -> list[tuple[Pattern, int]]:
    """Packing patterns and how often each is used, for ``histogram`` (piece
    length -> count). A pack that takes a piece moves to its new room; of the
    packs with the most room the last made are split first. Where none has
    room, as many are opened as the tokens still to be placed can fill."""
    rooms: dict[int, list[tuple[Pattern, int]]] = {}
    widest = 0
    tokens = sum(s * n for s, n in histogram.items())
    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        left = histogram[size]
        while left:
            while widest and not rooms.get(widest):
                widest -= 1
            if widest < size:
                used = min(left, -(-tokens // length))
                rooms.setdefault(length - size, []).append((((size, 1),), used))
                widest = length - size
                left -= used
                tokens -= size * used
                continue
            pattern, count = rooms[widest].pop()
            used = min(left, count)
            if used < count:
                rooms[widest].append((pattern, count - used))
            if pattern[-1][0] == size:
                grown = (*pattern[:-1], (size, pattern[-1][1] + 1))
            else:
                grown = (*pattern, (size, 1))
            rooms.setdefault(widest - size, []).append((grown, used))
            left -= used
            tokens -= size * used
    merged: dict[Pattern, int] = {}
    for room in sorted(rooms):
        for pattern, count in rooms[room]:
            merged[pattern] = merged.get(pattern, 0) + count
    return list(merged.items())


def places(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, packs,
    offset): the ranks of a length that a pattern holds. Rank r is in sequence
    first + (r - first rank) % packs, after the places of earlier rounds."""
    rows, taken, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for size, times in pattern:
            lo = taken.get(size, 0)
            taken[size] = hi = lo + times * count
            rows.append((size, lo, hi, sequence, count, offset))
            offset += size * times
        sequence += count
    return rows


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens,
    task, nth (its number among the task's pieces of that length), and the ids
    themselves (little-endian unsigned 32 bit) if ``keep_ids``."""
    def cut(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        enc = tokens.encoder(tokenizer)
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            doc_ids = batch.column(0)
            for lo, hi, buf, offs in chunks(batch.column(1), ENCODED_BYTES):
                ids, first = enc.encode(buf, offs)
                ids = np.insert(ids, first[1:], end_id).astype("<u4")
                first = first + np.arange(len(first))
                n = np.diff(first)
                each = -(-n // length)
                row = np.repeat(np.arange(hi - lo), each)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)) * length
                size = np.minimum(n[row] - start, length)
                at = first[row] + start
                raw = [ids[a:a + s].tobytes() for a, s in zip(at.tolist(), size.tolist(), strict=True)]
                order = np.argsort(size, kind="stable")
                _, begins, counts = np.unique(size[order], return_index=True, return_counts=True)
                nth = np.empty(len(size), np.int64)
                nth[order] = np.arange(len(size)) - np.repeat(begins, counts)
                nth += seen[size]
                seen += np.bincount(size, minlength=length + 1)
                out = {"doc_id": doc_ids.take(pa.array(lo + row)), "start": start, "length": size,
                       "ids_crc32": [zlib.crc32(x) for x in raw], "doc_tokens": n[row],
                       "task": np.full(len(row), task, np.int64), "nth": nth}
                if keep_ids:
                    out["ids"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, nth long"
    return fitted(docs, doc_id="long", text="string").mapInArrow(released(cut), schema + ", ids binary" * keep_ids)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048,
                   keep_ids: bool = False) -> DataFrame:
    """``pieces`` with sequence_id and offset: gapless from 0 in each sequence."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, end_id, length, keep_ids), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    by_length = Window.partitionBy("length").orderBy("task")
    bases = counts.select("task", "length", (F.sum("n").over(by_length) - F.col("n")).alias("base"))
    histogram = {r["length"]: r["n"] for r in  # at most `length` rows
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.createDataFrame(
        places(pack_histogram(histogram, length)) or [(0, 0, 0, 0, 1, 0)],
        "length long, lo long, hi long, sequence long, packs long, at long")
    ranked = cut.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # bounded: a pattern has at most ~sqrt(2 * length) lengths, and each length adds few patterns
    placed = ranked.join(F.broadcast(table), "length").where("rank >= lo AND rank < hi")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr("sequence + (rank - lo) % packs").alias("sequence_id"),
        F.expr("at + length * ((rank - lo) div packs)").alias("offset"), *["ids"] * keep_ids)
