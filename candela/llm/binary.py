"""Token ids as flat binary files (operator 9).

``write_token_files`` range-partitions the documents by id, encodes each
partition in order and writes three files for it: ``.ids`` (flat unsigned
integers, 16 bit where the vocabulary allows, else 32), ``.off`` (64-bit
offsets of the documents in it, one more at the end) and ``.doc`` (64-bit
document ids, then one byte each: 1 where the id is null). A partition's base,
the ids before it in the whole order, is the prefix sum of the partitions'
totals. ``read_token_files`` memory-maps them.

A task writes under private names and renames, so a retried or speculative
task leaves the same bytes; the files stand in the cluster's shared folder.
Only one row per partition reaches the driver.

Defined cases: a null or empty text is the end id alone; null ids come first;
equal ids are ordered by their text's hash, then text, and each row keeps its
own entry; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import tokens
from candela.llm.store import fitted, local_path, released, shared_dir, write_atomic
from candela.llm.text import chunks

_PART = "part int, n_docs long, n_tokens long"


class TokenFiles(NamedTuple):
    folder: str
    dtype: str
    #: (part, n_docs, n_tokens, base), ascending
    parts: list[tuple[int, int, int, int]]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int) -> TokenFiles:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order with the
    tokenizer file ``tokenizer``, ``end_id`` after each document."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    place = local_path(folder)
    os.makedirs(place, exist_ok=True)
    dtype = "<u2" if max(tokens.encoder(tokenizer).vocabulary, end_id + 1) <= 1 << 16 else "<u4"

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = tokens.encoder(tokenizer)
        name = os.path.join(place, f"part-{part:07d}")
        ids_docs, nulls, lengths = [], [], []

        def stream(f):
            for batch in batches:
                ids = batch.column(0)
                ids_docs.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(np.asarray(ids.is_null()).astype(np.uint8))
                for lo, hi, buf, offs in chunks(batch.column(1), tokens.CHUNK_BYTES):
                    out, first = enc.encode(buf, offs)
                    f.write(np.insert(out, first[1:], end_id).astype(dtype).tobytes())
                    lengths.append(np.diff(first) + 1)

        write_atomic(name + ".ids", stream)
        n = np.concatenate([np.zeros(0, np.int64), *lengths])
        write_atomic(name + ".off", lambda f: f.write(np.append(0, np.cumsum(n)).astype("<u8").tobytes()))
        write_atomic(name + ".doc", lambda f: f.write(b"".join(x.tobytes() for x in ids_docs + nulls)))
        if len(n):
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "n_docs": pa.array([len(n)], pa.int64()),
                "n_tokens": pa.array([int(n.sum())], pa.int64())})

    ordered = (fitted(docs, doc_id="long", text="string")
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
               .select("doc_id", "text"))
    done = ordered.mapInArrow(released(write), _PART).collect()  # one row a partition
    parts, base = [], 0
    for part, n_docs, n_tokens in sorted(tuple(r) for r in done):
        parts.append((part, n_docs, n_tokens, base))
        base += n_tokens
    return TokenFiles(folder, dtype, parts)


def open_part(files: TokenFiles, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, document ids, null flags) of one partition, memory-mapped."""
    name = os.path.join(local_path(files.folder), f"part-{part:07d}")
    off = np.memmap(name + ".off", "<u8", "r")
    ids = np.memmap(name + ".ids", files.dtype, "r")
    docs = np.memmap(name + ".doc", np.uint8, "r")
    n = len(off) - 1
    return ids, off, docs[:8 * n].view("<i8"), docs[8 * n:]


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers)."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, off, docs, null = open_part(files, row["part"])
                at = off.astype(np.int64)
                for lo in range(0, len(docs), 4096):
                    hi = min(lo + 4096, len(docs))
                    crc = [zlib.crc32(ids[at[i]:at[i + 1]].astype("<u4")) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(docs[lo:hi].astype(np.int64), mask=null[lo:hi] == 1),
                        "start": pa.array(row["base"] + at[lo:hi]),
                        "n_tokens": pa.array(np.diff(at[lo:hi + 1])),
                        "ids_crc32": pa.array(crc, pa.int64())})

    parts = spark.createDataFrame(files.parts, _PART + ", base long")
    return parts.mapInArrow(released(read), "doc_id long, start long, n_tokens long, ids_crc32 long")
