"""What a task's arrays take: texts of a batch are worked on a little at a time."""
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candela.llm import decontam, jaccard, packing, text, tokens
from candela.llm.queries import vocabulary
from candela.llm.store import staged

FILE = "byte_bpe_50k.json"


@pytest.fixture
def batch():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=640)) for _ in range(250)]  # about a megabyte
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(250)), "text": pa.array(texts)})


def _run(module, monkeypatch, make):
    """The task function that ``make`` hands to Spark."""
    runs = []
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(module, "released", lambda run: runs.append(run) or run)
    monkeypatch.setattr(module, "staged", lambda df, name: df, raising=False)
    make()
    return runs[0]


def _peak(run, batch):
    text.drop_powers()
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_packing_encodes_a_little_at_a_time(docs_of, batch, monkeypatch):
    tokens.encoder(vocabulary(FILE))
    run = _run(packing, monkeypatch, lambda: packing.pieces(docs_of([(1, "")]), vocabulary(FILE), 1, 2048))
    assert _peak(run, batch) < 24


def test_sets_are_made_a_little_at_a_time(docs_of, batch, monkeypatch):
    run = _run(jaccard, monkeypatch, lambda: jaccard._map_sets(
        docs_of([(1, "")]), 4, "n long", lambda rows, sets: {"n": pa.array(list(map(len, sets)), pa.int64())}))
    assert _peak(run, batch) < 24


def test_segments_are_of_bounded_size(docs_of, batch, monkeypatch):
    run = _run(decontam, monkeypatch, lambda: decontam.build_index(docs_of([(1, "")]), np.zeros(1, np.uint64)))
    assert _peak(run, batch) < 32


def test_rows_counted_in_a_task_are_those_that_repeat(docs_of, batch, monkeypatch):
    run = _run(jaccard, monkeypatch, lambda: jaccard._survey(docs_of([(1, "")]), 4))
    texts = ["a b c d", "a b c d e", "a b c d e", "x y z w", None, "b c d e"]
    given = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(6)), "text": pa.array(texts)})
    got = [r for b in run([given]) for r in b.to_pylist() if r["token"] is not None]
    assert len({r["token"] for r in got}) == 2 and [r["k"] for r in got] == [3, 3]
    assert _peak(run, batch) < 24


def test_large_rows_stand_in_small_pages(spark):
    rows = staged(spark.range(0, 60, 1, 1).select("id", F.expr("repeat(uuid(), 10000)").alias("big")), "large")
    assert rows.where("length(big) = 360000").count() == 60
    path = rows.inputFiles()[0].removeprefix("file://")
    chunk = pq.ParquetFile(path).metadata.row_group(0).column(1)
    with open(path, "rb") as f:
        f.seek(chunk.data_page_offset)
        head = f.read(32)
    # the page header's second field: its size, a zigzag varint
    assert head[0] == 0x15 and head[2] == 0x15
    size = sum((b & 127) << 7 * i for i, b in enumerate(head[3:8]) if all(x & 128 for x in head[3:3 + i])) >> 1
    assert 360_000 < size < 4_000_000 < chunk.total_uncompressed_size
