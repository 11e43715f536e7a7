"""Approximate nearest neighbours by a permutation index (operator 3).

Every vector is represented by the order of its nearest pivots, and posted in
the inverted file of each of them with its place there. A query reads the
files of its own nearest pivots, which gives the footrule distance between the
two orders (pivots outside an order count as its last place); the vectors of
the least footrule distance are reranked by their true distance.

The index is stored in blocks of vectors, each with its own inverted files, so
building needs no shuffle and no pivot's file grows with the corpus. Identical
vectors of a block are posted once, with all their ids, and crowd nothing out.
Queries are a stated set: blocks of them meet the index blocks, and a block
answers with its nearest only.

Pivots are PIVOTS vectors far from each other, out of a sample of SAMPLE rows;
every vector is indexed. Of each block the nearest RERANK of its vectors by
footrule distance are reranked, LEAST at least.

Defined cases: vectors that are null or zero, hold null or non-finite
components, or have another than the most frequent length (of equally
frequent ones the longest) take no part, as do null ids; every row is a
candidate of its own, but rows with the query's id are not its neighbours;
a repeated query row is answered each time; ties go to the smaller id; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.store import fitted, released, staged

PIVOTS = 128
ORDER = 64
SAMPLE = 1024
RERANK = 0.2
LEAST = 500
BLOCK_ROWS = 16384
QUERY_ROWS = 2048

_FIELDS = ("vectors", "members", "ids", "files", "places", "weights")


def matrix(ids: pa.Array, column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (double) of the rows that take part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ok = pc.and_(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False), pc.is_valid(ids))
    values = column.filter(ok).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = np.ascontiguousarray(values, np.float64).reshape(-1, dim)
    live = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return ids.filter(ok).to_numpy(zero_copy_only=False).astype(np.int64)[live], x[live] + 0.0


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties to the earlier pivot."""
    k = min(ORDER, len(pivots))
    out = [np.zeros((0, k), np.int64)]
    for a in range(0, len(x), 4096):
        part = x[a:a + 4096]
        out.append(np.argsort((pivots ** 2).sum(axis=1) - 2 * part @ pivots.T, axis=1, kind="stable")[:, :k])
    return np.concatenate(out)


def _block(ids: np.ndarray, x: np.ndarray, pivots: np.ndarray) -> pa.RecordBatch:
    """Inverted files of one block: for each pivot the vectors that hold it
    and their weight there, ORDER less the place."""
    by_id = np.argsort(ids, kind="stable")
    ids, x = ids[by_id], x[by_id]
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, group = np.unique(raw, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))  # the group of the smallest id first
    group = rank[group]
    x = x[np.sort(first)]
    members = np.argsort(group, kind="stable")
    perm = orders(x, pivots)
    k = perm.shape[1]
    post = np.argsort(perm.ravel(), kind="stable")
    return pa.RecordBatch.from_pydict({
        "vectors": [x.tobytes()], "ids": [ids[members].tobytes()],
        "members": [np.append(0, np.cumsum(np.bincount(group, minlength=len(x)))).astype("<i8").tobytes()],
        "files": [np.append(0, np.cumsum(np.bincount(perm.ravel(), minlength=len(pivots)))).astype("<i8").tobytes()],
        "places": [(post // k).astype("<i4").tobytes()], "weights": [(k - post % k).astype("<i4").tobytes()]},
        schema=pa.schema([(c, pa.binary()) for c in _FIELDS]))


def build_index(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The stored index of ``vectors`` (vec_id, embedding), a row per block."""
    dim = pivots.shape[1]

    def blocks(batches):
        ids, xs, held = [], [], 0
        for batch in batches:
            i, x = matrix(batch.column(0), batch.column(1), dim)
            for a in range(0, len(i), BLOCK_ROWS):
                ids.append(i[a:a + BLOCK_ROWS])
                xs.append(x[a:a + BLOCK_ROWS])
                held += len(ids[-1])
                if held >= BLOCK_ROWS:
                    yield _block(np.concatenate(ids), np.concatenate(xs), pivots)
                    ids, xs, held = [], [], 0
        if held:
            yield _block(np.concatenate(ids), np.concatenate(xs), pivots)

    return staged(vectors.mapInArrow(released(blocks), ", ".join(f"{c} binary" for c in _FIELDS)), "permutations")


def _nearest(row: dict, query: np.ndarray, perm: np.ndarray, own: np.ndarray, dim: int, top: int):
    """(query number, vec_id, distance) of the nearest of one block."""
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
    members, ids = np.frombuffer(row["members"], "<i8"), np.frombuffer(row["ids"], np.int64)
    files, places = np.frombuffer(row["files"], "<i8"), np.frombuffer(row["places"], "<i4")
    weights = np.frombuffer(row["weights"], "<i4")
    k, n = perm.shape[1], len(x)
    take = min(n, max(LEAST, int(np.ceil(RERANK * n))))
    # ties in the footrule distance go to the vector with the smaller id
    tie = np.arange(n)
    for q in range(len(query)):
        near = np.zeros(n, np.int64)  # k * (k + 1) less the footrule distance, halved
        for place, p in enumerate(perm[q].tolist()):
            a, b = files[p], files[p + 1]
            near[places[a:b]] += np.minimum(weights[a:b], k - place)
        found = np.arange(n) if take == n else np.argpartition(tie - near * n, take - 1)[:take]
        diff = x[found] - query[q]
        dist = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        # groups of identical vectors: `top` of the smallest ids and the query's own are enough
        cut = np.partition(dist, min(top, take - 1))[min(top, take - 1)]
        rows = []
        for g, d in zip(found[dist <= cut].tolist(), dist[dist <= cut].tolist(), strict=True):
            mine = ids[members[g]:members[g + 1]]
            if len(mine) > top:
                mine = mine[mine != own[q]][:top]
            rows += [(d, i) for i in mine.tolist() if i != own[q]]
        for d, i in sorted(rows)[:top]:
            yield q, i, d


def pick_pivots(vectors: DataFrame) -> np.ndarray:
    """PIVOTS vectors far from each other: of a sample of SAMPLE rows, the
    first by the hash of its id, then always the one farthest from those
    chosen. Fewer if the sample holds fewer distinct vectors."""
    sized = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    dim = (sized.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first())
    if not dim or not dim["dim"]:
        return np.zeros((0, 1))
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(
        "embedding", lambda v: v != 0)
    rows = (sized.where((F.size("embedding") == dim["dim"]) & good)
            .orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect())
    x = np.array([r["embedding"] for r in rows], np.float64).reshape(-1, dim["dim"]) + 0.0
    gap = np.full(len(x), np.inf)
    chosen: list[int] = []
    while len(chosen) < PIVOTS and len(x) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def search(embeddings: DataFrame, is_query: Column, top: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of every row of
    ``embeddings`` (vec_id, embedding) for which ``is_query``, which may name vec_id."""
    vectors = fitted(embeddings, vec_id="long", embedding="array<double>")
    pivots = pick_pivots(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], schema)
    dim = pivots.shape[1]
    index = build_index(vectors, pivots)

    def packed(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, x = matrix(batch.column(0), batch.column(1), dim)
            for a in range(0, len(ids), QUERY_ROWS):
                some = ids[a:a + QUERY_ROWS]
                yield pa.RecordBatch.from_pydict({
                    "block": [number], "ids": [some.tobytes()], "points": [x[a:a + QUERY_ROWS].tobytes()]})
                number += 1

    asked = vectors.where(is_query)
    queries = staged(asked.repartition(-(-asked.count() // QUERY_ROWS) or 1, "vec_id")
                     .mapInArrow(released(packed), "block long, ids binary, points binary").toDF("block", "own", "points"), "queries")
    numbers = [r[0] for r in queries.select("block").collect()]  # one a QUERY_ROWS queries
    if not numbers:
        return vectors.sparkSession.createDataFrame([], schema)
    met = index.withColumn("block", F.explode(F.array(*map(F.lit, numbers)))).join(queries, "block")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"], np.float64).reshape(-1, dim)
                own = np.frombuffer(row["own"], np.int64)
                found = list(_nearest(row, points, orders(points, pivots), own, dim, top))
                q = np.array([f[0] for f in found], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "block": np.full(len(q), row["block"], np.int64), "query": q, "query_id": own[q],
                    "vec_id": np.array([f[1] for f in found], np.int64),
                    "score": np.array([f[2] for f in found], np.float64)})

    answers = met.mapInArrow(released(run), "block long, query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("block", "query").orderBy("score", "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
