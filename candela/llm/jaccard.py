"""N-gram Jaccard join with several global orders (operator 1).

A document's set are the hashes of its distinct word shingles. Two documents
link when the overlap of their sets is at least ``percent`` of their union.
The classes of the links' transitive closure come back with every document.

Equal sets are one node. For any global order of tokens, two sets that link
share COMMON tokens among the first |x| - ceil(threshold * |x|) + COMMON of
each (their prefixes). The index holds the prefixes in the first order, rare
tokens first: frequent tokens, counted over the whole corpus, come last. Pairs
that share fewer prefix tokens are dropped, as are pairs of sizes too far
apart and those whose first common token stands so late that too little is
left. The other orders sort the same tokens by different hashes. The prefixes
in each of them are kept beside a document's set; candidates meet those alone,
and only pairs that share a token in every order go on to the sets themselves.

Pairs of a token's documents are not written out. First each document meets a
few leaders of its tokens, which is as many pairs as documents; the links
found give classes. What the leaders leave open are pairs across classes: for
most tokens they are few, and only documents outside a token's largest class
meet the others there. Tokens with many of them are heavy. A pair that shares
a light token too is met there and its heavy tokens are counted. Others share
COMMON heavy ones, so one that is not among the COMMON - 1 most frequent of
either: those others are fewer, and mostly light among themselves. What still
is heavy is compared in blocks of documents of like sizes, a pair of blocks
answers with as many links as connect its classes, and the pairs of blocks are
taken in rounds, as many at a time as the blocks themselves take up twice.
Pairs within a class need no check, as their documents are connected already,
so no link between classes is lost.

Tables that are read no more are deleted as the work goes on.

Defined cases: null or empty texts, and texts without words, have the empty
set and link with nothing; a text of fewer words than a shingle has one
shingle, all its words; a null doc_id is never the smallest unless its class
has no other; repeated rows come back each and are copies of one another;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candela.llm.store import fitted, numbered, released, sliced, staged
from candela.llm.text import NOT_SPACE, chunks, mix, words
from candela.session import discard

#: orders that a candidate pair has to pass, the index's included
ORDERS = 3
#: tokens that the index's prefixes of a pair must share
COMMON = 3
#: leaders that a document meets at a time
LEADERS = 4
#: a token is heavy where so many pairs across classes share it
HEAVY = 2000
#: documents of a block in which what heavy tokens connect is compared
BLOCK_NODES = 128
#: bytes of blocks that a round of their pairs brings together, more only in proportion to the blocks
ROUND_BYTES = 1 << 30
#: tokens that stand last in every order; an order may be any, so the bound costs no pair
FREQUENT = 300_000
#: bits of a token that tell ranges of equally frequent tokens apart
TIE_BITS = 12
#: a task reports tokens that so many of its documents share
LOCAL_COUNT = 2
#: ids of documents whose sets are read again go to the tasks up to this many, else by a join
BROADCAST_IDS = 2_000_000
#: bytes of texts whose sets are made at a time: the arrays for it are some forty times that
SET_BYTES = 1 << 18
#: tokens that a task counts at a time
COUNTED_TOKENS = 1_000_000

_SALTS = (np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64))


def sets_of(buf: np.ndarray, offs: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of every document of a chunk."""
    w = words(buf, offs, NOT_SPACE)
    h = w.hashes
    n = max(len(h) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = mix(rolled * _SALTS[0] + h[k:k + n])
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for x in h[a:b]:
                one = mix(one * _SALTS[1] + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """The 64-bit name of a set; together with the set's size it stands for it."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        h = mix(np.bitwise_xor.reduce(mix(tokens * _SALTS[2])) + tokens.sum(dtype=np.uint64) * _SALTS[3]
                + np.arange(1, 2, dtype=np.uint64) * np.uint64(len(tokens)))
    return int(h[0].astype(np.int64))


def prefix_length(n: int, percent: int, common: int = 1) -> int:
    """So long a prefix that sets that link share ``common`` tokens of theirs.
    Sets of up to ``common`` tokens link with none but their equals."""
    return min(n, n - -(-percent * n // 100) + common)


class Orders:
    """Global orders: frequent tokens last by their count, and by a hash that
    each order has its own of."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, percent: int):
        by = np.argsort(tokens)
        self.tokens, self.counts, self.percent = tokens[by], counts[by], percent

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        i = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[i] == tokens, self.counts[i], 0)

    def prefix(self, tokens: np.ndarray, order: int, ranks: np.ndarray | None = None) -> np.ndarray:
        """The prefix of a set, its first token of the order first."""
        ranks = self.ranks(tokens) if ranks is None else ranks
        by = np.lexsort((mix(tokens + _SALTS[order]), ranks))  # equal hashes keep the tokens' own order
        return tokens[by[:prefix_length(len(tokens), self.percent, 1 if order else COMMON)]]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _map_sets(docs: DataFrame, size: int, schema: str, emit) -> DataFrame:
    """mapInArrow over ``docs`` (doc_id, text, ...): ``emit`` gets a batch's
    rows from ``lo``, their sets, and returns columns."""
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(1), SET_BYTES):
                out = emit(batch.slice(lo, hi - lo), sets_of(buf, offs, size))
                yield from sliced(pa.RecordBatch.from_pydict(out))

    return docs.mapInArrow(released(run), schema)


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """One reading of the texts for two tables: a row (doc_id, node, n) per
    document, and rows (token, k) for tokens that several documents of a task share."""
    def run(batches):
        kept: list[np.ndarray] = []
        held = 0

        def rows(**columns):
            n = max(map(len, columns.values()))
            return pa.RecordBatch.from_arrays(
                [columns.get(c, pa.nulls(n, pa.int64())) for c in ("doc_id", "node", "n", "token", "k")],
                names=["doc_id", "node", "n", "token", "k"])

        def counted():
            tokens = np.concatenate(kept)
            kept.clear()
            tokens.sort()
            # bits alone for the many tokens that occur once
            again = np.zeros(len(tokens) + 1, bool)
            np.equal(tokens[1:], tokens[:-1], out=again[1:-1])
            first = np.flatnonzero(again[1:] & ~again[:-1])
            counts = np.flatnonzero(again[:-1] & ~again[1:]) - first + 1
            some = counts >= LOCAL_COUNT
            return sliced(rows(token=pa.array(tokens[first[some]].view(np.int64)), k=pa.array(counts[some])))

        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(1), SET_BYTES):
                sets = sets_of(buf, offs, size)
                yield rows(doc_id=batch.column(0).slice(lo, hi - lo), node=pa.array(list(map(node_of, sets)), pa.int64()),
                           n=pa.array(list(map(len, sets)), pa.int64()))
                kept += sets
                held += sum(map(len, sets))
                if held > COUNTED_TOKENS:
                    yield from counted()
                    held = 0
        if held:
            yield from counted()

    return staged(docs.mapInArrow(released(run), "doc_id long, node long, n long, token long, k long"), "survey")


def _frequent(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT tokens, those with the highest counts; of the last count
    the smallest tokens, by whole ranges. Which tokens these are decides how fast
    the join is, not what it finds. The driver gets these tokens alone: to order
    and limit them there would take as many from every task."""
    counted = staged(survey.where("token IS NOT NULL").groupBy("token").agg(F.sum("k").alias("k")), "counts")
    # a row a count that occurs
    k, n = _columns(counted.groupBy("k").agg(F.count("*").alias("n")))
    by = np.argsort(-k)
    above = np.searchsorted(np.cumsum(n[by]), FREQUENT, side="right")  # counts whose tokens all fit
    wanted = counted
    if above < len(k):
        last, room = int(k[by[above]]), FREQUENT - int(n[by[:above]].sum())
        span = F.shiftright("token", 64 - TIE_BITS)
        range_, n = _columns(counted.where(F.col("k") == last).groupBy(span.alias("range")).agg(F.count("*").alias("n")))
        ranges = np.argsort(range_)
        # among the ranges of one count some stand beyond the room
        bound = int(range_[ranges[np.searchsorted(np.cumsum(n[ranges]), room, side="right")]])
        wanted = counted.where((F.col("k") > last) | (F.col("k") == last) & (span < bound))
    tokens, counts = _columns(wanted.select("token", "k"))
    discard(counted)
    return tokens.view(np.uint64), counts


def _columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of long numbers of a bounded ``df``."""
    return [c.to_numpy().astype(np.int64) for c in df.toArrow().columns]


def _noted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` (u, v) written and read back, with their number and the sum
    of their hashes, taken as they are written."""
    seen = Observation()
    out = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                               F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
    return out, tuple(seen.get.values())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): the smallest node that
    it is connected with. Large and small stars in turn until nothing moves;
    each round is written to shared storage."""
    edges, state = _noted(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .distinct())
    while True:
        # large star: every larger neighbour, and the node itself, to the smallest neighbour
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: every smaller neighbour, and the node itself, to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, old = state, edges
        edges, state = _noted(small)
        discard(old)
        if state == before:
            return edges.toDF("node", "root")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _passed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of fitting sizes that share a token of their prefixes
    in each further order."""
    orders = [f"p{k}" for k in range(1, ORDERS)]
    left, right = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), *[F.col(p).alias(f"{p}{x}") for p in orders])
                   for x in "ab")
    shared = [F.arrays_overlap(f"{p}a", f"{p}b") for p in orders]
    met = pairs.join(right, "b").join(left, "a").where(_sizes_fit(percent, "na", "nb"))
    return met.where(reduce(Column.__and__, shared)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The staged pairs (a, b) of nodes that link: the orders' filters, then the overlap."""
    pairs = staged(_passed(pairs, sets, percent), "passed")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))

    def run(batches):
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(ta, tb, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([x for x, k in zip(a, ok, strict=True) if k], pa.int64()),
                "b": pa.array([x for x, k in zip(b, ok, strict=True) if k], pa.int64())})

    met = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    links = staged(met.mapInArrow(released(run), "a long, b long"), "links")
    discard(pairs)
    return links


def _read_sets(docs: DataFrame, wanted: DataFrame, size: int, orders) -> DataFrame:
    """node, n, tokens (sorted, 64 bit each) and prefixes p1, ... in the further
    orders of the wanted (node, doc_id), from the texts of those documents alone."""
    ids = staged(wanted.select(F.col("doc_id").alias("wanted_id"), "node"), "wanted")
    # within the checked size to every task, else by a shuffle
    few = ids.count() <= BROADCAST_IDS
    again = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"].eqNullSafe(ids["wanted_id"]))

    def kept(rows, sets):
        node = rows.column(2).to_pylist()
        some = [i for i, s in enumerate(sets) if node_of(s) == node[i]]  # an id may have other rows
        out = {"node": pa.array([node[i] for i in some], pa.int64()),
               "n": pa.array([len(sets[i]) for i in some], pa.int64()),
               "tokens": pa.array([sets[i].tobytes() for i in some], pa.binary())}
        ranks = [orders.value.ranks(sets[i]) for i in some]
        for k in range(1, ORDERS):
            parts = [orders.value.prefix(sets[i], k, r) for i, r in zip(some, ranks, strict=True)]
            offsets = np.concatenate([[0], np.cumsum(list(map(len, parts)))]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            out[f"p{k}"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        return out

    schema = "node long, n long, tokens binary" + "".join(f", p{k} array<long>" for k in range(1, ORDERS))
    sets = staged(_map_sets(again.select("doc_id", "text", "node"), size, schema, kept), "sets")
    discard(ids)
    return sets


def _sizes_fit(percent: int, nx: str, ny: str) -> Column:
    return F.expr(f"100 * least({nx}, {ny}) >= {percent} * greatest({nx}, {ny})")


def _places_fit(nx: str, capx: str, ny: str, capy: str, spare: int = 0) -> Column:
    """With a first common token at these places, enough follows for a link;
    ``spare`` allows for tokens before it."""
    return F.expr(f"{nx} + {ny} <= least({capx}, {capy}) + {spare}")


def _best_leaders(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of every node with the LEADERS leaders that it shares most
    tokens with, two at least. ``rows``: node, lead, a row per token."""
    counted = rows.groupBy("node", "lead").agg(F.count("*").alias("k")).where("k > 1")
    first = Window.partitionBy("node").orderBy(F.desc("k"), "lead")
    return (counted.withColumn("r", F.row_number().over(first)).where(F.col("r") <= LEADERS)
            .select(*_pairs(F.col("node"), F.col("lead"))).distinct())


def _parted(rows: DataFrame) -> DataFrame:
    """Of the tokens of ``rows`` (token, node, root, ...) whose nodes are of several
    classes: the class that most of them have, their number, and whether they are heavy."""
    return (rows.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(
        F.max_by("root", F.struct("k", "root")).alias("largest"), (F.sum("k") - F.max("k")).alias("minor"), F.sum("k").alias("k"))
        .where("minor > 0").select("token", "largest", F.col("k").alias("shared"), F.expr(f"minor * k > {HEAVY}").alias("heavy")))


def _held(heavy: DataFrame) -> DataFrame:
    """node, n, root and its tokens of ``heavy`` (token, node, n, root, shared), the rarest first."""
    return heavy.groupBy("node", "n", "root").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shared", "token"))), lambda x: x["token"]).alias("heavies"))


def _common(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b, ...) that have heavy tokens in common, with their number, ``h``."""
    left, right = (held.select(F.col("node").alias(x), F.col("heavies").alias(f"h{x}")) for x in "ab")
    met = pairs.join(right, "b").join(left, "a")
    return met.withColumn("h", F.size(F.array_intersect("ha", "hb"))).drop("ha", "hb").where("h > 0")


def _blockwise(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes inside clusters (node, n, root, cluster):
    clusters are cut into blocks of documents of like sizes, and blocks whose
    sizes allow links are compared two at a time, by products of their token
    incidences. A pair of blocks returns no more links than connect its classes.
    The pairs are as many as the square of the blocks: they are dealt into rounds
    of so many bytes that what a round shuffles does not outgrow the blocks."""
    # places in the order of all clusters: a large one spans tasks
    placed = numbered(nodes, [F.col("cluster"), F.col("n"), F.col("node")], "nth", 0, "clusters-placed")
    begin = placed.groupBy("cluster").agg(F.min("nth").alias("begin"))
    placed = placed.join(begin, "cluster").withColumn("block", F.expr(f"(nth - begin) div {BLOCK_NODES}"))
    blocks = staged(placed.join(sets.select("node", "tokens"), "node").groupBy("cluster", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), (8 * F.sum("n")).alias("bytes"),
        F.collect_set(F.struct("node", "root", "tokens")).alias("docs")), "blocks")
    meta = blocks.select("cluster", "block", "least", "most", "bytes")
    pairs = staged(meta.toDF("cluster", "i", "li", "mi", "bi").join(meta.toDF("cluster", "j", "lj", "mj", "bj"), "cluster").where(
        f"i <= j AND 100 * mi >= {percent} * lj").select("cluster", "i", "j", (F.col("bi") + F.col("bj")).alias("bytes")), "block-pairs")
    most = max(ROUND_BYTES, 2 * (blocks.agg(F.sum("bytes")).first()[0] or 0))
    rounds = -(-(pairs.agg(F.sum("bytes")).first()[0] or 0) // most)

    def run(batches):
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tx, ty = ([np.frombuffer(d["tokens"], np.uint64) for d in z] for z in (x, y))
                nx, ny = np.array(list(map(len, tx))), np.array(list(map(len, ty)))
                vocabulary = np.intersect1d(np.concatenate(tx), np.concatenate(ty))
                both = np.zeros((len(x), len(y)), np.float32)  # exact: far below 2**24
                for v in range(0, len(vocabulary), 4096):
                    part = vocabulary[v:v + 4096]
                    mx, my = (np.stack([np.isin(part, t, assume_unique=True) for t in z]).astype(np.float32) for z in (tx, ty))
                    both += mx @ my.T
                link = 100 * both >= percent * (nx[:, None] + ny[None] - both)
                i, j = np.nonzero(link)
                root = {d["root"]: d["root"] for d in (*x, *y)}

                def find(r, root=root):
                    while root[r] != r:
                        root[r] = r = root[root[r]]
                    return r

                out = []
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    ra, rb = find(x[a]["root"]), find(y[b]["root"])
                    if ra != rb:
                        root[ra] = rb
                        out.append((x[a]["node"], y[b]["node"]))
                yield pa.RecordBatch.from_pydict({"a": pa.array([o[0] for o in out], pa.int64()),
                                                  "b": pa.array([o[1] for o in out], pa.int64())})

    links = [blocks.sparkSession.createDataFrame([], "a long, b long")]
    for k in range(rounds):
        now = pairs.where(F.expr(f"pmod(xxhash64(cluster, i, j), {rounds}) = {k}"))
        met = (now.join(blocks.select("cluster", F.col("block").alias("i"), F.col("docs").alias("x")), ["cluster", "i"])
               .join(blocks.select("cluster", F.col("block").alias("j"), F.col("docs").alias("y")), ["cluster", "j"]).select("x", "y"))
        links.append(staged(met.mapInArrow(released(run), "a long, b long"), "links"))
    out = staged(reduce(DataFrame.union, links), "links")
    discard(blocks, pairs, *links)
    return out


def link_documents(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = fitted(docs, doc_id="long", text="string")
    survey = _survey(docs, size)
    members = survey.where("token IS NULL").select("doc_id", "node", "n")
    orders = spark.sparkContext.broadcast(Orders(*_frequent(survey), percent))  # at most FREQUENT entries

    def prefixes(rows, sets):
        some = [s for s in sets if len(s)]
        pre = [orders.value.prefix(s, 0) for s in some]
        lens = np.array(list(map(len, pre)), np.int64)
        n = np.repeat(np.array(list(map(len, some)), np.int64), lens)
        place = np.arange(len(n)) - np.repeat(np.cumsum(lens) - lens, lens)
        # the set's size, and above 32 bits the most that both sizes may sum up to
        return {"token": np.concatenate([np.zeros(0, np.uint64), *pre]).view(np.int64),
                "node": np.repeat(np.array(list(map(node_of, some)), np.int64), lens),
                "bounds": n + ((n - place) * (100 + percent) // percent << 32)}

    every = _map_sets(docs, size, "token long, node long, bounds long", prefixes)
    every = staged(every, "prefixes")
    leads = staged(every.groupBy("token").agg(
        F.min("node").alias("lead"), F.min_by("bounds", "node").alias("led"), F.max("node").alias("hi"))
        .where("lead < hi").select("token", "lead", "led"), "leads")
    posted = staged(every.join(leads, "token").select(
        "token", "node", F.expr("bounds & 4294967295").alias("n"), F.expr("bounds >> 32").alias("cap"),
        "lead", F.expr("led & 4294967295").alias("nl")).distinct(), "postings")
    discard(every, leads)

    nodes = members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    tried = staged(_best_leaders(posted.where("node <> lead").where(_sizes_fit(percent, "n", "nl"))), "pairs")
    read = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = _read_sets(docs, read.join(nodes, "node"), size, orders)
    links = _verified(tried, sets, percent)
    roots = components(links)

    # tokens whose documents are of several classes; few of them have many such documents
    classed = (posted.select("token", "node", "n", "cap").join(roots, "node", "left")
               .select("token", "node", "n", "cap", F.coalesce("root", "node").alias("root")))
    open_ = staged(classed.join(_parted(classed), "token"), "open")
    discard(posted)

    # light tokens: documents outside the largest class meet the others
    light = open_.where(~F.col("heavy"))
    minor = (light.where("root <> largest").select(
        "token", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("cap").alias("capx")))
    # the common tokens of a pair are counted as the pair is made. The first one
    # of a pair that links leaves enough behind it, the next ones a token less
    # each. Of one that shares heavy tokens these count as well, wherever they stand
    spare = (COMMON - 1) * (100 + percent) // percent + 2
    met = staged(minor.join(light, "token").where("rx <> root AND (root = largest OR x < node)")
                 .where(_sizes_fit(percent, "nx", "n") & _places_fit("nx", "capx", "n", "cap", spare))
                 .select(*_pairs(F.col("x"), F.col("node")), _places_fit("nx", "capx", "n", "cap").alias("fits"))
                 .groupBy("a", "b").agg(F.count("*").alias("k"), F.bool_or("fits").alias("fits")), "met")
    enough = (F.col("k") >= COMMON) & F.col("fits")
    held = staged(_held(open_.where("heavy")), "held")
    mixed = _common(met.where(~enough), held).where(F.col("k") + F.col("h") >= COMMON)

    # pairs of heavy tokens alone: the most frequent ones of a document bring it nothing
    rest = F.slice("heavies", 1, F.greatest(F.size("heavies") - (COMMON - 1), F.lit(0)))
    rich = held.where(F.size("heavies") >= COMMON).select("node", "n", "root", F.explode(rest).alias("token"))
    still = staged(rich.join(_parted(rich), "token"), "still-open")
    few = still.where(~F.col("heavy"))
    lone = (few.where("root <> largest").select("token", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"))
            .join(few, "token").where("rx <> root AND (root = largest OR x < node)").where(_sizes_fit(percent, "nx", "n"))
            .select(*_pairs(F.col("x"), F.col("node"))).distinct())
    lone = _common(lone, held).where(F.col("h") >= COMMON)
    cross = staged(met.where(enough).select("a", "b").union(mixed.select("a", "b")).union(lone.select("a", "b")).distinct()
                   .join(tried, ["a", "b"], "left_anti"), "pairs")
    discard(open_, met, held)

    # what is heavy still: what it connects is compared block by block
    heavy = still.where("heavy")
    heads = heavy.groupBy("token").agg(F.min("node").alias("head"))
    clusters = components(heavy.join(heads, "token").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    grouped = staged(heavy.select("node", "n", "root").distinct()
                     .join(clusters.withColumnRenamed("root", "cluster"), "node", "left")
                     .withColumn("cluster", F.coalesce("cluster", "node")), "clusters")
    discard(still)
    more = (cross.select(F.col("a").alias("node")).union(cross.select("b")).union(grouped.select("node")).distinct()
            .join(read, "node", "left_anti"))
    more_sets = _read_sets(docs, more.join(nodes, "node"), size, orders)
    both = sets.union(more_sets)
    more_links, block_links = _verified(cross, both, percent), _blockwise(grouped, both, percent)
    roots = components(links.union(more_links).union(block_links))
    discard(sets, more_sets, tried, cross, grouped, links, more_links, block_links)

    classes = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = classes.select("node", "root").join(least, "root").select("node", "component_id")
    out = members.join(found, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
