"""Prefix trie of conversations, by fixed-length block hashing.

A conversation is cut into blocks of ``BLOCK_TURNS`` turns.  The digest of a
prefix is the exclusive or of 128-bit hashes of its turns with their places, so
a block's digest comes from an aggregation and a prefix's from a running one,
however long a conversation is.

1. Conversations that share the prefix before a block and the block's digest are
   one class: counted with partial aggregation, with the smallest conversation
   for a representative.  Only representatives' turns are looked at from here on.
2. Where all conversations that go on from a prefix are of one class, the block's
   nodes are that class's prefixes.  Only where classes diverge are the turn
   boundaries inside the block grouped by their own digests.
3. Sums over subtrees run inside blocks first (at most ``BLOCK_TURNS`` ancestors
   each), then over block ends, whose distance doubles from round to round, so
   the rounds grow with the logarithm of the longest conversation.
4. The conversations that end at a node are put in order by ranges of (node,
   conv_id), joined to pieces of text, and hashed as a stream of pieces.

Defined results: a null role or text is empty; a null turn comes first; equal
turns of a conversation stand in the order of role and text; rows without a
conv_id take no part; repeated rows are turns of their own.  A conversation
without turns is a member of the root.  An empty table has no nodes.  Other
columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.store import fitted, in_order, numbered, staged

BLOCK_TURNS = 4
#: characters of joined ids in a piece
PIECE = 1 << 16

NODE = ["depth", "x", "y"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, tx, ty, chars): places from 0, hashes of role and text,
    code points of the text.  Places come from one numbering over all
    conversations, so a long one may span tasks."""
    given = fitted(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
    rows = given.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("row").asc()]
    hashed = numbered(rows, order, "place", 0, "turns").select(
        "conv_id", "place", F.xxhash64(F.lit(1), "role", "text").alias("tx"), F.xxhash64(F.lit(2), "text", "role").alias("ty"),
        F.length("text").cast("long").alias("chars"))
    hashed = staged(hashed, "turn-hashes")
    first = hashed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return hashed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("at"), "tx", "ty", "chars")


def with_openings(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared openings: the first h turns of
    conversation c - c % group, then c's own after its first h, with h =
    crc32(c) % most.  (turns, (conv_id) of all conversations)."""
    turns = staged(turns, "ordered-turns")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    c = F.col("conv_id")
    convs = own.select("conv_id", (F.crc32(c.cast("string").cast("binary")) % most).alias("h"),
                       (c - F.pmod(c, F.lit(group))).alias("base"))
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = staged(convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "conversations")
    head = turns.where(F.col("at") < most - 1).withColumnRenamed("conv_id", "base")
    opening = convs.select("conv_id", "base", "h").join(head, "base").where("at < h").select("conv_id", "at", "tx", "ty", "chars")
    rest = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("at >= h").select(
        "conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "tx", "ty", "chars")
    return opening.unionByName(rest), convs.select("conv_id")


def _prefixed(turns: DataFrame) -> DataFrame:
    """(conv_id, block, m, bx, by, px, py): a row a block, its digest and that
    of all before it.  The running exclusive or goes over all blocks in order;
    what stood before a conversation is taken out again."""
    blocks = turns.groupBy("conv_id", F.expr(f"at div {BLOCK_TURNS}").alias("block")).agg(
        F.count("*").alias("m"), F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    placed, _ = in_order(blocks, [F.col("conv_id"), F.col("block")], "blocks")
    totals = placed.groupBy("part").agg(F.bit_xor("bx").alias("x"), F.bit_xor("by").alias("y")).collect()  # a row a range
    rows, x, y = [], 0, 0
    for r in sorted(totals):
        rows.append((r["part"], x, y))
        x, y = x ^ r["x"], y ^ r["y"]
    before = placed.sparkSession.createDataFrame(rows, "part int, ox long, oy long")
    run = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the digest of everything before the block
    seen = placed.withColumns({"rx": F.bit_xor("bx").over(run), "ry": F.bit_xor("by").over(run)}).join(
        F.broadcast(before), "part").selectExpr("conv_id", "block", "m", "bx", "by", "rx ^ bx ^ ox AS gx", "ry ^ by ^ oy AS gy")
    seen = staged(seen, "block-digests")
    start = seen.where("block = 0").select("conv_id", F.col("gx").alias("sx"), F.col("gy").alias("sy"))
    return seen.join(start, "conv_id").selectExpr("conv_id", "block", "m", "bx", "by", "gx ^ sx AS px", "gy ^ sy AS py")


def _nodes(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """All nodes but the root: depth, digest (x, y), the parent's (ux, uy), the
    digests on the way from the block's start (path), the block's start (tx,
    ty), conversations, the smallest, code points of the last text."""
    key = ["block", "px", "py", "bx", "by", "m"]
    classes = blocks.groupBy(*key).agg(F.count("*").alias("k"), F.min("conv_id").alias("conv_id"))
    classes = staged(classes, "block-classes")
    ways = classes.groupBy("block", "px", "py").agg((F.count("*") > 1).alias("diverges"))
    said = classes.join(turns.withColumn("block", F.expr(f"at div {BLOCK_TURNS}")), ["conv_id", "block"]).groupBy(
        "conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("at", "x", "y", "chars"))).alias("t"))  # at most BLOCK_TURNS
    prefixes = """transform(sequence(1, size(t)), i -> struct(
        t[i - 1].at + 1 AS depth, aggregate(slice(t, 1, i), px, (a, e) -> a ^ e.x) AS x,
        aggregate(slice(t, 1, i), py, (a, e) -> a ^ e.y) AS y, t[i - 1].chars AS chars))"""
    inner = (classes.join(said, ["conv_id", "block"]).join(ways, ["block", "px", "py"])
             .select("conv_id", "block", "px", "py", "k", "diverges", F.expr(prefixes).alias("p"))
             .select("*", F.posexplode("p").alias("i", "node"))
             .selectExpr("conv_id", "k", "diverges", "node.depth", "node.x", "node.y", "node.chars", "px AS tx", "py AS ty",
                         "CASE WHEN i = 0 THEN px ELSE p[i - 1].x END AS ux", "CASE WHEN i = 0 THEN py ELSE p[i - 1].y END AS uy",
                         "transform(slice(p, 1, i + 1), e -> struct(e.depth AS depth, e.x AS x, e.y AS y)) AS path"))
    inner = staged(inner, "class-nodes")
    columns = [*NODE, "tx", "ty", "ux", "uy", "path", "chars", "n_convs", "conv_id"]
    single = inner.where("NOT diverges").withColumnRenamed("k", "n_convs").select(*columns)
    # classes that diverge share nodes up to the turn where they do
    same = [F.any_value(c).alias(c) for c in ("tx", "ty", "ux", "uy", "chars")]
    refined = inner.where("diverges").groupBy(*NODE, "path").agg(*same, F.sum("k").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return single.unionByName(refined.select(*columns))


def _below(nodes: DataFrame) -> DataFrame:
    """(depth, x, y, leaves, saved) of block ends and the root: sums over all
    nodes under them, by doubling distances over block ends."""
    start = F.expr(f"(depth - 1) div {BLOCK_TURNS} * {BLOCK_TURNS}")
    under = nodes.where("depth > 0").groupBy(start.alias("depth"), F.col("tx").alias("x"), F.col("ty").alias("y")).agg(
        F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    ends = nodes.where(f"depth > 0 AND depth % {BLOCK_TURNS} = 0").select(
        *NODE, F.struct(start.alias("depth"), F.col("tx").alias("x"), F.col("ty").alias("y")).alias("up"))
    sums = staged(under.join(ends, NODE, "left"), "block-sums")
    while sums.where("up IS NOT NULL").limit(1).count():
        more = sums.where("up IS NOT NULL").groupBy("up").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        more = more.select("up.*", "more_leaves", "more_saved")
        above = sums.select(F.struct(*NODE).alias("up"), F.col("up").alias("next"))
        sums = (sums.join(above, "up", "left").join(more, NODE, "left")
                .select(*NODE, (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.col("next").alias("up")))
        sums = staged(sums, "block-sums")
    return sums.drop("up")


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, sha256) of the ids that end at each node."""
    order = [*NODE, "conv_id"]

    def runs(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for node, group in itertools.groupby(zip(*columns, strict=True), key=lambda r: r[:3]):
                held, size, first = [], 0, None
                for r in group:
                    first = r[3] if first is None else first
                    held.append(str(r[3]))
                    size += len(held[-1]) + 1
                    if size >= PIECE:
                        yield *node, first, ",".join(held)
                        held, size, first = [], 0, None
                if held:
                    yield *node, first, ",".join(held)

    def pieces(batches):
        for rows in iter(lambda it=runs(batches): list(itertools.islice(it, 1000)), []):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(
                zip(*rows, strict=True))], names=[*order, "ids"])

    def rows_of(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def hashes(batches):
        def found():
            for node, group in itertools.groupby(rows_of(batches), key=lambda r: r[:3]):
                h, joint = hashlib.sha256(), b""
                for r in group:
                    h.update(joint + r[4].encode())
                    joint = b","
                yield *node, h.hexdigest()

        for rows in iter(lambda it=found(): list(itertools.islice(it, 1000)), []):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(
                zip(*rows, strict=True))], names=[*NODE, "ends_sha256"])

    schema = "depth long, x long, y long"
    joined = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(pieces, f"{schema}, conv_id long, ids string"))
    return joined.repartition(*NODE).sortWithinPartitions(*order).mapInArrow(hashes, f"{schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, at, tx, ty, chars) of the
    ``conversations`` (conv_id): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns = staged(turns.select("conv_id", "at", F.xxhash64("at", "tx", "ty").alias("x"), F.xxhash64("ty", "at", "tx").alias("y"), "chars"),
                   "placed-turns")
    conversations = staged(conversations, "members")
    blocks = staged(_prefixed(turns), "prefixes")
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    found = _nodes(turns, blocks)
    nothing = F.array().cast(found.schema["path"].dataType)
    root = root.select(*[zero.alias(c) for c in (*NODE, "tx", "ty")], *[F.lit(None).cast("long").alias(c) for c in ("ux", "uy")],
                       nothing.alias("path"), zero.alias("chars"), "n_convs", "conv_id")
    nodes = staged(found.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ux").alias("x"), F.col("uy").alias("y")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = staged(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"),
                                      "saved": (F.col("n_convs") - 1) * F.col("chars")}), "node-children")
    below = _below(nodes).select(*NODE, F.col("leaves").alias("under_leaves"), F.col("saved").alias("under_saved"))
    own = nodes.join(below, NODE, "left").select(
        *NODE, "path", (F.col("leaf") + F.coalesce("under_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("under_saved", zero)).alias("saved"))
    sums = own.select(F.explode(F.when(F.col("depth") == 0, F.array(F.struct(*NODE))).otherwise(F.col("path"))).alias("to"), "leaves", "saved").groupBy(
        "to.depth", "to.x", "to.y").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "m", (F.expr("px ^ bx")).alias("x"), (F.expr("py ^ by")).alias("y"))).alias("l"))
    ends = conversations.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce(F.expr(f"l.block * {BLOCK_TURNS} + l.m"), zero).alias("depth"),
        F.coalesce("l.x", zero).alias("x"), F.coalesce("l.y", zero).alias("y"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, NODE).join(parents, ["depth", "ux", "uy"], "left").join(_digests(ends), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
