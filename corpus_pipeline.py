"""Corpus pipeline over `documents`: toxic documents go, one document of each
group of near copies stays, documents with benchmark passages go, secrets are
masked in the texts, and what is left is packed into sequences.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet to shared storage and read back as the next one's docs. All but the
last return the columns of documents. Rows are told apart by a number of
their own where doc_id is null or not unique, so a decision on one row never
falls on another; extra columns are kept, nulls are handled as each operator
says, and an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import decontam, jaccard, packing, secrets, toxicity
from candela.llm.queries import table, vocabulary
from candela.llm.store import bounded_batches, extended, flat, position, staged
from candela.session import discard

#: rows of an Arrow batch: workers and JVMs of all stages live on beside one another
STAGE_ROWS = 250
#: row numbers that go to every task up to this many, else by a shuffle
BROADCAST_ROWS = 2_000_000
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
WINDOW_WORDS = 10
SEQUENCE_TOKENS, END_ID = 2048, 1


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as c0, c1, ... and `row`: doc_id if that is a key, else a
    number written down with the rows."""
    plain = flat(docs)
    at = plain[f"c{position(docs, 'doc_id')}"].cast("long")
    some = plain.select(at.alias("id")).agg(F.count("*"), F.count("id"), F.countDistinct("id")).first()
    if some[0] == some[1] == some[2]:
        return plain.withColumn("row", at)
    return staged(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")


def _texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Row numbers as doc_id, and texts."""
    return rows.select(F.col("row").alias("doc_id"), rows[f"c{position(docs, 'text')}"].cast("string").alias("text"))


def _without(docs: DataFrame, rows: DataFrame, dropped: DataFrame) -> DataFrame:
    dropped = staged(dropped.select(F.col("doc_id").alias("row")), "dropped")
    few = dropped.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped, "row", "left_anti").drop("row").toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = docs.columns
    plain = toxicity.annotate(flat(docs), model, score="score", text=f"c{position(docs, 'text')}")
    return plain.where("score < 0.5").drop("score").toDF(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest doc_id stays."""
    rows = numbered(docs)
    found = staged(jaccard.link_documents(_texts(docs, rows), SHINGLE_WORDS, SIMILARITY_PERCENT)
                   .select("doc_id", "component_id"), "groups")
    several = found.groupBy("component_id").agg(F.count("*").alias("k")).where("k > 1").select("component_id")
    ids = rows.select(F.col("row").alias("doc_id"), rows[f"c{position(docs, 'doc_id')}"].cast("long").alias("id"))
    members = found.join(several, "component_id").join(ids, "doc_id")
    first = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")).alias("m"))
    dropped = members.join(first, "component_id").where("doc_id <> m.doc_id").select("doc_id")
    left = _without(docs, rows, dropped)
    discard(found)
    return left


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    found = decontam.match_items(_texts(docs, rows), table(spark, sf_dir, "benchmark"), WINDOW_WORDS, slop=None)
    return _without(docs, rows, found.where(F.size("hits") > 0).select("doc_id"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is masked in the text, and n_chars follows."""
    names = docs.columns
    text = position(docs, "text")
    field = spark.sparkContext.broadcast(secrets.fit(docs))  # of bounded size

    def mask(column):
        import pyarrow as pa

        masked = [secrets.redact(t, secrets.listed(secrets.all_spans(field.value, t)[1])) for t in column.to_pylist()]
        return [pa.array(masked, pa.string())]

    plain = extended(flat(docs), f"c{text}", {"masked": "string"}, mask)
    new = F.col("masked")
    changed = ~new.eqNullSafe(F.col(f"c{text}").cast("string"))
    columns = [F.col(f"c{i}") for i in range(len(names))]
    columns[text] = new.cast(plain.schema[f"c{text}"].dataType)
    if "n_chars" in names:
        n = names.index("n_chars")
        columns[n] = F.when(changed, F.length(new)).otherwise(columns[n]).cast(plain.schema[f"c{n}"].dataType)
    return plain.select(*columns).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, SEQUENCE_TOKENS)


def _stage(function):
    return lambda spark, docs, sf_dir: function(bounded_batches(spark, STAGE_ROWS), docs, sf_dir)


STAGES = [
    ("toxicity", _stage(drop_toxic)),
    ("near_copies", _stage(drop_near_copies)),
    ("decontamination", _stage(drop_contaminated)),
    ("secrets", _stage(mask_secrets)),
    ("packing", _stage(pack)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
