"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import (
    ann, binary, chat, collocations, decontam, html, jaccard, langid, oracle, packing, repeats, secrets, toxicity, trie,
)
from candela.llm.store import bounded_batches

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, top=10)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400).drop("kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(decontam.match_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, slop=2))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                  end_id=1, length=2048)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.annotate(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(-1, 0).select(F.col("id").alias("conv_id"), F.explode(F.expr(
        "array(struct(0 AS turn, 'user' AS role), struct(1 AS turn, 'assistant' AS role))")).alias("t")).select(
        "conv_id", "t.turn", "t.role", F.lit(chat.CONFLICT).alias("text"))
    return chat.digests(chat.format_conversations(given.unionByName(own)))


def op9_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = binary.write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return binary.read_token_files(spark, files)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs, secrets.fit(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), least=100, top=2000)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = trie.with_openings(trie.ordered_turns(table(spark, sf_dir, "conversations")), group=100, most=6)
    return trie.prefix_trie(turns, members)


def op13_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.annotate(docs.select("doc_id", "text"), langid.fit(docs)).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Query]:
    return {
        "op1_jaccard": op1_jaccard,
        "op2_html": op2_html,
        "op3_neighbours": op3_neighbours,
        "op4_repeats": op4_repeats,
        "op5_decontamination": op5_decontamination,
        "op6_packing": op6_packing,
        "op7_toxicity": op7_toxicity,
        "op8_chat": op8_chat,
        "op9_binary": op9_binary,
        "op10_secrets": op10_secrets,
        "op11_collocations": op11_collocations,
        "op12_trie": op12_trie,
        "op13_langid": op13_langid,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.build()
