"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    conversation_trie,
    decontaminate,
    html_text,
    licenses,
    mixing,
    quality,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
    url_rules,
    vector_search,
)
from lakeloom.llm.common import table

THRESHOLD = 0.3


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), 8)  # whole rows; digests of what comes out
    return sharding.digests(placed, "shard", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "equal", "length", "doc_at", "hits")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mix(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.cleaned(table(spark, folder, "documents")).drop("kept")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("spans")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_rules.judge(table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(table(spark, folder, "conversations"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_sharding, op3_html_text, op4_quality, op5_decontamination,
        op6_mixing, op7_suffix_dedup, op8_licenses, op9_simhash, op10_url_rules,
        op11_conversation_trie, op12_spelling, op13_vector_search,
    )
}
