"""The operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplefeed.llm import (
    divergence,
    exact_dedup,
    fingerprints,
    fm_index,
    manifest,
    ngram_join,
    packing,
    page_diff,
    personal_data,
    quality_rules,
    reply_trees,
    suffix_tree,
    toxicity,
)
from tuplefeed.llm.common import settled, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_tree.score(docs, lambda key: toxicity.remainder(key, 7) != 2, longest=3)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.find(docs, personal_data.train(docs))


def op3_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.remove(table(spark, sf_dir, "documents")).drop("spans")


def learns_toxicity(key: Column) -> Column:
    return toxicity.remainder(key, 3) != 1


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"), learns_toxicity)
    return toxicity.score(docs, scorer).select(
        "doc_id",
        (~learns_toxicity(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages")).drop("n_shared")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.drop("rejected_by")  # depends on measured times


def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    messages = settled(reply_trees.from_turns(rows), "reply-messages")
    return reply_trees.digests(reply_trees.conversations(messages))


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "word_spans")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.bpe_50k)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.dedup(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_personal_data": op2_personal_data,
    "op3_suffix_arrays": op3_suffix_arrays,
    "op4_toxicity": op4_toxicity,
    "op5_page_diff": op5_page_diff,
    "op6_quality_rules": op6_quality_rules,
    "op7_reply_trees": op7_reply_trees,
    "op8_fm_index": op8_fm_index,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_fingerprints": op11_fingerprints,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES: dict[str, str] = {
    "op7_reply_trees": reply_trees.ORACLE,
    "op11_fingerprints": fingerprints.ORACLE,
    "op12_merkle_manifest": manifest.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
