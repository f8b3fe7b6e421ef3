"""The registered queries of the corpus operators; each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmart.llm import (chat_format, decontaminate, fill_in_middle, line_dedup, merkle, mixing, near_dedup, pii,
                         quality_classifier, quality_rules, secret_scan, token_counts, toxicity)
from sigmart.llm.common import materialize, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged_documents(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.FACTS, "base_failed", "kept")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", F.expr("int(score >= 0.7)"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.perspectives(table(spark, sf_dir, "conversations"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "n_lines", "n_removed_lines", "text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = token_counts.TokenizerFile(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer, by_word=True).withColumn("over_limit", F.expr("n_tokens > 2048"))


def op6_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialize(mixing.sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size"), "sizes")
    shards = F.array_join(F.transform("draws", lambda draw: draw["shard"].cast("string")), ",")
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target",
                                    (F.col("size") * F.size("draws")).alias("taken"), shards.alias("shards"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(secret_scan.count_of("findings", kind).alias(f"n_{kind}") for kind in secret_scan.BASE),
        F.sha2(secret_scan.spans("findings", secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.spans("findings").alias("spans"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.matches(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        decontaminate.items_digest("items").alias("items_sha256"), "contaminated")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", F.expr("int(score >= 0.3)"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("steps")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(rebuilt, 256).alias("restored_sha256"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(pii.count_of("findings", kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.spans("findings", base=True), 256).alias("base_sha256"), pii.spans("findings").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_quality_rules, op2_quality_classifier, op3_chat_formatting, op4_line_dedup, op5_token_counts,
        op6_source_mixture, op7_secret_scan, op8_benchmark_decontamination, op9_near_duplicates, op10_toxicity,
        op11_merkle_manifest, op12_fill_in_middle, op13_personal_data)
}
