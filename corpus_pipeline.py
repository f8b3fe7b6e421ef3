"""The corpus pipeline: quality, repeated lines, near duplicates, benchmark passages, mixture.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before has kept. All but the last return the
columns of ``documents``; the last returns one row for each time the mix takes a document, with its shard and place.

No row is lost for being odd: null and empty texts pass stages 2 to 4 unchanged (the classifier judges them like texts
without words), rows without a doc_id are never duplicates, an empty table stays empty, extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmart.llm import decontaminate, line_dedup, mixing, near_dedup, quality_classifier
from sigmart.llm.common import broadcast_ids, materialize, table

QUALITY = 0.7  # smallest score that is kept


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below ``QUALITY``."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"), QUALITY)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes line chunks that stand elsewhere already; a text may become empty, its row stays."""
    return line_dedup.without_repeats(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group (shingles of five words, similarity 0.8)."""
    judged = near_dedup.near_duplicates(docs, size=5)
    dropped = materialize(judged.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "dropped")
    return docs.join(broadcast_ids(dropped), "doc_id", "left_anti").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more stand in passages of the benchmark; cuts them out of others."""
    plain = docs.toDF(*(f"c{place}" for place in range(len(docs.columns))))  # no name of the caller's clashes then
    text = plain.columns[docs.columns.index("text")]
    judged = decontaminate.judged(decontaminate.matches(plain, table(spark, sf_dir, "benchmark"), text=text))
    kept = materialize(judged.where("NOT contaminated").select(*plain.columns, "spans"), "clean")
    # Few documents have spans; the others do not travel through Python again.
    cut = decontaminate.cut_spans(kept.where("size(spans) > 0"), 0, text=text)
    if "n_chars" in docs.columns:
        counted = plain.columns[docs.columns.index("n_chars")]
        cut = cut.withColumn(counted, F.length(text).cast(plain.schema[counted].dataType))
    return kept.where("size(spans) = 0").unionByName(cut).select(*plain.columns).toDF(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per draw: the document with size, source_size, target, copy, shard and the key that orders the shard."""
    mixed = mixing.mix(mixing.sized(docs))
    kept = [name for name in mixed.columns if name not in ("draws", "copy", "shard", "key")]
    return mixed.select(*kept, F.inline("draws"))


STAGES = [("quality", quality), ("repeated_lines", repeated_lines), ("near_duplicates", near_duplicates),
          ("benchmark_passages", benchmark_passages), ("mixture", mixture)]

# Sketches, learned scores and the automaton are beyond SQL; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
