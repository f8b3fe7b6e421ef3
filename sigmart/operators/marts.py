"""The fact and its dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sigmart.schemas import ACTION_COLUMNS, FACT_COLUMNS


def count_where(condition: Column) -> Column:
    """Rows where the condition is true, as BIGINT; 0 rather than NULL."""
    return F.count(F.when(condition, F.lit(1)))


def fct_signals(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def dim_actions(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("action_id").isNotNull()).select(*ACTION_COLUMNS).distinct()


def dim_entities(fact: DataFrame) -> DataFrame:
    """One aggregation with map-side combine; an entity's rows never meet in one task."""
    return fact.groupBy("entity_id").agg(
        F.min("signal_timestamp").alias("first_seen_at"),
        F.max("signal_timestamp").alias("last_seen_at"),
        F.count(F.lit(1)).alias("total_signals"),
        count_where(F.col("is_positive")).alias("positive_signal_count"),
        count_where(F.col("was_enforced")).alias("enforcement_count"),
    )


def dim_models(fact: DataFrame) -> DataFrame:
    """Totals per model, repeated for each signal type of the model.

    One pass aggregates to (model, type); that result is small, and rolls up per model before the types
    join back on.
    """
    partial = (
        fact.filter(F.col("model_id").isNotNull())
        .groupBy("model_id", "signal_type")
        .agg(
            F.min("signal_timestamp").alias("first_seen_at"),
            F.max("signal_timestamp").alias("last_seen_at"),
            F.count(F.lit(1)).alias("total_signals"),
            F.sum("score").alias("_score_sum"),
            F.count("score").alias("_score_rows"),
            count_where(F.col("is_positive")).alias("_positives"),
        )
    )
    types = F.collect_set("signal_type")  # at most one entry per signal type
    per_model = partial.groupBy("model_id").agg(
        types.alias("_types"),
        F.max(F.col("signal_type").isNull()).alias("_untyped"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("total_signals").alias("total_signals"),
        (F.sum("_score_sum") / F.nullif(F.sum("_score_rows"), F.lit(0))).alias("avg_score"),
        (F.sum("_positives") / F.sum("total_signals")).alias("positive_rate"),
    )
    listed = F.when(F.col("_untyped"), F.array_append("_types", F.lit(None).cast("string"))).otherwise(F.col("_types"))
    return per_model.select(
        "model_id", F.explode(listed).alias("signal_type"),
        "first_seen_at", "last_seen_at", "total_signals", "avg_score", "positive_rate",
    )
