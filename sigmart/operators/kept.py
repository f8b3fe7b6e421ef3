"""Daily partial sums kept beside a fact and renewed for the days a load has written.

Metrics of any range are sums over these rows, so their cost follows the number of days and models, not of signals.
Distinct entities are sketches, which can be merged over days: exact up to a few thousand, and beyond that with a
relative standard error of 1.04 / sqrt(2 ** SKETCH_BITS), 0.8 %.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sigmart.operators.incremental import in_days
from sigmart.operators.marts import count_where

SKETCH_BITS = 14


def daily_sums(fact: DataFrame) -> DataFrame:
    """One row for each day, model and signal type of a fact with one row per signal."""
    acted = F.col("is_positive") & F.col("action_id").isNotNull()
    return fact.groupBy("signal_day", "model_id", "signal_type").agg(
        F.count(F.lit(1)).alias("signals"), count_where(F.col("is_positive")).alias("positives"),
        count_where(acted).alias("enforced"), F.sum("score").alias("score_sum"), F.count("score").alias("scores"),
        F.min("signal_timestamp").alias("first_seen_at"), F.max("signal_timestamp").alias("last_seen_at"),
        F.hll_sketch_agg("entity_id", SKETCH_BITS).alias("entities"),
    )


def refresh_daily(spark: SparkSession, fact_path: str, path: str, days: set[date | None] | None = None) -> None:
    """Renew the sums of some days (all of them by default) from a fact written by day; other days are neither read nor written."""
    fact = spark.read.parquet(fact_path)
    if days is not None:
        if not days:
            return
        fact = fact.filter(in_days("signal_day", days))
    sums = daily_sums(fact)
    if days is not None:  # a day that has become empty keeps no sums
        empty = spark.createDataFrame([(day,) for day in days], "signal_day date")
        sums = empty.join(sums, "signal_day", "left").select(*sums.columns)
    sums.hint("rebalance", "signal_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "signal_day").parquet(path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("signals").isNotNull())


def _ratio(part: str, whole: str) -> Column:
    return F.round(F.sum(part) / F.nullif(F.sum(whole), F.lit(0)), 4)


def kept_precision(daily: DataFrame, by: tuple[str, ...] = ("signal_day", "model_id")) -> DataFrame:
    """Signals, positives, enforced ones, precision and distinct entities, by day and model or any coarser ``by``."""
    return daily.groupBy(*by).agg(
        F.sum("signals").alias("total_signals"), F.sum("positives").alias("predicted_positives"),
        F.sum("enforced").alias("true_positives"), _ratio("enforced", "positives").alias("precision"),
        F.hll_sketch_estimate(F.hll_union_agg("entities")).alias("entities"),
    )


def kept_models(daily: DataFrame) -> DataFrame:
    """The model dimension from the sums: statistics of a model over all its types, one row for each type."""
    models = daily.groupBy("model_id").agg(
        F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"),
        F.sum("signals").alias("total_signals"), (F.sum("score_sum") / F.sum("scores")).alias("avg_score"),
        (F.sum("positives") / F.sum("signals")).alias("positive_rate"))
    return daily.where("model_id IS NOT NULL").select("model_id", "signal_type").distinct().join(models, "model_id").select(
        "model_id", "signal_type", "first_seen_at", "last_seen_at", "total_signals", "avg_score", "positive_rate")
