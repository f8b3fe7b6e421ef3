"""Staging: typed, renamed views over the raw tables. Projections only, so scans prune and push down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def utc_ntz(df: DataFrame, column: str) -> Column:
    """The column as UTC wall-clock time.

    TIMESTAMP_NTZ passes through; text with an offset and TIMESTAMP are instants and need a UTC session.
    """
    dtype = df.schema[column].dataType.simpleString()
    if dtype == "timestamp_ntz":
        return F.col(column)
    instant = F.col(column).cast("timestamp")
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def _text(*names: str) -> list[Column]:
    return [F.col(name).cast("string").alias(name) for name in names]


def stg_signals(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("signal_id", "model_id", "entity_id", "label"),
        F.col("score").cast("double").alias("score"),
        F.col("threshold").cast("double").alias("threshold"),
        F.col("is_positive").cast("boolean").alias("is_positive"),
        utc_ntz(raw, "timestamp").alias("signal_timestamp"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        F.lit("classifier").alias("signal_type"),
        F.col("metadata"),
    )


def stg_enforcement(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("action_id", "entity_id", "action_type", "policy_id", "enforced_by", "reason"),
        utc_ntz(raw, "timestamp").alias("action_timestamp"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        F.col("metadata"),
    )


def stg_reports(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("report_id", "reporter_id", "reported_entity_id", "report_type", "description", "severity", "status"),
        utc_ntz(raw, "timestamp").alias("report_timestamp"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        F.col("metadata"),
    )


def stg_model_outputs(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("output_id", "model_id", "prompt_hash", "output_text"),
        F.col("safety_labels"),
        F.col("latency_ms").cast("bigint").alias("latency_ms"),
        utc_ntz(raw, "timestamp").alias("output_timestamp"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        F.col("metadata"),
    )


def all_signals(
    fact: DataFrame | None = None,
    reports: DataFrame | None = None,
    actions: DataFrame | None = None,
    outputs: DataFrame | None = None,
) -> DataFrame:
    """One relation over every signal type; columns a type lacks are NULL.

    ``fact`` is the classifier fact, the others are staging views.
    """
    parts = []
    if fact is not None:
        parts.append(fact)
    if reports is not None:
        parts.append(
            reports.select(
                F.col("report_id").alias("signal_id"),
                F.col("reported_entity_id").alias("entity_id"),
                F.col("report_timestamp").alias("signal_timestamp"),
                F.lit("report").alias("signal_type"),
                "report_type", "severity", "status", "description", "reporter_id", "reported_entity_id",
                "_loaded_at", "metadata",
            )
        )
    if actions is not None:
        parts.append(
            actions.select(
                F.col("action_id").alias("signal_id"),
                "entity_id",
                F.col("action_timestamp").alias("signal_timestamp"),
                F.lit("enforcement").alias("signal_type"),
                "action_id", "action_type", "policy_id", "enforced_by",
                F.col("reason").alias("enforcement_reason"),
                "action_timestamp", "_loaded_at", "metadata",
            )
        )
    if outputs is not None:
        parts.append(
            outputs.select(
                F.col("output_id").alias("signal_id"),
                "model_id",
                F.col("output_timestamp").alias("signal_timestamp"),
                F.lit("model_output").alias("signal_type"),
                "prompt_hash", "output_text", "latency_ms", "_loaded_at", "metadata",
            )
        )
    if not parts:
        raise ValueError("all_signals needs at least one relation")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
