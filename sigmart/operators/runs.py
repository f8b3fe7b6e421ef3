"""Retrieval-run rules as columns: routing, retry, next strategy and curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sigmart.schemas import CONFIDENCE_THRESHOLD, MAX_RETRIES, RUN_SCHEMA, STRATEGIES

# Fixed value: where a run goes when its strategy is missing or unknown.
FALLBACK_STRATEGY = "vector"


def route_col(strategy: Column) -> Column:
    known = F.when(strategy.isin(STRATEGIES), strategy).otherwise(F.lit(FALLBACK_STRATEGY))
    return F.concat(F.lit("retrieval_"), known)


def should_retry_col(
    score: Column, retry_count: Column, threshold: float = CONFIDENCE_THRESHOLD, max_retries: int = MAX_RETRIES
) -> Column:
    """Retries left, and the score is missing or too low."""
    return (retry_count < max_retries) & (score.isNull() | (score < threshold))


def _history(history: Column) -> Column:
    return F.coalesce(history, F.array().cast("array<string>"))


def next_strategy_col(history: Column) -> Column:
    """The first strategy not yet tried, or NULL."""
    untried = F.array_except(F.array(*[F.lit(s) for s in STRATEGIES]), _history(history))
    return F.try_element_at(untried, F.lit(1))


def after_scoring_col(
    score: Column, retry_count: Column, history: Column,
    threshold: float = CONFIDENCE_THRESHOLD, max_retries: int = MAX_RETRIES,
) -> Column:
    again = should_retry_col(score, retry_count, threshold, max_retries) & next_strategy_col(history).isNotNull()
    return F.when(again, F.lit("retry")).otherwise(F.lit("end"))


def apply_retry(runs: DataFrame) -> DataFrame:
    """Runs as they re-enter routing: one more retry, stale results cleared, current strategy on record.

    The strategy is recorded only while another one is left to try.
    """
    history, current = _history(F.col("strategy_history")), F.col("retrieval_strategy")
    record = (
        next_strategy_col(history).isNotNull()
        & F.coalesce(current != "", F.lit(False))
        & ~F.array_contains(history, F.coalesce(current, F.lit("")))
    )
    changed = {
        "retry_count": F.col("retry_count") + 1,
        "strategy_history": F.when(record, F.array_append(history, current)).otherwise(history),
    }
    for name in ("retrieved_context", "synthesised_answer", "confidence_score", "failure_reason"):
        dtype = RUN_SCHEMA[name].dataType
        empty = F.array() if name == "retrieved_context" else F.lit(None)
        changed[name] = empty.cast(dtype)
    return runs.withColumns(changed)


def needs_curation_col(score: Column, retry_count: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return F.coalesce(score < threshold, F.lit(False)) | (retry_count > 0)


def curate_runs(runs: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Runs worth keeping for evaluation: low confidence, or retried."""
    return runs.filter(needs_curation_col(F.col("confidence_score"), F.col("retry_count"), threshold))


def initial_runs(queries: DataFrame, query: str = "query") -> DataFrame:
    """A fresh run per query; other columns of the input, such as a run id, are kept."""
    zero = {
        "retry_count": F.lit(0),
        "retrieved_context": F.array(),
        "strategy_history": F.array(),
        "metadata": F.create_map(),
    }
    kept = [F.col(name) for name in queries.columns if name != query]
    fresh = [
        zero.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in RUN_SCHEMA
        if field.name != "query" and field.name not in queries.columns
    ]
    return queries.select(*kept, F.col(query).alias("query"), *fresh)
