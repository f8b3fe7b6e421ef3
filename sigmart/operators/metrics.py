"""Metric queries: classifier precision, enforcement rate, report volume, and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from sigmart.functions.time import day_of, hour_of, ntz
from sigmart.operators.marts import count_where
from sigmart.schemas import SQL_ROW_LIMIT


def in_range(df: DataFrame, column: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """Half-open time range; written on the bare column so it reaches the scan.

    On a written fact the range also bounds ``signal_day``, which leaves out the folders of other days.
    """
    by_day = column == "signal_timestamp" and "signal_day" in df.columns
    if start_date is not None:
        df = df.filter(F.col(column) >= ntz(start_date))
        df = df.filter(F.col("signal_day") >= ntz(start_date).cast("date")) if by_day else df
    if end_date is not None:
        df = df.filter(F.col(column) < ntz(end_date))
        df = df.filter(F.col("signal_day") <= ntz(end_date).cast("date")) if by_day else df
    return df


def _equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == value)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole to 4 places; NULL when whole is 0."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), 4)


def _ordered(df: DataFrame, keys: list[Column], row_limit: int | None) -> DataFrame:
    df = df.orderBy(*keys)
    return df if row_limit is None else df.limit(row_limit)


def classifier_precision(
    fact: DataFrame,
    actions: DataFrame,
    model_id: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    row_limit: int | None = None,
) -> DataFrame:
    """Daily precision per model; a fact row counts once per action of its signal.

    The action side is counted per signal before the join, so repeated signal ids weigh rows instead of
    multiplying them.
    """
    scope = in_range(_equal(fact, "model_id", model_id), "signal_timestamp", start_date, end_date).select(
        "signal_id", "model_id", "signal_timestamp", "is_positive"
    )
    # A row of the dimension without action_id still repeats the fact row, but is no true positive.
    hits = actions.groupBy("signal_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("action_id").alias("_hits")
    )
    weighed = scope.join(hits, "signal_id", "left").select(
        day_of(F.col("signal_timestamp")).alias("day"),
        "model_id",
        F.coalesce("_rows", F.lit(1)).alias("_rows"),
        F.when(F.col("is_positive"), F.coalesce("_rows", F.lit(1))).otherwise(0).alias("_positives"),
        F.when(F.col("is_positive"), F.coalesce("_hits", F.lit(0))).otherwise(0).alias("_true"),
    )
    result = weighed.groupBy("day", "model_id").agg(
        F.sum("_rows").alias("total_signals"),
        F.sum("_positives").alias("predicted_positives"),
        F.sum("_true").alias("true_positives"),
    ).withColumn("precision", ratio(F.col("true_positives"), F.col("predicted_positives")))
    return _ordered(result, [F.desc("day"), F.asc("model_id")], row_limit)


def enforcement_rate(
    fact: DataFrame,
    actions: DataFrame,
    action_type: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    row_limit: int | None = None,
) -> DataFrame:
    """Daily actions of a type against that day's signals. Both sides reduce to days before they meet."""
    totals = (
        in_range(fact, "signal_timestamp", start_date, end_date)
        .groupBy(day_of(F.col("signal_timestamp")).alias("day"))
        .agg(F.count(F.lit(1)).alias("total_signals"))
    )
    acted = (
        in_range(_equal(actions, "action_type", action_type), "action_timestamp", start_date, end_date)
        .groupBy(day_of(F.col("action_timestamp")).alias("day"), "action_type")
        .agg(F.count(F.lit(1)).alias("enforcement_count"))
    )
    result = acted.join(totals, "day").select(
        "day", "action_type", "enforcement_count", "total_signals",
        ratio(F.col("enforcement_count"), F.col("total_signals")).alias("enforcement_rate"),
    )
    return _ordered(result, [F.desc("day"), F.asc("action_type")], row_limit)


def report_volume(
    signals: DataFrame,
    report_type: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    row_limit: int | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Hourly reports by type and severity with distinct reporters and reported entities."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    scope = in_range(
        _equal(signals.filter(F.col("signal_type") == "report"), "report_type", report_type),
        "signal_timestamp", start_date, end_date,
    )
    result = scope.groupBy(hour_of(F.col("signal_timestamp")).alias("hour"), "report_type", "severity").agg(
        F.count(F.lit(1)).alias("report_count"),
        distinct("reporter_id").alias("unique_reporters"),
        distinct("reported_entity_id").alias("unique_entities_reported"),
    )
    keys = [F.desc("hour"), F.desc("report_count"), F.asc("report_type"), F.asc("severity")]
    return _ordered(result, keys, row_limit)


@dataclass(frozen=True)
class Metric:
    """A named metric: its DataFrame function, the relations it reads and its required parameters."""

    build: Callable[..., DataFrame]
    relations: tuple[str, ...]
    parameters: dict[str, type] = field(default_factory=dict)


class MetricRegistry:
    """Named metrics with required, type-checked parameters.

    Parameters reach the plan as typed literals; no SQL text is assembled.
    """

    def __init__(self) -> None:
        self._metrics: dict[str, Metric] = {}

    def register(self, name: str, metric: Metric) -> None:
        self._metrics[name] = metric

    def names(self) -> list[str]:
        return sorted(self._metrics)

    def run(
        self, name: str, relation: Callable[[str], DataFrame], row_limit: int | None = None, **params: Any
    ) -> DataFrame:
        """Build a metric. ``relation`` gives the DataFrame of a relation by name."""
        metric = self._metrics.get(name)
        if metric is None:
            raise ValueError(f"unknown metric {name!r}; registered: {', '.join(self.names())}")
        for parameter, kind in metric.parameters.items():
            if parameter not in params:
                raise KeyError(f"metric {name!r} requires parameter {parameter!r}")
            value = params[parameter]
            if not isinstance(value, kind):
                raise TypeError(f"{parameter!r} of metric {name!r} must be {kind.__name__}, not {type(value).__name__}")
        frames = [relation(needed) for needed in metric.relations]
        chosen = {parameter: params[parameter] for parameter in metric.parameters}
        return metric.build(*frames, **chosen, row_limit=row_limit)


metrics = MetricRegistry()
_RANGE = {"start_date": str, "end_date": str}
metrics.register(
    "classifier_precision",
    Metric(classifier_precision, ("fct_signals", "dim_actions"), {"model_id": str, **_RANGE}),
)
metrics.register(
    "enforcement_rate",
    Metric(enforcement_rate, ("fct_signals", "dim_actions"), {"action_type": str, **_RANGE}),
)
metrics.register(
    "report_volume",
    Metric(report_volume, ("fct_signals_all",), {"report_type": str, **_RANGE}),
)


def sql_retrieve(
    name: str, relation: Callable[[str], DataFrame], row_limit: int = SQL_ROW_LIMIT, **params: Any
) -> DataFrame:
    """Metric rows as retrieval context: tagged with their source and cut to the context limit."""
    return metrics.run(name, relation, row_limit=row_limit, **params).withColumn("source", F.lit("sql"))
