"""Dashboard numbers as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sigmart.functions.text import title_label
from sigmart.functions.time import day_of, hour_of, hours_after, minutes_after, ntz
from sigmart.operators.marts import count_where
from sigmart.operators.metrics import ratio
from sigmart.schemas import FRESHNESS_WINDOW_MINUTES, UNKNOWN_TYPE_WINDOW_MINUTES

HISTOGRAM_BINS = 10


def in_last_hours(column: str, as_of: str, hours: int = 24) -> Column:
    """Later than ``as_of`` minus the hours, up to ``as_of``. Both bounds are constants for the scan."""
    return (F.col(column) > hours_after(ntz(as_of), -hours)) & (F.col(column) <= ntz(as_of))


def signals_24h(signals: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    return signals.filter(in_last_hours("_loaded_at", as_of, hours)).agg(F.count(F.lit(1)).alias("signals"))


def dead_letters_24h(dead: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    return dead.filter(in_last_hours("failed_at", as_of, hours)).agg(F.count(F.lit(1)).alias("dead_letters"))


def avg_confidence(runs: DataFrame) -> DataFrame:
    return runs.agg(F.avg("confidence_score").alias("avg_confidence"))


def retry_rate(runs: DataFrame) -> DataFrame:
    return runs.agg(ratio(count_where(F.col("retry_count") > 0), F.count(F.lit(1))).alias("retry_rate"))


def signal_volume(signals: DataFrame, every: str = "day") -> DataFrame:
    """Signals by type over time. ``every`` is ``hour`` or ``day``."""
    buckets = {"hour": hour_of, "day": day_of}
    if every not in buckets:
        raise ValueError(f"every must be 'hour' or 'day', not {every!r}")
    bucket = buckets[every](F.col("signal_timestamp"))
    return signals.groupBy(bucket.alias(every), "signal_type").agg(F.count(F.lit(1)).alias("signals"))


def strategy_distribution(runs: DataFrame) -> DataFrame:
    """Runs per strategy with its share of all runs."""
    counts = runs.groupBy("retrieval_strategy").agg(F.count(F.lit(1)).alias("runs"))
    total = runs.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", ratio(F.col("runs"), total))


def confidence_histogram(runs: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Scored runs per bin of width 1/bins; a score of 1 belongs to the last bin."""
    position = F.least(F.floor(F.col("confidence_score") * bins), F.lit(bins - 1)).cast("bigint")
    return (
        runs.filter(F.col("confidence_score").isNotNull())
        .groupBy(position.alias("bin"))
        .agg(F.count(F.lit(1)).alias("runs"))
    )


def retry_trend(runs: DataFrame) -> DataFrame:
    return runs.groupBy(day_of(F.col("started_at")).alias("day")).agg(
        F.count(F.lit(1)).alias("runs"),
        ratio(count_where(F.col("retry_count") > 0), F.count(F.lit(1))).alias("retry_rate"),
    )


def latest_loaded(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal_type").agg(F.max("_loaded_at").alias("latest_timestamp"))


def freshness(signals: DataFrame, as_of: str, windows: dict[str, int] | None = None) -> DataFrame:
    """Per signal type: is the latest load within its window? Types without any record are stale.

    An override of 0 means the default; a type without a default has one hour. A load after ``as_of``
    counts as fresh.
    """
    known = dict(FRESHNESS_WINDOW_MINUTES)
    known.update({kind: minutes for kind, minutes in (windows or {}).items() if minutes})
    listed = signals.sparkSession.createDataFrame(list(known.items()), "signal_type string, window_minutes int")
    joined = latest_loaded(signals).join(listed, "signal_type", "full")
    window = F.coalesce("window_minutes", F.lit(UNKNOWN_TYPE_WINDOW_MINUTES))
    oldest = minutes_after(ntz(as_of), -window)
    return joined.select(
        "signal_type",
        F.coalesce(F.col("latest_timestamp") >= oldest, F.lit(False)).alias("is_fresh"),
        "latest_timestamp",
        window.alias("window_minutes"),
        ntz(as_of).alias("checked_at"),
    )


def freshness_gauges(fresh: DataFrame) -> DataFrame:
    """Whole minutes since the latest load against the window, with a display label."""
    behind = F.col("checked_at") - F.col("latest_timestamp")
    seconds = F.extract(F.lit("DAY"), behind) * 86400 + F.extract(F.lit("HOUR"), behind) * 3600 \
        + F.extract(F.lit("MINUTE"), behind) * 60 + F.extract(F.lit("SECOND"), behind)
    return fresh.select(
        "signal_type",
        title_label(F.col("signal_type")).alias("label"),
        F.floor(seconds / 60).cast("bigint").alias("minutes_since"),
        "window_minutes",
        F.when(F.col("is_fresh"), F.lit("fresh")).otherwise(F.lit("stale")).alias("status"),
    )
