"""Signal-to-action interval join: actions on the same entity within N hours after the signal.

The time range becomes an equality key: time is cut into slices as wide as the interval, a signal keeps
its own slice, and each action is offered to its slice and the one before. A signal then meets every
action of its interval exactly once, the join is a plain equi join on (entity, slice) with the range as
a residual, and an entity holding a large share of the rows is spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sigmart.functions.time import hour_index, hours_after
from sigmart.schemas import ACTION_WINDOW_HOURS

ACTION_FIELDS = ["action_id", "action_type", "policy_id", "enforced_by", "enforcement_reason", "action_timestamp"]


def with_was_enforced(df: DataFrame) -> DataFrame:
    """A positive signal with an action. Never NULL."""
    acted = F.col("is_positive") & F.col("action_id").isNotNull()
    return df.withColumn("was_enforced", F.coalesce(acted, F.lit(False)))


def signal_slice(ts: Column, hours: int) -> Column:
    return F.floor(hour_index(ts) / hours)


def action_slices(ts: Column, hours: int) -> Column:
    """The slices whose signals can reach an action at ``ts``; one row per slice."""
    own = signal_slice(ts, hours)
    return F.explode(F.array(own, own - 1))


def action_side(actions: DataFrame) -> DataFrame:
    return actions.select(
        "entity_id", "action_id", "action_type", "policy_id", "enforced_by",
        F.col("reason").alias("enforcement_reason"), "action_timestamp",
    )


def enrich_signals(
    signals: DataFrame, actions: DataFrame, hours: int = ACTION_WINDOW_HOURS, multi: str = "all"
) -> DataFrame:
    """Left outer interval join of staged signals and staged enforcement.

    ``multi="all"`` keeps every signal-action pair; ``multi="first"`` keeps each signal's earliest action
    (ties by ``action_id``) and never builds the pairs.
    """
    if hours < 1:
        raise ValueError("hours must be at least 1")
    if multi == "all":
        joined = _all_pairs(signals, actions, hours)
    elif multi == "first":
        joined = _first_action(signals, actions, hours)
    else:
        raise ValueError(f"multi must be 'all' or 'first', got {multi!r}")
    return with_was_enforced(joined)


def _all_pairs(signals: DataFrame, actions: DataFrame, hours: int) -> DataFrame:
    left = signals.withColumn("_slice", signal_slice(F.col("signal_timestamp"), hours)).alias("s")
    right = (
        action_side(actions)
        .filter(F.col("entity_id").isNotNull() & F.col("action_timestamp").isNotNull())
        .withColumn("_slice", action_slices(F.col("action_timestamp"), hours))
        .alias("a")
    )
    start = F.col("s.signal_timestamp")
    condition = (
        (F.col("s.entity_id") == F.col("a.entity_id"))
        & (F.col("s._slice") == F.col("a._slice"))
        & F.col("a.action_timestamp").between(start, hours_after(start, hours))
    )
    return left.join(right, condition, "left").select(
        *[F.col(f"s.{name}") for name in signals.columns], *[F.col(f"a.{name}") for name in ACTION_FIELDS]
    )


def reached_signals(signals: DataFrame, actions: DataFrame, hours: int = ACTION_WINDOW_HOURS) -> DataFrame:
    """The signals with an action among ``actions`` in their interval, each once. Same keys as the join."""
    left = signals.withColumn("_slice", signal_slice(F.col("signal_timestamp"), hours)).alias("s")
    right = actions.select("entity_id", "action_timestamp", action_slices(F.col("action_timestamp"), hours).alias("_slice")).alias("a")
    start = F.col("s.signal_timestamp")
    condition = (
        (F.col("s.entity_id") == F.col("a.entity_id"))
        & (F.col("s._slice") == F.col("a._slice"))
        & F.col("a.action_timestamp").between(start, hours_after(start, hours))
    )
    return left.join(right, condition, "left_semi").drop("_slice")


def _first_action(signals: DataFrame, actions: DataFrame, hours: int) -> DataFrame:
    """Next action at or after each signal, without pairing signals with actions.

    Both sides shrink first to distinct (entity, instant) points. Points are ordered inside one-hour
    slices of an entity, which carries an action back to earlier points of the slice; the first action of
    each slice is then carried back over the (few) slices of the entity. No window holds more than the
    distinct instants of one entity's hour, or one entity's hours.
    """
    first_at = (
        action_side(actions)
        .filter(F.col("entity_id").isNotNull() & F.col("action_timestamp").isNotNull())
        .groupBy("entity_id", F.col("action_timestamp").alias("_at"))
        .agg(F.min(F.struct(*ACTION_FIELDS)).alias("_action"))
        .withColumn("_kind", F.lit(1))
    )
    asked = (
        signals.select("entity_id", F.col("signal_timestamp").alias("_at"))
        .filter(F.col("entity_id").isNotNull() & F.col("_at").isNotNull())
        .distinct()
        .withColumn("_kind", F.lit(0))
    )
    points = asked.unionByName(first_at, allowMissingColumns=True).withColumn("_slice", hour_index(F.col("_at")))

    # Latest first; an action sorts before a signal of the same instant, so it still counts for it.
    inside = (
        Window.partitionBy("entity_id", "_slice")
        .orderBy(F.col("_at").desc(), F.col("_kind").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_slice = points.groupBy("entity_id", "_slice").agg(F.min_by("_action", F.when(F.col("_action").isNotNull(), F.col("_at"))).alias("_head"))
    later = (
        Window.partitionBy("entity_id")
        .orderBy(F.col("_slice").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_slice.select(
        "entity_id", "_slice", F.last("_head", ignorenulls=True).over(later).alias("_carry")
    )
    found = (
        points.withColumn("_here", F.last("_action", ignorenulls=True).over(inside))
        .filter(F.col("_kind") == 0)
        .join(carried, ["entity_id", "_slice"], "left")
        .select("entity_id", "_at", F.coalesce("_here", "_carry").alias("_next"))
        .filter(F.col("_next.action_timestamp") <= hours_after(F.col("_at"), hours))
        .alias("f")
    )
    left = signals.alias("s")
    return left.join(
        found,
        (F.col("s.entity_id") == F.col("f.entity_id")) & (F.col("s.signal_timestamp") == F.col("f._at")),
        "left",
    ).select(
        *[F.col(f"s.{name}") for name in signals.columns],
        *[F.col(f"f._next.{name}").alias(name) for name in ACTION_FIELDS],
    )
