"""Incremental fact load: rows past the watermark, merged into the fact by key."""

from __future__ import annotations

import math
import re
from datetime import date, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sigmart.functions.time import day_of, hours_after, minutes_after
from sigmart.operators.enrich import enrich_signals, reached_signals
from sigmart.operators.marts import fct_signals
from sigmart.operators.quality import schema_guard
from sigmart.schemas import ACTION_WINDOW_HOURS
from sigmart.sources.writers import path_exists, write_fact

BEGINNING = "0001-01-01 00:00:00"
BUCKET_KEYS = 4_000_000  # keys in a bucket of a fact's index, about


def since_watermark(
    df: DataFrame,
    target: DataFrame,
    column: str = "_loaded_at",
    lookback_minutes: int = 0,
    reprocess_hours: int = 0,
    event_column: str = "signal_timestamp",
) -> DataFrame:
    """Rows loaded strictly after the target's newest load; all rows when the target is empty.

    ``lookback_minutes`` moves the mark back; ``reprocess_hours`` also takes rows whose event time is that
    close to the mark. Merging by key makes both harmless. Neither finds what arrives later still: a load
    that must not miss anything follows :func:`changed_signals`.
    The mark is a scalar subquery of the plan, not a value fetched by the driver.
    """
    newest = target.select(F.coalesce(F.max(column), F.lit(BEGINNING).cast("timestamp_ntz"))).scalar()
    mark = minutes_after(newest, -lookback_minutes) if lookback_minutes else newest
    recent = F.col(column) > mark
    if reprocess_hours:
        recent = recent | (F.col(event_column) >= hours_after(newest, -reprocess_hours))
    return df.filter(recent)


def changed_signals(
    signals: DataFrame, new_signals: DataFrame | None, new_actions: DataFrame | None, hours: int = ACTION_WINDOW_HOURS
) -> DataFrame | None:
    """The staged signals whose fact rows a load can change: new ones, and any that a new action reaches.

    A signal may come twice, as new and as reached; the merge keeps one. None when nothing is new.
    """
    parts = [] if new_signals is None else [new_signals]
    if new_actions is not None:
        parts.append(reached_signals(signals, new_actions, hours).select(*signals.columns))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def latest_per_key(df: DataFrame, key: str, order: tuple[str, ...] = ("_loaded_at",)) -> DataFrame:
    """One row per key, the latest by ``order``. Candidates combine before the shuffle."""
    row = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.col(key).alias("_key")).agg(row.alias("_row")).select("_row.*")


def merge_fact(
    target: DataFrame, updates: DataFrame, key: str = "signal_id", order: tuple[str, ...] = ("_loaded_at", "action_id")
) -> DataFrame:
    """The target with every updated key replaced. Columns must match."""
    schema_guard(updates.select(*target.columns), target.schema)
    newest = latest_per_key(updates.select(*target.columns), key, order)
    return target.join(newest.select(key), key, "left_anti").select(*target.columns).unionByName(newest)


def keys_path(path: str) -> str:
    """Where the key index of a fact is kept."""
    return f"{path.rstrip('/')}_keys"


def _bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return rows.select(F.col(key).alias("key"), "signal_day", F.lit(buckets).alias("buckets"), bucket.alias("bucket"))


def write_key_index(spark: SparkSession, path: str, key: str = "signal_id", bucket_keys: int = BUCKET_KEYS) -> None:
    """The days of every key of a fact, in folders by hash of the key, about ``bucket_keys`` keys each."""
    held = spark.read.parquet(path).select(key, "signal_day")
    buckets = max(8, 1 << math.ceil(math.log2(max(1, held.count()) / bucket_keys + 1)))
    _bucketed(held, key, buckets).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("buckets", "bucket").parquet(keys_path(path))


def held_days(spark: SparkSession, path: str, fresh: DataFrame, key: str = "signal_id") -> tuple[DataFrame, int]:
    """Every (key, day) the index has of keys in ``fresh``, and its number of buckets. Reads the buckets of those keys alone."""
    index = spark.read.parquet(keys_path(path))
    buckets = int(re.search(r"/buckets=([0-9]+)/", index.inputFiles()[0])[1])
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    asked = sorted(row[0] for row in fresh.select(bucket).distinct().collect())  # at most one number for each bucket
    index = index.filter((F.col("buckets") == buckets) & F.col("bucket").isin(asked)).select("key", "signal_day")
    return index.join(fresh.select(F.col(key).alias("key")), "key", "left_semi"), buckets


def upsert_fact(
    spark: SparkSession, path: str, updates: DataFrame, staging: str, key: str = "signal_id",
    order: tuple[str, ...] = ("_loaded_at", "action_id"),
) -> set[date | None]:
    """Merge into a fact written by ``write_fact``, rewriting only the days that hold an updated key; returns these days.

    An index beside the fact tells the days of a key, so the other days are not read. ``staging`` is a new folder on shared
    storage. The merged days are written there first and replace the table's days in a second write that no
    longer reads the table, so a lost executor or a failed job leaves either the old days or the staged ones to rerun
    from. New keys are indexed before the fact is written: a load that fails leaves the index with days too many,
    never too few.
    """
    if not path_exists(spark, path):
        write_fact(latest_per_key(updates, key, order), path)
        write_key_index(spark, path, key)
        return days_of(spark.read.parquet(path), "signal_day")
    if not path_exists(spark, keys_path(path)):
        write_key_index(spark, path, key)
    target = spark.read.parquet(path)
    dated = updates.withColumn("signal_day", day_of(F.col("signal_timestamp")).cast("date"))
    latest_per_key(dated, key, order).write.mode("overwrite").parquet(f"{staging}/updates")
    fresh = spark.read.schema(target.schema).parquet(f"{staging}/updates")

    found, buckets = held_days(spark, path, fresh, key)
    found.write.mode("overwrite").parquet(f"{staging}/held")
    held = spark.read.schema(found.schema).parquet(f"{staging}/held")
    # one value per touched day partition
    touched = {row[0] for row in held.select("signal_day").union(fresh.select("signal_day")).distinct().collect()}
    if not touched:
        return touched
    new = fresh.select(F.col(key).alias("key"), "signal_day").join(held, ["key", "signal_day"], "left_anti")
    _bucketed(new, "key", buckets).hint("rebalance", "bucket").write.mode("append").partitionBy("buckets", "bucket").parquet(keys_path(path))

    merged = merge_fact(target.filter(in_days("signal_day", touched)), fresh, key, order)
    merged.write.mode("overwrite").parquet(f"{staging}/merged")
    staged = spark.read.schema(target.schema).parquet(f"{staging}/merged")
    emptied = touched - {row[0] for row in staged.select("signal_day").distinct().collect()}
    staged.hint("rebalance", "signal_day").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("signal_day").parquet(path)
    for day in sorted(day for day in emptied if day is not None):  # a day whose signals all moved keeps a folder without rows
        staged.drop("signal_day").limit(0).write.mode("overwrite").parquet(f"{path}/signal_day={day}")
    return touched


# -- loads that read what they touch -----------------------------------------------------------


def in_days(column: str, days: set[date | None]) -> Column:
    """Rows of these days, for a column that tables are partitioned by: folders of other days are not read."""
    chosen = F.col(column).isin(sorted(day for day in days if day is not None))
    return chosen | F.col(column).isNull() if None in days else chosen


def days_of(df: DataFrame | None, column: str) -> set[date | None]:
    """The distinct days of a time column: one value for each day of a load."""
    return set() if df is None else {row[0] for row in df.select(F.col(column).cast("date")).distinct().collect()}


def days_around(days: set[date | None], first: int, last: int) -> set[date]:
    return {day + timedelta(days=shift) for day in days if day is not None for shift in range(first, last + 1)}


def stage_by_day(rows: DataFrame, column: str, day: str, path: str) -> None:
    """One load of staged rows, in folders by event day; a repeated load replaces itself."""
    dated = rows.withColumn(day, F.col(column).cast("date"))
    dated.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(path)


class LoadDays(NamedTuple):
    """The signals' days that a load has read, and those of the fact that it has written."""

    read: set[date | None]
    written: set[date | None]


def load_changes(
    spark: SparkSession, fact_path: str, signals: DataFrame, actions: DataFrame, new_signals: DataFrame | None,
    new_actions: DataFrame | None, staging: str, hours: int = ACTION_WINDOW_HOURS,
) -> LoadDays:
    """Bring a fact up to date with a load, reading only the days it touches.

    ``signals`` and ``actions`` hold everything staged so far, the load included, and are partitioned by ``signal_day`` and
    ``action_day``. An action reaches signals of its own day and of the days its interval goes back to; a signal asks for
    actions of its own day and of those its interval runs on to.
    """
    reach = -(-hours // 24)
    reached = days_around(days_of(new_actions, "action_timestamp"), -reach, 0)
    own = days_of(new_signals, "signal_timestamp")
    names = [name for name in signals.columns if name not in ("signal_day", "load")]
    changed = changed_signals(signals.filter(in_days("signal_day", reached)).select(*names),
                              None if new_signals is None else new_signals.select(*names), new_actions, hours)
    if changed is None:
        return LoadDays(set(), set())
    asked = days_around(reached | own, 0, reach)
    enriched = enrich_signals(changed, actions.filter(in_days("action_day", asked)), hours, multi="first")
    return LoadDays(reached | own, upsert_fact(spark, fact_path, fct_signals(enriched), staging))
