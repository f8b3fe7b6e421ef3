"""Streaming jobs over the same operators as the batch build.

Every job takes its checkpoint location from the caller and runs with ``availableNow`` by default: it
handles what has arrived and stops, so a scheduler may run it as often as it likes. Sinks written through
``foreachBatch`` are addressed by batch id, so a batch repeated after a failure replaces its own output.

Event time must be TIMESTAMP for watermarks; the jobs cast from and to TIMESTAMP_NTZ under a UTC session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sigmart.operators.enrich import (
    ACTION_FIELDS, action_side, action_slices, enrich_signals, signal_slice, with_was_enforced,
)
from sigmart.operators.envelope import load_batch
from sigmart.operators.incremental import changed_signals, upsert_fact
from sigmart.operators.marts import fct_signals
from sigmart.operators.observability import freshness
from sigmart.schemas import ACTION_WINDOW_HOURS
from sigmart.session import prepare

BatchWriter = Callable[[DataFrame, int], None]


def start(stream: DataFrame, checkpoint: str, write: BatchWriter, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Start a job; ``every`` gives a processing interval, otherwise it stops when the input is used up."""
    prepare(stream.sparkSession)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
        .trigger(**trigger).start()
    )


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


# -- ingestion -------------------------------------------------------------------------------


def ingest_stream(
    records: DataFrame, kind: str, valid_path: str, dead_path: str, checkpoint: str, source: str | None = None,
    raw: str = "raw", every: str | None = None,
) -> StreamingQuery:
    """Validate a stream of JSON records; valid envelopes and dead letters go to separate tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        loaded = load_batch(batch, kind, source, raw)
        loaded.checked.persist(StorageLevel.DISK_ONLY)  # both outputs read it; a lost block is validated again
        loaded.valid.write.mode("overwrite").parquet(batch_path(valid_path, batch_id))
        loaded.dead.write.mode("overwrite").parquet(batch_path(dead_path, batch_id))
        loaded.checked.unpersist()

    return start(records, checkpoint, write, every=every)


# -- interval join ---------------------------------------------------------------------------


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def enrich_stream(
    signals: DataFrame, actions: DataFrame, hours: int = ACTION_WINDOW_HOURS,
    signal_delay: str = "1 hour", action_delay: str = "1 hour",
) -> DataFrame:
    """Left outer interval join of two streams: an action may arrive before or after its signal.

    The range bounds the state: a signal waits until the action watermark has passed its interval, and only
    then appears unmatched. State is keyed by entity and time slice, so a busy entity is spread out.
    """
    left = with_event_time(
        signals.withColumn("_slice", signal_slice(F.col("signal_timestamp"), hours)), "signal_timestamp", signal_delay
    ).alias("s")
    right = with_event_time(
        action_side(actions).withColumn("_slice", action_slices(F.col("action_timestamp"), hours)),
        "action_timestamp", action_delay,
    ).alias("a")
    condition = (
        (F.col("s.entity_id") == F.col("a.entity_id"))
        & (F.col("s._slice") == F.col("a._slice"))
        & (F.col("a.action_timestamp") >= F.col("s.signal_timestamp"))
        & (F.col("a.action_timestamp") <= F.col("s.signal_timestamp") + F.expr(f"INTERVAL {hours} HOURS"))
    )
    kept = [F.col(f"s.{name}") for name in signals.columns] + [F.col(f"a.{name}") for name in ACTION_FIELDS]
    joined = with_was_enforced(left.join(right, condition, "leftOuter").select(*kept))
    return joined.withColumns({
        name: F.col(name).cast("timestamp_ntz") for name in ("signal_timestamp", "action_timestamp")
    })


# -- fact ------------------------------------------------------------------------------------


def unique_signals(signals: DataFrame, delay: str = "24 hours", key: str = "signal_id") -> DataFrame:
    """Drop repeated deliveries of a signal that arrive within the watermark."""
    timed = with_event_time(signals, "signal_timestamp", delay)
    unique = timed.dropDuplicatesWithinWatermark([key])
    return unique.withColumn("signal_timestamp", F.col("signal_timestamp").cast("timestamp_ntz"))


def fact_stream(
    signals: DataFrame, actions: Callable[[], DataFrame], fact_path: str, staging: str, checkpoint: str,
    hours: int = ACTION_WINDOW_HOURS, every: str | None = None, arriving_actions: DataFrame | None = None,
    all_signals: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge newly arrived signals into the fact. The checkpoint remembers what was loaded.

    ``actions`` gives the enforcement table as it stands when a batch runs. With ``arriving_actions``, the same table
    as a stream, and ``all_signals``, the signals as they stand, an action that arrives after its signal
    attaches to it: each batch also merges the signals that its actions reach. One job writes the fact, so
    both streams travel as one.
    """
    spark: SparkSession = signals.sparkSession
    names = signals.columns

    def merge(changed: DataFrame, batch_id: int) -> None:
        fact = fct_signals(enrich_signals(changed, actions(), hours, multi="first"))
        upsert_fact(spark, fact_path, fact, batch_path(staging, batch_id))

    if arriving_actions is None:
        return start(signals, checkpoint, merge, every=every)
    both = signals.select(F.struct(*names).alias("_signal")).unionByName(
        arriving_actions.select(F.struct("entity_id", "action_timestamp").alias("_action")), allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.filter(F.col("_signal").isNotNull()).select("_signal.*")
        late = batch.filter(F.col("_action").isNotNull()).select("_action.*")
        merge(changed_signals(all_signals().select(*names), new, late, hours), batch_id)

    return start(both, checkpoint, write, every=every)


# -- volume and freshness --------------------------------------------------------------------


def volume_stream(
    signals: DataFrame, width: str = "1 hour", delay: str = "1 hour", by: tuple[str, ...] = ("signal_type",)
) -> DataFrame:
    """Signals per tumbling window. Distinct entities are approximate, as streams cannot count them exactly."""
    timed = with_event_time(signals, "signal_timestamp", delay)
    return timed.groupBy(F.window("signal_timestamp", width).alias("_window"), *by).agg(
        F.count(F.lit(1)).alias("signals"), F.approx_count_distinct("entity_id").alias("entities"),
    ).select(
        F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_window.end").cast("timestamp_ntz").alias("window_end"), *by, "signals", "entities",
    )


def freshness_stream(
    signals: DataFrame, as_of: Callable[[], str], path: str, checkpoint: str,
    windows: dict[str, int] | None = None, every: str | None = None,
) -> StreamingQuery:
    """Keep the newest load per signal type, and judge it after every batch.

    A silent source starts no batch, so the scheduled batch check stays the one that must run.
    """
    latest = signals.groupBy("signal_type").agg(F.max("_loaded_at").alias("_loaded_at"))

    def write(batch: DataFrame, batch_id: int) -> None:
        freshness(batch, as_of(), windows).write.mode("overwrite").parquet(batch_path(path, batch_id))

    return start(latest, checkpoint, write, mode="complete", every=every)
