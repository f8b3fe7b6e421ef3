"""Streaming jobs that lose no late row.

A stateful operator drops rows behind its watermark without a trace. Here every micro-batch is split before it gets
there: rows not newer than the newest one of earlier batches less the delay go to a side table, the others to a folder
that the stateful query streams from. That query runs to the end of its input after every split, so its watermark is
never beyond the mark its rows were split by, and it drops nothing. The batch operators then merge the side table into
what the stream wrote, and, once the input has ended, close what still waits in the stream's state.

Every split is addressed by its batch and decided by the marks of earlier ones, so a batch repeated after a failure
finds what it has written and leaves it alone; the stateful query's own sink is exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from sigmart.operators.enrich import ACTION_FIELDS, enrich_signals, reached_signals
from sigmart.schemas import ACTION_WINDOW_HOURS
from sigmart.sources.writers import path_exists
from sigmart.streaming import jobs

SIGNAL_KEY = ["signal_id", "entity_id", "signal_timestamp"]
SKETCH_BITS = 14  # a distinct count's relative error is about 0.8 % beyond a few thousand, and next to none below
MARKS = "feed string, newest timestamp_ntz, batch_id int"


@dataclass(frozen=True)
class Feed:
    """A stream with its event time and how long a row may come behind the newest one."""

    stream: DataFrame
    column: str
    delay: str


class SplitStream:
    """Feeds split batch by batch under ``path``; the tables are ``<path>/<feed>/batch_id=<n>/late=<0 or 1>``."""

    def __init__(self, path: str, **feeds: Feed) -> None:
        self.path, self.feeds = path, feeds
        self.spark: SparkSession = next(iter(feeds.values())).stream.sparkSession

    def start(self, checkpoint: str, after: Callable[[], None], every: str | None = None) -> StreamingQuery:
        """Split what arrives; ``after`` runs at the end of each batch. One job takes all feeds, so their batches go together."""
        tagged = [feed.stream.select(F.struct(*feed.stream.columns).alias(f"_{name}")) for name, feed in self.feeds.items()]
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

        def write(batch: DataFrame, batch_id: int) -> None:
            for name in self.feeds:
                self._split(batch.filter(F.col(f"_{name}").isNotNull()).select(f"_{name}.*"), name, batch_id)
            self._mark(batch_id)
            after()

        return jobs.start(both, checkpoint, write, every=every)

    def _split(self, rows: DataFrame, name: str, batch_id: int) -> None:
        folder = jobs.batch_path(f"{self.path}/{name}", batch_id)
        if path_exists(self.spark, f"{folder}/_SUCCESS"):
            return
        feed = self.feeds[name]
        newest = None
        if batch_id and path_exists(self.spark, f"{self.path}/marks"):
            marks = self.spark.read.schema(MARKS).parquet(f"{self.path}/marks")
            newest = marks.filter((F.col("feed") == name) & (F.col("batch_id") < batch_id)).agg(F.max("newest")).first()[0]
        # A row without event time has no place in a window; the batch operator decides on it.
        late = F.col(feed.column).isNull()
        if newest is not None:
            late = late | (F.col(feed.column) <= F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {feed.delay}"))
        rows.withColumn("late", late.cast("int")).write.mode("overwrite").partitionBy("late").parquet(folder)

    def _mark(self, batch_id: int) -> None:
        newest = [
            self._read(name).filter(F.col("batch_id") == batch_id).agg(F.max(feed.column).alias("newest")).select(F.lit(name).alias("feed"), "newest")
            for name, feed in self.feeds.items()
        ]
        reduce(DataFrame.unionByName, newest).coalesce(1).write.mode("overwrite").parquet(jobs.batch_path(f"{self.path}/marks", batch_id))

    def _read(self, name: str) -> DataFrame:
        schema = StructType([*self.feeds[name].stream.schema.fields]).add("batch_id", IntegerType()).add("late", IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def rows(self, name: str, late: bool | None = None) -> DataFrame:
        """What has arrived of a feed: all of it, the late rows, or the others."""
        rows = self._read(name)
        return (rows if late is None else rows.filter(F.col("late") == int(late))).drop("batch_id", "late")

    def on_time(self, name: str) -> DataFrame:
        """The rows that are not late, as a stream."""
        return self.spark.readStream.schema(self.feeds[name].stream.schema).parquet(f"{self.path}/{name}/*/late=0")

    def run(self, stream: DataFrame, table: str, checkpoint: str) -> None:
        """Run a stateful query over the rows that are not late to the end of its input, into a table."""
        stream.writeStream.format("parquet").option("path", f"{self.path}/{table}").option(
            "checkpointLocation", f"{checkpoint}/{table}").trigger(availableNow=True).start().awaitTermination()

    def written(self, table: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")


class EnrichJob:
    """Left outer interval join of two streams, late rows of either side included."""

    def __init__(self, signals: DataFrame, actions: DataFrame, path: str, hours: int = ACTION_WINDOW_HOURS,
                 signal_delay: str = "1 hour", action_delay: str = "1 hour") -> None:
        self.hours, self.delays = hours, (signal_delay, action_delay)
        self.split = SplitStream(path, signals=Feed(signals, "signal_timestamp", signal_delay),
                                 actions=Feed(actions, "action_timestamp", action_delay))

    def _joined(self) -> DataFrame:
        return jobs.enrich_stream(self.split.on_time("signals"), self.split.on_time("actions"), self.hours, *self.delays)

    def start(self, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return self.split.start(f"{checkpoint}/split", lambda: self.split.run(self._joined(), "pairs", checkpoint), every)

    def result(self, closed: bool = False) -> DataFrame:
        """The rows known so far; with ``closed``, no more rows are awaited and every signal is there.

        The stream's pairs stay as they are. Late actions add pairs with signals that were in time, late signals are
        joined with all actions, and a signal that got an action this way is no longer unmatched.
        """
        out = self.split.written("pairs", self._joined().schema)
        signals, late_actions = self.split.rows("signals", late=False), self.split.rows("actions", late=True)
        reached = enrich_signals(reached_signals(signals, late_actions, self.hours), late_actions, self.hours)
        late = enrich_signals(self.split.rows("signals", late=True), self.split.rows("actions"), self.hours)
        known = F.col("action_timestamp").isNotNull()
        matched = out.filter(known).unionByName(reached.filter(known))
        if closed:
            unmatched = _without(signals, matched).withColumns({
                name: F.lit(None).cast(out.schema[name].dataType) for name in ACTION_FIELDS}).withColumn("was_enforced", F.lit(False))
        else:
            unmatched = _without(out.filter(~known), reached.filter(known))
        return matched.unionByName(unmatched.select(*out.columns)).unionByName(late.select(*out.columns))


def _without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The signals among ``rows`` that are not among ``others``; null keys are equal to each other."""
    seen = others.select(*(F.col(name).alias(f"_{name}") for name in SIGNAL_KEY)).distinct()
    same = [rows[name].eqNullSafe(seen[f"_{name}"]) for name in SIGNAL_KEY]
    return rows.join(seen, reduce(lambda a, b: a & b, same), "left_anti")


class UniqueJob:
    """One row for each key of a stream, late deliveries included."""

    def __init__(self, signals: DataFrame, path: str, delay: str = "24 hours", key: str = "signal_id") -> None:
        self.key, self.delay = key, delay
        self.split = SplitStream(path, signals=Feed(signals, "signal_timestamp", delay))

    def _unique(self) -> DataFrame:
        return jobs.unique_signals(self.split.on_time("signals"), self.delay, self.key)

    def start(self, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return self.split.start(f"{checkpoint}/split", lambda: self.split.run(self._unique(), "unique", checkpoint), every)

    def result(self) -> DataFrame:
        """What the stream kept, and of late rows the first by time for every key it never kept."""
        out = self.split.written("unique", self._unique().schema)
        late = self.split.rows("signals", late=True)
        first = F.min_by(F.struct(*late.columns), F.struct(F.coalesce("signal_timestamp", F.lit("9999-12-31").cast("timestamp_ntz")), F.xxhash64(*late.columns)))
        late = late.groupBy(F.col(self.key).alias("_key")).agg(first.alias("_row")).select("_row.*")
        kept = out.select(F.col(self.key).alias("_kept"))
        return out.unionByName(late.join(kept, late[self.key].eqNullSafe(kept["_kept"]), "left_anti").select(*out.columns))


class VolumeJob:
    """Signals and distinct entities per window; the windows' states are sketches, which late rows are merged into."""

    def __init__(self, signals: DataFrame, path: str, width: str = "1 hour", delay: str = "1 hour",
                 by: tuple[str, ...] = ("signal_type",)) -> None:
        self.width, self.delay, self.by = width, delay, by
        self.split = SplitStream(path, signals=Feed(signals, "signal_timestamp", delay))

    def _counted(self, signals: DataFrame) -> DataFrame:
        return signals.groupBy(F.window("signal_timestamp", self.width).alias("_window"), *self.by).agg(
            F.count(F.lit(1)).alias("signals"), F.hll_sketch_agg("entity_id", SKETCH_BITS).alias("sketch"),
        ).select(F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
                 F.col("_window.end").cast("timestamp_ntz").alias("window_end"), *self.by, "signals", "sketch")

    def _windows(self) -> DataFrame:
        return self._counted(jobs.with_event_time(self.split.on_time("signals"), "signal_timestamp", self.delay))

    def start(self, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return self.split.start(f"{checkpoint}/split", lambda: self.split.run(self._windows(), "windows", checkpoint), every)

    def result(self, closed: bool = False) -> DataFrame:
        """window_start, window_end, the ``by`` columns, signals and entities (estimated) of the windows closed so far.

        With ``closed``, no more rows are awaited and the windows still open are counted too. Rows without event time
        belong to no window.
        """
        out = self.split.written("windows", self._windows().schema)
        parts = [out, self._counted(self.split.rows("signals", late=True))]
        names = ["window_start", *self.by]
        if closed:
            done = out.select(*(F.col(name).alias(f"_{name}") for name in names))
            waiting = self._counted(self.split.rows("signals", late=False))
            same = [waiting[name].eqNullSafe(done[f"_{name}"]) for name in names]
            parts.append(waiting.join(done, reduce(lambda a, b: a & b, same), "left_anti"))
        merged = reduce(DataFrame.unionByName, parts).groupBy("window_start", "window_end", *self.by)
        return merged.agg(F.sum("signals").alias("signals"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("entities"))
