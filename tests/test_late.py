"""Streams whose batches come in any order of time: nothing is lost, and the result is the batch operator's."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from sigmart.operators.enrich import enrich_signals
from sigmart.streaming import late as L
from tests.test_warehouse import ACTIONS, SIGNALS, START, action, brute_pairs, events, signal


def dealt(spark, path: str, rows: list, schema: str, order: list[int], at: int):
    """Rows cut by time into as many files as ``order`` has, written in that order, streamed one a batch."""
    ordered = sorted(rows, key=lambda row: row[at])
    size = -(-len(ordered) // len(order))
    for part in order:
        spark.createDataFrame(ordered[part * size:(part + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_join_in_any_order_resumed_once(spark, tmp_path):
    signals, actions = events(5, 160, 120, 0.4)
    signals.append(signal(700, "nobody", START))
    path = str(tmp_path)

    def job():
        read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/{name}")
        return L.EnrichJob(read("signals", SIGNALS), read("actions", ACTIONS), f"{path}/job")

    dealt(spark, f"{path}/in/signals", signals[:100], SIGNALS, [1, 0], 7)
    dealt(spark, f"{path}/in/actions", actions[:70], ACTIONS, [0, 1], 6)
    job().start(f"{path}/cp").awaitTermination()
    dealt(spark, f"{path}/in/signals", signals[100:], SIGNALS, [0], 7)
    dealt(spark, f"{path}/in/actions", actions[70:], ACTIONS, [0], 6)
    again = job()
    again.start(f"{path}/cp").awaitTermination()

    assert again.split.rows("signals", late=True).count() and again.split.rows("actions", late=True).count()
    assert again.split.rows("signals").count() == len(signals)
    got = again.result(closed=True)
    expected = brute_pairs(signals, actions, 24)
    assert Counter((r.signal_id, r.action_id) for r in got.collect()) == Counter(
        (row[0], hit) for row in signals for hit in (expected.get(row[0]) or [None]))
    want = enrich_signals(spark.createDataFrame(signals, SIGNALS), spark.createDataFrame(actions, ACTIONS))
    assert got.select(*want.columns).exceptAll(want).count() == 0
    open_ = again.result()
    assert open_.exceptAll(got.select(*open_.columns)).count() == 0, "rows known before the end stay right"


def test_late_action_takes_back_an_unmatched_signal(spark, tmp_path):
    later = START + dt.timedelta(days=30)
    signals = [signal(0, "a", START), signal(1, "b", later), signal(2, "b", later + dt.timedelta(days=30)), signal(3, "c", START - dt.timedelta(days=9))]
    actions = [action(0, "z", START), action(1, "z", later), action(2, "z", later + dt.timedelta(days=30)), action(3, "a", START + dt.timedelta(hours=1))]
    path = str(tmp_path)
    for name, rows, schema in (("signals", signals, SIGNALS), ("actions", actions, ACTIONS)):
        for row in rows:
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{path}/in/{name}")
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/{name}")
    job = L.EnrichJob(read("signals", SIGNALS), read("actions", ACTIONS), f"{path}/job")
    job.start(f"{path}/cp").awaitTermination()
    written = {r.signal_id: r.action_id for r in job.split.written("pairs", job._joined().schema).collect()}
    assert written.get("s0", "waits") is None, "the stream has given the signal up"
    assert {r.signal_id: r.action_id for r in job.result(closed=True).collect()} == {"s0": "a0003", "s1": None, "s2": None, "s3": None}
    assert {r.signal_id: r.action_id for r in job.result().collect()}["s0"] == "a0003"


def test_unique_and_volume_in_any_order(spark, tmp_path):
    random.seed(3)
    rows = [signal(n % 40, f"e{n % 7}", START + dt.timedelta(hours=3 * (n % 40), minutes=n % 40)) for n in range(120)]
    random.shuffle(rows)
    path = str(tmp_path)
    for start in range(0, 120, 30):
        spark.createDataFrame(rows[start:start + 30], SIGNALS).coalesce(1).write.mode("append").parquet(f"{path}/in")
    read = lambda: spark.readStream.schema(SIGNALS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    unique = L.UniqueJob(read(), f"{path}/unique")
    unique.start(f"{path}/unique-cp").awaitTermination()
    assert sorted(r.signal_id for r in unique.result().collect()) == sorted(f"s{n}" for n in range(40))

    volume = L.VolumeJob(read(), f"{path}/volume", by=())
    volume.start(f"{path}/volume-cp").awaitTermination()
    assert volume.split.rows("signals", late=True).count() > 0
    hours = F.date_trunc("hour", "signal_timestamp").cast("timestamp_ntz").alias("window_start")
    want = spark.read.schema(SIGNALS).parquet(f"{path}/in").groupBy(hours).agg(
        F.count("*").alias("signals"), F.countDistinct("entity_id").alias("entities"))
    assert volume.result(closed=True).select(*want.columns).exceptAll(want).count() == 0
    assert volume.result(closed=True).count() == want.count()
