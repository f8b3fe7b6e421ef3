"""Streams over several files, each compared with its batch form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sigmart.operators.enrich import enrich_signals
from sigmart.operators.marts import fct_signals
from sigmart.streaming import jobs as S
from tests.test_validation import record
from tests.test_warehouse import ACTIONS, SIGNALS, START, action, brute_pairs, events, signal


def files(spark, tmp_path, name: str, rows: list, schema: str, at: int, parts: int = 3):
    """Rows in time order over several files, read as a stream of one file per batch."""
    path = str(tmp_path / name)
    ordered = sorted(rows, key=lambda row: row[at])
    size = -(-len(ordered) // parts)
    for n in range(parts):
        part = spark.createDataFrame(ordered[n * size:(n + 1) * size], schema)
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def save(path: str):
    return lambda batch, n: batch.write.mode("overwrite").parquet(S.batch_path(path, n))


def test_interval_join_matches_batch(spark, tmp_path):
    signals, actions = events(11, 200, 120, 0.4)
    # a late pair moves the watermark past every other interval
    late = START + dt.timedelta(days=30)
    for n in range(3):
        signals.append(signal(900 + n, "end", late + dt.timedelta(days=3 * n)))
        actions.append(action(900 + n, "end", late + dt.timedelta(days=3 * n)))
    joined = S.enrich_stream(
        files(spark, tmp_path, "signals", signals, SIGNALS, 7),
        files(spark, tmp_path, "actions", actions, ACTIONS, 6),
        signal_delay="60 days", action_delay="60 days",
    )
    S.start(joined, str(tmp_path / "cp"), save(str(tmp_path / "out"))).awaitTermination()
    pairs = spark.read.parquet(str(tmp_path / "out")).filter("action_id is not null")
    expected = brute_pairs(signals, actions, 24)
    assert sorted((r.signal_id, r.action_id) for r in pairs.collect()) == sorted(
        (s, a) for s, hits in expected.items() for a in hits)


def test_unmatched_signals_appear_once_the_watermark_has_passed(spark, tmp_path):
    signals = [signal(0, "a", START), signal(1, "b", START + dt.timedelta(days=10)), signal(2, "c", START + dt.timedelta(days=20))]
    actions = [action(0, "x", START), action(1, "b", START + dt.timedelta(days=10)), action(2, "x", START + dt.timedelta(days=20))]
    joined = S.enrich_stream(files(spark, tmp_path, "signals", signals, SIGNALS, 7),
                             files(spark, tmp_path, "actions", actions, ACTIONS, 6))
    S.start(joined, str(tmp_path / "cp"), save(str(tmp_path / "out"))).awaitTermination()
    rows = {r.signal_id: r.action_id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {"s0": None, "s1": "a0001"}


def test_fact_stream_resumes_from_its_checkpoint(spark, tmp_path):
    signals, actions = events(4, 90, 60, 0.5)
    static = spark.createDataFrame(actions, ACTIONS)

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "signals"))
        S.fact_stream(source, lambda: static, str(tmp_path / "fact"), str(tmp_path / "staging"),
                      str(tmp_path / "cp")).awaitTermination()

    files(spark, tmp_path, "signals", signals[:60], SIGNALS, 7, parts=2)
    schema = spark.read.parquet(str(tmp_path / "signals")).schema
    run()
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 60
    spark.createDataFrame(signals[60:], SIGNALS).coalesce(1).write.mode("append").parquet(str(tmp_path / "signals"))
    run()
    got = spark.read.parquet(str(tmp_path / "fact")).drop("signal_day")
    want = fct_signals(enrich_signals(spark.createDataFrame(signals, SIGNALS), static, multi="first"))
    assert got.count() == 90 and got.exceptAll(want.select(*got.columns)).count() == 0


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    rows = [signal(n % 5, "e", START + dt.timedelta(minutes=n % 5)) for n in range(15)]
    stream = S.unique_signals(files(spark, tmp_path, "signals", rows, SIGNALS, 7))
    S.start(stream, str(tmp_path / "cp"), save(str(tmp_path / "out"))).awaitTermination()
    assert sorted(r.signal_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"s{n}" for n in range(5)]


def test_ingest_stream_splits_every_batch(spark, tmp_path):
    texts = [record("report", {}), record("report", {"severity": "urgent"}), record("report", {"report_type": "spam"})]
    (tmp_path / "in").mkdir()
    for n, text in enumerate(texts):
        (tmp_path / "in" / f"{n}.json").write_text(text + "\n")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in")).withColumnRenamed("value", "raw")
    S.ingest_stream(lines, "report", str(tmp_path / "valid"), str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "valid")).count() == 2
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_volume_windows_close_with_the_watermark(spark, tmp_path):
    rows = [signal(n, f"e{n % 4}", START + dt.timedelta(minutes=10 * n)) for n in range(60)]
    volume = S.volume_stream(files(spark, tmp_path, "signals", rows, SIGNALS, 7))
    S.start(volume, str(tmp_path / "cp"), save(str(tmp_path / "out"))).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert len(got) >= 7 and all(r.signals == 6 and r.entities == 4 for r in got)
    assert got[0].window_start == START and got[0].window_end == START + dt.timedelta(hours=1)


def test_freshness_after_each_batch(spark, tmp_path):
    rows = [signal(n, "e", START + dt.timedelta(hours=n)) for n in range(3)]
    stream = files(spark, tmp_path, "signals", rows, SIGNALS, 7)
    S.freshness_stream(stream, lambda: "2024-01-01 02:10:00", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    judged = spark.read.parquet(str(tmp_path / "out")).filter(F.col("signal_type") == "classifier").orderBy("batch_id").collect()
    assert [r.is_fresh for r in judged] == [False, False, True]


def test_queries_keep_old_rows_of_late_files(spark, tmp_path):
    """A table of 1,001 files, the newest rows first and the oldest day in the last file."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from sigmart.plans.queries import QUERIES

    schema = pq.read_schema("/root/testdata/sf0.001/events.parquet")
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    for n in range(1001):
        ts = START + dt.timedelta(days=90) if n < 1000 else START
        pair = [{"event_id": 2 * n + k, "user_id": n, "event_type": kind, "ts": ts, "props": "{}"} for k, kind in enumerate(("click", "error"))]
        pq.write_table(pa.Table.from_pylist([{name: row.get(name) for name in schema.names} for row in pair], schema), folder / f"{n:04}.parquet")
        os.utime(folder / f"{n:04}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    unique = QUERIES["stream_unique_signals"](spark, str(tmp_path))
    assert unique.count() == 1001 and unique.where("signal_id = 'sig-2000'").count() == 1
    pairs = QUERIES["stream_enriched_pairs"](spark, str(tmp_path))
    assert pairs.count() == 1001 and pairs.where("signal_id = 'sig-2000' AND action_id = 'act-2001'").count() == 1
