"""Loads that read what they touch: the key index of a fact, and staged days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sigmart.operators.enrich import enrich_signals
from sigmart.operators.incremental import (
    days_around, held_days, in_days, keys_path, load_changes, stage_by_day, upsert_fact, write_key_index,
)
from sigmart.operators.kept import daily_sums, kept_models, kept_precision, read_daily, refresh_daily
from sigmart.operators.marts import dim_models, fct_signals
from sigmart.operators.quality import field_drift
from sigmart.sources.writers import write_fact
from tests.test_validation import record
from tests.test_warehouse import ACTIONS, SIGNALS, START, action, events, signal

DAY = dt.timedelta(days=1)


def fact_of(spark, signals, actions):
    return fct_signals(enrich_signals(spark.createDataFrame(signals, SIGNALS), spark.createDataFrame(actions, ACTIONS), multi="first"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_follows_keys_that_move(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = {n: signal(n, "e", START + n * DAY) for n in range(12)}
    upsert_fact(spark, path, fact_of(spark, list(rows.values()), []), str(tmp_path / "s0"))
    for step, (number, days) in enumerate([(3, 9), (3, 1), (5, 9), (20, 2), (3, 9)]):
        rows[number] = signal(number, "e", START + days * DAY)
        upsert_fact(spark, path, fact_of(spark, [rows[number]], []), str(tmp_path / f"s{step + 1}"))
        got = {r.signal_id: r.signal_timestamp for r in spark.read.parquet(path).collect()}
        assert got == {f"s{n}": row[7] for n, row in rows.items()}
    held, _ = held_days(spark, path, fact_of(spark, [rows[3]], []))
    assert {(r.signal_day - START.date()).days for r in held.collect()} == {1, 3, 9}, "days too many, never too few"


def test_index_reads_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(fact_of(spark, [signal(n, "e", START + (n % 5) * DAY) for n in range(60)], []), path)
    write_key_index(spark, path, bucket_keys=4)
    fresh = fact_of(spark, [signal(7, "e", START)], [])
    held, buckets = held_days(spark, path, fresh)
    assert buckets == 16 and "bucket#" in plan_of(held).split("PartitionFilters: [")[1].split("]")[0]
    assert [(r.key, r.signal_day) for r in held.collect()] == [("s7", (START + 2 * DAY).date())]


def test_a_load_that_failed_before_the_fact_is_repeated(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_fact(spark, path, fact_of(spark, [signal(1, "e", START)], []), str(tmp_path / "s0"))
    ahead = spark.createDataFrame([("s1", (START + 4 * DAY).date(), 8, 0)], "key string, signal_day date, buckets int, bucket int")
    ahead = ahead.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(8)).cast("int"))
    ahead.write.mode("append").partitionBy("buckets", "bucket").parquet(keys_path(path))
    upsert_fact(spark, path, fact_of(spark, [signal(1, "e", START + 4 * DAY)], []), str(tmp_path / "s1"))
    assert [(r.signal_id, r.signal_timestamp) for r in spark.read.parquet(path).collect()] == [("s1", START + 4 * DAY)]


def test_loads_by_day_equal_one_full_load(spark, tmp_path):
    signals, actions = events(8, 150, 120, 0.4)
    path = str(tmp_path)
    staged = {"signals": (signals, SIGNALS, "signal_timestamp", "signal_day"), "actions": (actions, ACTIONS, "action_timestamp", "action_day")}
    for step in range(3):
        new = {}
        for name, (rows, schema, time, day) in staged.items():
            stage_by_day(spark.createDataFrame(rows[step::3], schema), time, day, f"{path}/{name}/load={step}")
            new[name] = spark.read.parquet(f"{path}/{name}/load={step}")
        days = load_changes(spark, f"{path}/fact", spark.read.parquet(f"{path}/signals"), spark.read.parquet(f"{path}/actions"),
                            new["signals"], new["actions"], f"{path}/staging-{step}")
        refresh_daily(spark, f"{path}/fact", f"{path}/daily", days.written if step else None)
    daily = read_daily(spark, f"{path}/daily")
    full = daily_sums(spark.read.parquet(f"{path}/fact")).drop("entities")
    assert daily.count() == full.count() and daily.select(*full.columns).exceptAll(full).count() == 0
    exact = {(r.model_id, r.n) for r in spark.read.parquet(f"{path}/fact").groupBy("model_id").agg(F.countDistinct("entity_id").alias("n")).collect()}
    assert {(r.model_id, r.entities) for r in kept_precision(daily, ("model_id",)).collect()} == exact
    models = dim_models(spark.read.parquet(f"{path}/fact"))
    same = [F.round(name, 9).alias(name) if name in ("avg_score", "positive_rate") else F.col(name) for name in models.columns]
    assert kept_models(daily).select(*same).exceptAll(models.select(*same)).count() == 0
    got, want = spark.read.parquet(f"{path}/fact").drop("signal_day"), fact_of(spark, signals, actions)
    assert got.count() == len(signals) and got.select(*want.columns).exceptAll(want).count() == 0


def test_a_load_of_one_action_reads_two_days(spark, tmp_path):
    path = str(tmp_path)
    stage_by_day(spark.createDataFrame([signal(n, "e", START + n * DAY) for n in range(20)], SIGNALS), "signal_timestamp", "signal_day", f"{path}/signals")
    late = spark.createDataFrame([action(1, "e", START + 10 * DAY + dt.timedelta(hours=1))], ACTIONS)
    stage_by_day(late, "action_timestamp", "action_day", f"{path}/actions")
    signals = spark.read.parquet(f"{path}/signals")
    upsert_fact(spark, f"{path}/fact", fact_of(spark, [signal(n, "e", START + n * DAY) for n in range(20)], []), f"{path}/s0")
    days = load_changes(spark, f"{path}/fact", signals, spark.read.parquet(f"{path}/actions"), None, late, f"{path}/s1")
    assert days.read == {(START + 9 * DAY).date(), (START + 10 * DAY).date()} and days.written == {(START + 10 * DAY).date()}
    fact = {r.signal_id: r.action_id for r in spark.read.parquet(f"{path}/fact").collect()}
    assert fact == {f"s{n}": "a0001" if n == 10 else None for n in range(20)}
    plan = plan_of(signals.filter(in_days("signal_day", days.read)))
    assert "PartitionFilters: [isnotnull(signal_day" in plan or "signal_day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert days_around({START.date(), None}, -1, 1) == {START.date() + shift * DAY for shift in (-1, 0, 1)}


@pytest.mark.parametrize("kind", ["classifier", "report"])
def test_drift_is_found_in_records(spark, kind):
    texts = [record(kind, {}), record(kind, {"metadata": "text"}), record(kind, {"fresh": [1]}), "[]", "no json", None]
    required = "score" if kind == "classifier" else "report_type"
    found = record(kind, {})
    import json

    bare = json.loads(found)
    bare.pop(required)
    texts.append(json.dumps(bare))
    rows = field_drift(spark.createDataFrame([(t,) for t in texts], "raw string"), kind).collect()
    assert {(r.field, r.found, r.records, r.change) for r in rows} == {
        ("metadata", "text", 1, "retyped"), ("fresh", "list", 1, "added"), (required, "nothing", 1, "missing")}
