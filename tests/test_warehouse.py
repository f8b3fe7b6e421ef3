"""Interval join, marts, incremental load and the file-based build."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from sigmart.operators.enrich import enrich_signals
from sigmart.operators.incremental import latest_per_key, merge_fact, since_watermark, upsert_fact
from sigmart.operators.marts import dim_models, fct_signals
from sigmart.operators.quality import SchemaDrift
from sigmart.plans.build import build, check, read_warehouse
from sigmart.plans.ingest import ingest
from sigmart.sources.readers import read_dead_letters, read_raw
from sigmart.sources.writers import register_views, write_alerts, write_dead_letters, write_eval_set, write_fact
from tests.test_validation import BASE, record

START = dt.datetime(2024, 1, 1)
SIGNALS = ("signal_id string, model_id string, entity_id string, label string, score double, threshold double, "
           "is_positive boolean, signal_timestamp timestamp_ntz, _loaded_at timestamp_ntz, signal_type string, "
           "metadata string")
ACTIONS = ("action_id string, entity_id string, action_type string, policy_id string, enforced_by string, "
           "reason string, action_timestamp timestamp_ntz, _loaded_at timestamp_ntz, metadata string")


def signal(n: int, entity: str, at: dt.datetime, loaded: dt.datetime | None = None) -> tuple:
    return (f"s{n}", "m", entity, "toxic", 0.8, 0.5, n % 2 == 0, at, loaded or at, "classifier", "{}")


def action(n: int, entity: str, at: dt.datetime) -> tuple:
    return (f"a{n:04d}", entity, "ban", "p", "auto", "because", at, at, "{}")


def events(seed: int, signals: int, actions: int, hot_share: float):
    """Random rows over five days; ``hot`` holds a share of both sides, and instants often coincide."""
    rng = random.Random(seed)

    def entity() -> str | None:
        return "hot" if rng.random() < hot_share else rng.choice(["e1", "e2", "e3", None])

    def at() -> dt.datetime:
        return START + dt.timedelta(minutes=rng.randrange(5 * 24 * 4) * 15)

    return ([signal(n, entity(), at()) for n in range(signals)],
            [action(n, entity(), at()) for n in range(actions)])


def brute_pairs(signals: list, actions: list, hours: int) -> dict[str, list[str]]:
    out = {}
    for s in signals:
        hits = [a for a in actions if s[2] is not None and a[1] == s[2]
                and s[7] <= a[6] <= s[7] + dt.timedelta(hours=hours)]
        out[s[0]] = [a[0] for a in sorted(hits, key=lambda a: (a[6], a[0]))]
    return out


@pytest.mark.parametrize("hours", [1, 5, 24, 50])
def test_interval_join_against_brute_force(spark, hours):
    signals, actions = events(hours, 300, 200, 0.4)
    left, right = spark.createDataFrame(signals, SIGNALS), spark.createDataFrame(actions, ACTIONS)
    expected = brute_pairs(signals, actions, hours)
    pairs = enrich_signals(left, right, hours).select("signal_id", "action_id", "is_positive", "was_enforced").collect()
    want = sorted((s, a) for s, hits in expected.items() for a in (hits or [""]))
    assert sorted((row.signal_id, row.action_id or "") for row in pairs) == want
    assert all(row.was_enforced == (row.is_positive and row.action_id is not None) for row in pairs)
    first = enrich_signals(left, right, hours, multi="first").select("signal_id", "action_id").collect()
    assert {row.signal_id: row.action_id for row in first} == {s: (h[0] if h else None) for s, h in expected.items()}


def test_interval_ends_are_inclusive(spark):
    left = spark.createDataFrame([signal(0, "e", START)], SIGNALS)
    day = dt.timedelta(hours=24)
    right = spark.createDataFrame(
        [action(1, "e", START), action(2, "e", START + day), action(3, "e", START + day + dt.timedelta(microseconds=1)),
         action(4, "e", START - dt.timedelta(microseconds=1)), action(5, "other", START)], ACTIONS)
    assert sorted(row.action_id for row in enrich_signals(left, right).collect()) == ["a0001", "a0002"]


def test_join_plan_has_equality_keys(spark):
    signals, actions = events(1, 20, 20, 0.5)
    df = enrich_signals(spark.createDataFrame(signals, SIGNALS), spark.createDataFrame(actions, ACTIONS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_slice" in plan


def test_join_rejects_unknown_policy(spark):
    left, right = spark.createDataFrame([], SIGNALS), spark.createDataFrame([], ACTIONS)
    with pytest.raises(ValueError):
        enrich_signals(left, right, multi="some")


def test_models_with_two_types_share_totals(spark):
    fact = spark.createDataFrame(
        [("m", "classifier", START, 0.2, True), ("m", "model_output", START, 0.4, False), (None, "report", START, 1.0, True)],
        "model_id string, signal_type string, signal_timestamp timestamp_ntz, score double, is_positive boolean")
    rows = {row.signal_type: row for row in dim_models(fact).collect()}
    assert set(rows) == {"classifier", "model_output"}
    assert all(row.total_signals == 2 and row.positive_rate == 0.5 and abs(row.avg_score - 0.3) < 1e-12
               for row in rows.values())


def fact_of(spark, signals, actions):
    return fct_signals(enrich_signals(spark.createDataFrame(signals, SIGNALS),
                                      spark.createDataFrame(actions, ACTIONS), multi="first"))


def test_watermark(spark):
    signals = [signal(n, "e", START + dt.timedelta(hours=n)) for n in range(6)]
    staged = spark.createDataFrame(signals, SIGNALS)
    target = staged.filter("signal_id in ('s0', 's1', 's2')")

    def names(df):
        return sorted(row.signal_id for row in df.collect())

    assert names(since_watermark(staged, target)) == ["s3", "s4", "s5"]
    assert names(since_watermark(staged, target.limit(0))) == ["s0", "s1", "s2", "s3", "s4", "s5"]
    assert names(since_watermark(staged, target, lookback_minutes=60)) == ["s2", "s3", "s4", "s5"]
    assert names(since_watermark(staged, target, reprocess_hours=1)) == ["s1", "s2", "s3", "s4", "s5"]


def test_merge_replaces_keys_and_guards_columns(spark):
    old = fact_of(spark, [signal(n, "e", START) for n in range(3)], [])
    later = START + dt.timedelta(hours=1)
    new = fact_of(spark, [signal(2, "e", START, later), signal(2, "e", START, later + dt.timedelta(hours=1)),
                          signal(3, "e", START, later)], [action(1, "e", START)])
    rows = {row.signal_id: row for row in merge_fact(old, new).collect()}
    assert sorted(rows) == ["s0", "s1", "s2", "s3"]
    assert rows["s2"]._loaded_at == later + dt.timedelta(hours=1) and rows["s2"].action_id == "a0001"
    assert rows["s0"].action_id is None
    with pytest.raises(SchemaDrift):
        merge_fact(old, new.withColumn("score", F.col("score").cast("float")))
    assert latest_per_key(new, "signal_id").count() == 2


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = [START + dt.timedelta(days=d) for d in range(3)]
    write_fact(fact_of(spark, [signal(n, "e", days[n]) for n in range(3)], []), path)
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "fact").glob("signal_day=*")}
    update = fact_of(spark, [signal(1, "e", days[1], days[2]), signal(9, "e", days[1], days[2])],
                     [action(1, "e", days[1])])
    upsert_fact(spark, path, update, str(tmp_path / "staging"))
    rows = {row.signal_id: row for row in spark.read.parquet(path).collect()}
    assert sorted(rows) == ["s0", "s1", "s2", "s9"] and rows["s1"].action_id == "a0001"
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "fact").glob("signal_day=*")}
    changed = [day for day in before if before[day] != after[day]]
    assert changed == ["signal_day=2024-01-02"]


def test_upsert_empties_a_day_whose_signals_moved(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(fact_of(spark, [signal(1, "e", START)], []), path)
    moved = fact_of(spark, [signal(1, "e", START + dt.timedelta(days=1))], [])
    upsert_fact(spark, path, moved, str(tmp_path / "staging"))
    rows = spark.read.parquet(path).collect()
    assert [(r.signal_id, str(r.signal_day)) for r in rows] == [("s1", "2024-01-02")]


def test_build_attaches_an_action_that_is_loaded_late(spark, tmp_path):
    """An action loaded long after it happened, and a load that carries an older loading time than the fact's."""
    raw, marts = tmp_path / "raw", str(tmp_path / "marts")
    hour = dt.timedelta(hours=1)

    def load(number, signals=(), actions=()):
        for table, rows in (("classifier_outputs", signals), ("enforcement_logs", actions)):
            path = raw / table / f"load_id={number}"
            path.mkdir(parents=True, exist_ok=True)
            (path / "part.json").write_text("\n".join(json.dumps(row) for row in rows))

    def classified(number, at, loaded):
        return {"signal_id": f"s{number}", "model_id": "m", "entity_id": "e", "label": "x", "score": 0.9, "threshold": 0.5,
                "is_positive": True, "timestamp": at.isoformat(), "_loaded_at": loaded.isoformat()}

    enforced = {"action_id": "a1", "entity_id": "e", "action_type": "ban", "policy_id": "p", "enforced_by": "me",
                "reason": "r", "timestamp": (START + hour / 3).isoformat(), "_loaded_at": (START + 26 * hour).isoformat()}
    load(1, [classified(1, START, START + hour / 2), classified(2, START + 20 * hour, START + 25 * hour)])
    build(spark, str(raw), marts, fmt="json")
    load(2, [classified(3, START - 48 * hour, START - 47 * hour)], [enforced])
    build(spark, str(raw), marts, fmt="json")
    fact = {r.signal_id: r.action_id for r in spark.read.parquet(f"{marts}/fct_signals").collect()}
    assert fact == {"s1": "a1", "s2": None, "s3": None}
    build(spark, str(raw), marts, fmt="json")  # nothing new
    assert spark.read.parquet(f"{marts}/fct_signals").count() == 3


def test_ingest_and_build_from_files(spark, tmp_path):
    """JSON lines through ingestion, the first build, and an incremental build after more arrives."""
    lines = {kind: [record(kind, {})] for kind in BASE}
    lines["classifier"] += [record("classifier", {"entity_id": "user-2", "timestamp": "2026-03-22T09:00:00Z"}),
                            record("classifier", {"score": 7}), "", "{broken"]
    for kind, texts in lines.items():
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "part.json").write_text("\n".join(texts))
    out = str(tmp_path / "out")
    summary = ingest(spark, {kind: str(tmp_path / kind) for kind in BASE}, out)
    counts = {row.signal_type: (row.valid, row.failed) for row in summary.collect()}
    assert counts == {"classifier": (2, 2), "report": (1, 0), "enforcement": (1, 0), "model_output": (1, 0),
                      "TOTAL": (5, 2)}
    dead = read_dead_letters(spark, f"{out}/dead_letters")
    assert sorted(row.error_type for row in dead.collect()) == ["ValidationError"] * 2
    build(spark, f"{out}/raw", str(tmp_path / "marts"))
    fact = spark.read.parquet(str(tmp_path / "marts" / "fct_signals"))
    assert {row.entity_id: row.was_enforced for row in fact.collect()} == {"content-1": False, "user-2": True}
    assert spark.read.parquet(str(tmp_path / "marts" / "dim_actions")).count() == 1
    stale = check(spark, f"{out}/raw", str(tmp_path / "marts"), "2099-01-01 00:00:00", str(tmp_path / "alerts")).first()
    assert not stale.success and stale.unsuccessful == 4
    assert {row.alert_type for row in spark.read.parquet(str(tmp_path / "alerts")).collect()} == {"freshness"}

    (tmp_path / "later").mkdir()
    (tmp_path / "later" / "more.json").write_text(record("classifier", {"entity_id": "user-2"}))
    for _ in range(2):  # repeating a load replaces it
        ingest(spark, {"classifier": str(tmp_path / "later")}, out, load_id="second")
    build(spark, f"{out}/raw", str(tmp_path / "marts"))
    fact = spark.read.parquet(str(tmp_path / "marts" / "fct_signals"))
    assert fact.count() == 3 and fact.filter("entity_id = 'user-2' and was_enforced").count() == 2
    assert fact.groupBy("signal_id").count().filter("count > 1").count() == 0
    assert read_warehouse(spark, f"{out}/raw").fct_signals_all.groupBy("signal_type").count().count() == 4


def test_raw_reader_uses_the_contract(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"report_id": "r", "timestamp": "2024-01-01T00:00:00", "extra": 1}))
    df = read_raw(spark, "user_reports", str(tmp_path), "json")
    assert "extra" not in df.columns and df.collect()[0].report_id == "r"
    with pytest.raises(ValueError):
        read_raw(spark, "telemetry", str(tmp_path))


def test_dead_letter_lines(spark, tmp_path):
    lines = ['{"error_type": "ValidationError"}', "", "   ", '{"source": "x"}', "not json", '{"error_type": "ValidationError"}']
    (tmp_path / "dead.jsonl").write_text("\n".join(lines))
    from sigmart.operators.envelope import dead_letter_stats

    stats = dead_letter_stats(read_dead_letters(spark, str(tmp_path)))
    assert {row.error_type: row.failures for row in stats.collect()} == {
        "ValidationError": 2, "unknown": 1, "_malformed_line": 1}


def test_no_dead_letters_yet(spark, tmp_path):
    assert read_dead_letters(spark, str(tmp_path / "never")).count() == 0


def test_append_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    for write in (write_eval_set, write_alerts):
        path = str(tmp_path / write.__name__)
        write(df, path)
        write(df, path)
        assert spark.read.parquet(path).count() == 2
        write(df, f"{path}-runs", run_id="2024-01-01 00:00:00")
        write(df, f"{path}-runs", run_id="2024-01-01 00:00:00")
        assert spark.read.parquet(f"{path}-runs").count() == 1


def test_dead_letters_append_by_day(spark, tmp_path):
    df = spark.createDataFrame([("x", dt.datetime(2024, 1, 1, 5))], "error_type string, failed_at timestamp_ntz")
    path = str(tmp_path / "dead")
    write_dead_letters(df, path)
    write_dead_letters(df, path)
    assert read_dead_letters(spark, path).count() == 2
    assert (tmp_path / "dead" / "failed_on=2024-01-01").is_dir()


def test_views(spark):
    assert register_views({"one_row": spark.range(1)}) == ["one_row"]
    assert spark.sql("select * from one_row").count() == 1
