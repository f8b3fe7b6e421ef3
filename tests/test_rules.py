"""Routing, retry, freshness, metrics and quality rules on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from sigmart.operators import metrics as M
from sigmart.operators import observability as K
from sigmart.operators import quality as Q
from sigmart.operators import runs as R

ROUTES = [("sql", "retrieval_sql"), ("vector", "retrieval_vector"), ("keyword", "retrieval_keyword"),
          (None, "retrieval_vector"), ("unknown", "retrieval_vector"), ("", "retrieval_vector")]
# score, retries, history -> should retry, next strategy, decision
DECISIONS = [
    (0.9, 0, ["sql"], False, "vector", "end"),
    (0.2, 0, ["sql"], True, "vector", "retry"),
    (0.2, 2, ["sql", "vector", "keyword"], False, None, "end"),
    (0.1, 1, ["sql", "vector", "keyword"], True, None, "end"),
    (0.3, 0, [], True, "sql", "retry"),
    (0.8, 0, [], False, "sql", "end"),
    (0.1, 2, [], False, "sql", "end"),
    (None, 0, [], True, "sql", "retry"),
    (0.5, 0, ["keyword"], False, "sql", "end"),
]


def test_routes(spark):
    df = spark.createDataFrame([(s,) for s, _ in ROUTES], "s string")
    assert [row[0] for row in df.select(R.route_col(F.col("s"))).collect()] == [node for _, node in ROUTES]


def test_decisions(spark):
    df = spark.createDataFrame([d[:3] for d in DECISIONS], "score double, retries long, history array<string>")
    rows = df.select(
        R.should_retry_col(F.col("score"), F.col("retries")),
        R.next_strategy_col(F.col("history")),
        R.after_scoring_col(F.col("score"), F.col("retries"), F.col("history")),
    ).collect()
    assert [tuple(row) for row in rows] == [d[3:] for d in DECISIONS]


def test_retry_clears_and_records(spark):
    asked = spark.createDataFrame([("r1", "q1"), ("r2", "q2"), ("r3", "q3")], "run_id string, query string")
    fresh = R.initial_runs(asked)
    first = fresh.first()
    assert first.retry_count == 0 and first.strategy_history == [] and first.confidence_score is None
    full = F.array(F.lit("sql"), F.lit("vector"), F.lit("keyword"))
    state = fresh.withColumns({
        "retry_count": F.lit(1).cast("bigint"),
        "confidence_score": F.lit(0.3),
        "synthesised_answer": F.lit("old"),
        "retrieval_strategy": F.when(F.col("run_id") == "r2", None).otherwise("sql"),
        "strategy_history": F.when(F.col("run_id") == "r3", full).otherwise(F.col("strategy_history")),
    })
    after = {row.run_id: row for row in R.apply_retry(state).collect()}
    assert {row.retry_count for row in after.values()} == {2}
    assert all(row.synthesised_answer is None and row.confidence_score is None for row in after.values())
    assert after["r1"].strategy_history == ["sql"]
    assert after["r2"].strategy_history == []
    assert after["r3"].strategy_history == ["sql", "vector", "keyword"]


def test_curation(spark):
    df = spark.createDataFrame([(1, 0.49, 0), (2, 0.5, 0), (3, 0.9, 1), (4, None, 0), (5, None, 2)],
                               "n int, confidence_score double, retry_count long")
    assert sorted(row.n for row in R.curate_runs(df).collect()) == [1, 3, 5]


def loads(spark, rows):
    data = [(kind, dt.datetime.fromisoformat(at) if at else None) for kind, at in rows]
    return spark.createDataFrame(data, "signal_type string, _loaded_at timestamp_ntz")


def test_freshness_boundaries(spark):
    signals = loads(spark, [("classifier", "2024-01-01 11:45:00"), ("report", "2024-01-01 10:59:59"),
                            ("enforcement", "2024-01-01 12:30:00"), ("custom", "2024-01-01 11:00:00")])
    rows = {row.signal_type: row for row in K.freshness(signals, "2024-01-01 12:00:00").collect()}
    assert rows["classifier"].is_fresh and rows["classifier"].window_minutes == 15
    assert not rows["report"].is_fresh
    assert rows["enforcement"].is_fresh  # loaded after the check
    assert not rows["model_output"].is_fresh and rows["model_output"].latest_timestamp is None
    assert rows["custom"].is_fresh and rows["custom"].window_minutes == 60
    override = {"classifier": 0, "report": 61}
    rows = {row.signal_type: row for row in K.freshness(signals, "2024-01-01 12:00:00", override).collect()}
    assert rows["classifier"].window_minutes == 15 and rows["report"].is_fresh
    gauges = {row.signal_type: row for row in K.freshness_gauges(K.freshness(signals, "2024-01-01 12:00:00")).collect()}
    assert gauges["report"].minutes_since == 60 and gauges["report"].status == "stale"
    assert gauges["model_output"].label == "Model Output" and gauges["model_output"].minutes_since is None


def test_histogram_puts_one_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.95,), (1.0,), (None,)], "confidence_score double")
    assert {row.bin: row.runs for row in K.confidence_histogram(df).collect()} == {0: 1, 1: 1, 9: 2}


def test_registry_checks_names_and_types(spark):
    assert M.metrics.names() == ["classifier_precision", "enforcement_rate", "report_volume"]
    with pytest.raises(ValueError):
        M.metrics.run("unknown", lambda name: None)
    with pytest.raises(KeyError):
        M.metrics.run("report_volume", lambda name: None, report_type="spam", start_date="2024-01-01")
    with pytest.raises(TypeError):
        M.metrics.run("report_volume", lambda name: None, report_type=5, start_date="2024-01-01", end_date="2024-01-02")


def test_precision_weighs_repeated_signals(spark):
    """A signal with n actions counts n times for each of its n fact rows, as the plain join would."""
    at = dt.datetime(2024, 1, 1, 5)
    fact = spark.createDataFrame([("s1", "m", at, True)] * 3 + [("s2", "m", at, False), ("s3", "m", at, True)],
                                 "signal_id string, model_id string, signal_timestamp timestamp_ntz, is_positive boolean")
    actions = spark.createDataFrame([("s1", "a1"), ("s1", "a2"), ("s1", "a3"), ("s2", "a4")],
                                    "signal_id string, action_id string")
    row = M.classifier_precision(fact, actions).collect()[0]
    assert (row.total_signals, row.predicted_positives, row.true_positives, row.precision) == (11, 10, 9, 0.9)


def test_precision_without_positives_is_null(spark):
    fact = spark.createDataFrame([("s1", "m", dt.datetime(2024, 1, 1), False)],
                                 "signal_id string, model_id string, signal_timestamp timestamp_ntz, is_positive boolean")
    actions = spark.createDataFrame([], "signal_id string, action_id string")
    assert M.classifier_precision(fact, actions).collect()[0].precision is None


def test_anomaly(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("report", day + dt.timedelta(days=d), n) for d in range(10) for n in range(50 if d == 8 else 10 + d % 2)]
    df = spark.createDataFrame(rows, "signal_type string, signal_timestamp timestamp_ntz, n int")
    odd = [row.day.day for row in Q.row_count_anomaly(df).collect() if row.is_anomaly]
    assert odd == [9]


def test_schema_guard(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert Q.schema_guard(df, df.schema) is df
    with pytest.raises(Q.SchemaDrift, match="added b"):
        Q.schema_guard(df, T.StructType([T.StructField("a", T.IntegerType())]))
    with pytest.raises(Q.SchemaDrift, match="a is int, not bigint"):
        Q.schema_guard(df.select("a"), T.StructType([T.StructField("a", T.LongType())]))


def test_checkpoint_and_alerts(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "y")], "k int, v string")
    checks = Q.column_checks(df, "t", not_null=["k", "v"], accepted={"v": ["x", "y"]}).unionByName(
        Q.unique_check(df, "t", "k")
    )
    summary = Q.run_checkpoint(checks).collect()[0]
    assert (summary.success, summary.evaluated, summary.successful, summary.unsuccessful) == (False, 4, 2, 2)
    messages = {row.message for row in Q.alerts(checks, F.lit("2024-01-01").cast("timestamp_ntz")).collect()}
    assert messages == {"1 NULL", "1 keys that repeat"}
