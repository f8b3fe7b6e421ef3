"""One rule per case: a valid base record, one field overridden, replayed as rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sigmart.operators import envelope as E
from sigmart.operators.validate import contract, validate

ABSENT = object()
HASH = "ab" * 32
BASE = {
    "classifier": {"model_id": "toxicity-v3", "entity_id": "content-1", "label": "toxic", "score": 0.8,
                   "threshold": 0.5, "is_positive": True, "timestamp": "2026-03-22T10:00:00Z"},
    "report": {"reporter_id": "user-1", "reported_entity_id": "content-2", "report_type": "harassment",
               "description": "  Offensive content  ", "severity": "high", "status": "pending",
               "timestamp": "2026-03-22T10:00:00Z"},
    "enforcement": {"entity_id": "user-2", "action_type": "ban", "policy_id": "policy-1",
                    "enforced_by": "auto", "reason": "Repeated violations", "timestamp": "2026-03-22T10:00:00Z"},
    "model_output": {"model_id": "model-a", "prompt_hash": HASH, "output_text": "Hello",
                     "safety_labels": {"toxicity": 0.1}, "latency_ms": 120, "timestamp": "2026-03-22T10:00:00Z"},
}

# kind, overrides, expected "field:type" list
INVALID = [
    ("classifier", {"score": 1.5}, ["score:less_than_equal"]),
    ("classifier", {"score": -0.01}, ["score:greater_than_equal"]),
    ("classifier", {"score": 0.3}, [":value_error"]),
    ("classifier", {"model_id": ABSENT}, ["model_id:missing"]),
    ("classifier", {"entity_id": ABSENT}, ["entity_id:missing"]),
    ("classifier", {"model_id": ""}, ["model_id:string_too_short"]),
    ("classifier", {"model_id": None}, ["model_id:string_type"]),
    ("classifier", {"label": 5}, ["label:string_type"]),
    ("classifier", {"score": "nan"}, [":value_error"]),
    ("classifier", {"score": "high"}, ["score:float_parsing"]),
    ("classifier", {"score": {}}, ["score:float_type"]),
    ("classifier", {"threshold": None}, ["threshold:float_type"]),
    ("classifier", {"threshold": 2}, ["threshold:less_than_equal"]),
    ("classifier", {"is_positive": 2}, ["is_positive:bool_parsing"]),
    ("classifier", {"is_positive": 0.5}, ["is_positive:bool_type"]),
    ("classifier", {"timestamp": "soon"}, ["timestamp:datetime_from_date_parsing"]),
    ("classifier", {"timestamp": "2026-13-01T00:00:00Z"}, ["timestamp:datetime_from_date_parsing"]),
    ("classifier", {"timestamp": True}, ["timestamp:datetime_type"]),
    ("classifier", {"metadata": None}, ["metadata:dict_type"]),
    ("classifier", {"signal_id": "sig-1"}, ["signal_id:uuid_parsing"]),
    ("classifier", {"signal_id": 7}, ["signal_id:uuid_type"]),
    # a broken field hides the record rule
    ("classifier", {"score": 0.3, "label": ""}, ["label:string_too_short"]),
    ("classifier", {"model_id": "", "score": 2, "timestamp": ABSENT},
     ["model_id:string_too_short", "score:less_than_equal", "timestamp:missing"]),
    ("report", {"report_type": "phishing"}, ["report_type:enum"]),
    ("report", {"severity": "urgent"}, ["severity:enum"]),
    ("report", {"severity": None}, ["severity:enum"]),
    ("report", {"status": "closed"}, ["status:enum"]),
    ("report", {"reporter_id": ABSENT}, ["reporter_id:missing"]),
    # length counts before stripping
    ("report", {"description": " " * 10 + "x" * 9_991}, ["description:string_too_long"]),
    ("enforcement", {"reason": ""}, ["reason:string_too_short"]),
    ("enforcement", {"reason": "r" * 5_001}, ["reason:string_too_long"]),
    ("enforcement", {"action_type": "mute"}, ["action_type:enum"]),
    ("enforcement", {"policy_id": ABSENT}, ["policy_id:missing"]),
    ("model_output", {"prompt_hash": "not-a-hash"}, ["prompt_hash:string_pattern_mismatch"]),
    ("model_output", {"prompt_hash": HASH[:-1]}, ["prompt_hash:string_pattern_mismatch"]),
    ("model_output", {"prompt_hash": HASH + "\n"}, ["prompt_hash:string_pattern_mismatch"]),
    ("model_output", {"safety_labels": {"toxicity": 1.5}}, ["safety_labels:value_error"]),
    ("model_output", {"safety_labels": {"toxicity": -0.1}}, ["safety_labels:value_error"]),
    ("model_output", {"safety_labels": {"toxicity": "x", "pii": []}},
     ["safety_labels -> pii:float_type", "safety_labels -> toxicity:float_parsing"]),
    ("model_output", {"safety_labels": []}, ["safety_labels:dict_type"]),
    ("model_output", {"latency_ms": -1}, ["latency_ms:greater_than_equal"]),
    ("model_output", {"latency_ms": 1.5}, ["latency_ms:int_from_float"]),
    ("model_output", {"latency_ms": "fast"}, ["latency_ms:int_parsing"]),
    ("model_output", {"output_text": ABSENT}, ["output_text:missing"]),
]

# kind, overrides, expected payload values
VALID = [
    ("classifier", {}, {"label": "toxic", "is_positive": True, "metadata": "{}"}),
    ("classifier", {"threshold": ABSENT}, {"threshold": 0.5}),
    ("classifier", {"score": 0.2, "is_positive": False}, {"is_positive": False}),
    ("classifier", {"score": "0.8", "is_positive": "on"}, {"score": 0.8, "is_positive": True}),
    ("classifier", {"is_positive": 1}, {"is_positive": True}),
    ("classifier", {"is_positive": "TRUE"}, {"is_positive": True}),
    ("classifier", {"score": 0.5}, {"score": 0.5}),
    ("classifier", {"metadata": {"region": "us"}}, {"metadata": '{"region":"us"}'}),
    ("classifier", {"unknown_key": 1}, {"label": "toxic"}),
    ("report", {}, {"description": "Offensive content"}),
    ("report", {"description": ""}, {"description": ""}),
    ("report", {"description": "\t\n  text  "}, {"description": "text"}),
    ("report", {"description": ABSENT, "severity": ABSENT, "status": ABSENT},
     {"description": "", "severity": "medium", "status": "pending"}),
    ("enforcement", {"reason": "r" * 5_000}, {"action_type": "ban"}),
    ("model_output", {"safety_labels": {}}, {"safety_labels": {}}),
    ("model_output", {"safety_labels": ABSENT, "latency_ms": ABSENT}, {"safety_labels": {}, "latency_ms": 0}),
    ("model_output", {"latency_ms": 300.0}, {"latency_ms": 300}),
    ("model_output", {"latency_ms": "300"}, {"latency_ms": 300}),
]


def record(kind: str, overrides: dict) -> str:
    merged = {**BASE[kind], **overrides}
    return json.dumps({key: value for key, value in merged.items() if value is not ABSENT})


def checked(spark, kind: str, lines: list[str]) -> dict:
    df = spark.createDataFrame(list(enumerate(lines)), "n int, raw string")
    return {row.n: row for row in validate(df, kind).collect()}


@pytest.mark.parametrize("kind", list(BASE))
def test_invalid(spark, kind):
    cases = [case for case in INVALID if case[0] == kind]
    rows = checked(spark, kind, [record(kind, overrides) for _, overrides, _ in cases])
    for n, (_, overrides, expected) in enumerate(cases):
        assert sorted(f"{e.field}:{e.type}" for e in rows[n].errors) == sorted(expected), overrides
        assert rows[n].payload is None
        assert all(e.message for e in rows[n].errors)


@pytest.mark.parametrize("kind", list(BASE))
def test_valid(spark, kind):
    cases = [case for case in VALID if case[0] == kind]
    rows = checked(spark, kind, [record(kind, overrides) for _, overrides, _ in cases])
    for n, (_, overrides, expected) in enumerate(cases):
        assert rows[n].errors == [], (overrides, rows[n].errors)
        for name, value in expected.items():
            assert rows[n].payload[name] == value, (overrides, name)


def test_ids_are_generated_and_differ(spark):
    rows = checked(spark, "classifier", [record("classifier", {})] * 2)
    assert rows[0].payload.signal_id != rows[1].payload.signal_id


def test_times(spark):
    spellings = ["2026-03-22T10:00:00Z", "2026-03-22 12:00:00+02:00", "2026-03-22T10:00:00", 1774173600, 1774173600000,
                 "1774173600"]
    rows = checked(spark, "classifier", [record("classifier", {"timestamp": s}) for s in spellings])
    assert {str(row.payload.timestamp) for row in rows.values()} == {"2026-03-22 10:00:00"}
    date_only = checked(spark, "classifier", [record("classifier", {"timestamp": "2026-03-22"})])
    assert str(date_only[0].payload.timestamp) == "2026-03-22 00:00:00"


@pytest.mark.parametrize("line, code", [("{broken", "json_invalid"), ("", "json_invalid"), ("[1]", "model_type"),
                                        ("5", "model_type"), ("null", "model_type")])
def test_not_a_record(spark, line, code):
    row = checked(spark, "report", [line])[0]
    assert [(e.field, e.type) for e in row.errors] == [("", code)]


def test_blank_runs_are_stripped_in_linear_time(spark):
    text = "x" + " " * 9_998 + "y"
    row = checked(spark, "report", [record("report", {"description": text})])[0]
    assert row.payload.description == text


def test_load_batch_splits_and_describes(spark):
    lines = [record("classifier", {}), record("classifier", {"score": 1.5}), "{broken"]
    df = spark.createDataFrame([(line,) for line in lines], "raw string")
    batch = E.load_batch(df, "classifier", at="2026-03-22 11:00:00")
    valid, dead = batch.valid.collect(), batch.dead.collect()
    assert len(valid) == 1 and len(dead) == 2
    assert valid[0].source == "classifier-pipeline" and valid[0].loaded_at is None
    assert {row.error_type for row in dead} == {"ValidationError"}
    assert {row.raw_payload for row in dead} == set(lines[1:])
    message = next(row.error_message for row in dead if row.raw_payload == lines[1])
    assert message.startswith("1 validation error for ClassifierOutput\nscore\n")
    summary = {row.signal_type: (row.valid, row.failed, row.total) for row in E.ingest_summary([batch]).collect()}
    assert summary == {"classifier": (1, 2, 3), "report": (0, 0, 0), "enforcement": (0, 0, 0),
                       "model_output": (0, 0, 0), "TOTAL": (1, 2, 3)}


def test_mixed_batch_is_split_by_type(spark):
    rows = [(kind, record(kind, {})) for kind in BASE] + [("report", record("report", {"severity": "urgent"}))]
    df = spark.createDataFrame(rows, "signal_type string, raw string")
    loaded = E.load_mixed(df, "feed", at="2026-03-22 11:00:00")
    counts = {kind: (batch.valid.count(), batch.dead.count()) for kind, batch in loaded.items()}
    assert counts == {"classifier": (1, 0), "report": (1, 1), "enforcement": (1, 0), "model_output": (1, 0)}
    everything = E.union_envelopes(list(loaded.values()))
    assert everything.filter(~E.payload_matches_type(everything)).count() == 0
    swapped = everything.withColumn("signal_type", F.lit("report"))
    assert swapped.filter(E.payload_matches_type(swapped)).count() == 1
    flat = E.flatten(everything, "enforcement", "2026-03-22 12:00:00").collect()
    assert len(flat) == 1 and str(flat[0]._loaded_at) == "2026-03-22 12:00:00"


def test_source_and_kind_are_checked(spark):
    df = spark.createDataFrame([("{}",)], "raw string")
    with pytest.raises(ValueError):
        E.load_batch(df, "classifier", source="")
    with pytest.raises(ValueError):
        contract("telemetry")
