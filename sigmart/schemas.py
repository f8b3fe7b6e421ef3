"""The data contract: value sets, defaults and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------------
# Fixed values. They define which records are valid and what the results are called.
# --------------------------------------------------------------------------------------------
SIGNAL_TYPES = ["classifier", "report", "enforcement", "model_output"]
REPORT_TYPES = ["spam", "harassment", "hate_speech", "csam", "self_harm", "misinformation", "other"]
SEVERITIES = ["low", "medium", "high", "critical"]
REPORT_STATUSES = ["pending", "under_review", "resolved", "dismissed"]
ACTION_TYPES = ["warn", "suspend", "ban", "content_removal", "shadowban", "escalate"]

DEFAULT_THRESHOLD = 0.5
DEFAULT_SEVERITY = "medium"
DEFAULT_STATUS = "pending"
MAX_DESCRIPTION_CHARS = 10_000
MAX_REASON_CHARS = 5_000
SHA256_HEX_PATTERN = "^[a-f0-9]{64}$"

DEFAULT_SOURCES = {
    "classifier": "classifier-pipeline",
    "report": "report-ingestion-service",
    "enforcement": "enforcement-system",
    "model_output": "model-serving",
}

FRESHNESS_WINDOW_MINUTES = {"classifier": 15, "report": 60, "enforcement": 60, "model_output": 30}
UNKNOWN_TYPE_WINDOW_MINUTES = 60

ACTION_WINDOW_HOURS = 24

STRATEGIES = ["sql", "vector", "keyword"]
CONFIDENCE_THRESHOLD = 0.5
MAX_RETRIES = 2

VECTOR_TOP_K = 10
VECTOR_FINAL_K = 5
MMR_LAMBDA = 0.5
SQL_ROW_LIMIT = 100
# --------------------------------------------------------------------------------------------

_S, _D, _B, _L, _TS = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# Raw tables. ``metadata`` is free-form JSON text.
RAW_SCHEMAS = {
    "classifier": _struct(
        signal_id=_S, model_id=_S, entity_id=_S, label=_S, score=_D, threshold=_D, is_positive=_B,
        timestamp=_TS, _loaded_at=_TS, metadata=_S,
    ),
    "report": _struct(
        report_id=_S, reporter_id=_S, reported_entity_id=_S, report_type=_S, description=_S, severity=_S,
        status=_S, timestamp=_TS, _loaded_at=_TS, metadata=_S,
    ),
    "enforcement": _struct(
        action_id=_S, entity_id=_S, action_type=_S, policy_id=_S, enforced_by=_S, reason=_S, timestamp=_TS,
        _loaded_at=_TS, metadata=_S,
    ),
    "model_output": _struct(
        output_id=_S, model_id=_S, prompt_hash=_S, output_text=_S, safety_labels=T.MapType(_S, _D),
        latency_ms=_L, timestamp=_TS, _loaded_at=_TS, metadata=_S,
    ),
}

RAW_TABLES = {
    "classifier_outputs": "classifier",
    "user_reports": "report",
    "enforcement_logs": "enforcement",
    "model_outputs": "model_output",
}

ERROR_SCHEMA = T.ArrayType(_struct(field=_S, message=_S, type=_S, input=_S))

DEAD_LETTER_SCHEMA = _struct(
    dead_letter_id=_S, raw_payload=_S, error_type=_S, error_message=_S, error_details=ERROR_SCHEMA, source=_S,
    failed_at=_TS,
)

FACT_COLUMNS = [
    "signal_id", "model_id", "entity_id", "label", "score", "threshold", "is_positive", "signal_timestamp",
    "signal_type", "action_id", "action_type", "policy_id", "enforced_by", "enforcement_reason",
    "action_timestamp", "was_enforced", "_loaded_at", "metadata",
]

ACTION_COLUMNS = [
    "action_id", "entity_id", "action_type", "policy_id", "enforced_by", "enforcement_reason",
    "action_timestamp", "signal_id",
]

RUN_SCHEMA = _struct(
    run_id=_S, query=_S, signal_type=_S, router_output=_S, retrieval_strategy=_S,
    retrieved_context=T.ArrayType(_S), synthesised_answer=_S, confidence_score=_D, failure_reason=_S,
    retry_count=_L, strategy_history=T.ArrayType(_S), metadata=T.MapType(_S, _S), started_at=_TS,
)
