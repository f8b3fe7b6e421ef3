"""Plain SQL with the same results as the registered queries, for the comparison engine.

Each text is a chain of common table expressions over the supplied tables and a final SELECT.
"""

from __future__ import annotations

from sigmart.operators.envelope import source_name
from sigmart.operators.quality import NOT_NULL
from sigmart.plans.supplied import RAW_VIEWS, oracle_text

# Relations in dependency order: name -> (what it reads, SQL).
RELATIONS: dict[str, tuple[list[str], str]] = {
    name: ([], oracle_text(text)) for name, text in RAW_VIEWS.items()
}


def relation(name: str, needs: list[str], sql: str) -> None:
    RELATIONS[name] = (needs, sql)


def chain(names: list[str], final: str) -> str:
    """``final`` preceded by every relation it needs, each once, in dependency order."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for needed in RELATIONS[name][0]:
            visit(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        visit(name)
    if not wanted:
        return final.strip()
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name][1].strip()})" for name in wanted)
    return f"WITH {ctes}\n{final.strip()}"


relation("stg_signals", ["raw_classifier_outputs"], """
SELECT signal_id, model_id, entity_id, label, score, threshold, is_positive, timestamp AS signal_timestamp,
  _loaded_at, 'classifier' AS signal_type, metadata
FROM raw_classifier_outputs
""")
relation("stg_enforcement", ["raw_enforcement_logs"], """
SELECT action_id, entity_id, action_type, policy_id, enforced_by, reason, timestamp AS action_timestamp,
  _loaded_at, metadata
FROM raw_enforcement_logs
""")
relation("stg_reports", ["raw_user_reports"], """
SELECT report_id, reporter_id, reported_entity_id, report_type, description, severity, status,
  timestamp AS report_timestamp, _loaded_at, metadata
FROM raw_user_reports
""")
relation("stg_model_outputs", ["raw_model_outputs"], """
SELECT output_id, model_id, prompt_hash, output_text, toxicity, pii, latency_ms,
  timestamp AS output_timestamp, _loaded_at, metadata
FROM raw_model_outputs
""")
relation("int_signals_enriched", ["stg_signals", "stg_enforcement"], """
SELECT signals.*, action_id, action_type, policy_id, enforced_by, reason AS enforcement_reason, action_timestamp,
  is_positive AND action_id IS NOT NULL AS was_enforced
FROM stg_signals AS signals LEFT JOIN (SELECT entity_id AS target, * EXCLUDE (entity_id, _loaded_at, metadata) FROM stg_enforcement) AS actions
  ON target = signals.entity_id AND epoch_us(action_timestamp) - epoch_us(signal_timestamp) BETWEEN 0 AND 24 * 3600000000
""")
_FACT = """
SELECT signal_id, model_id, entity_id, label, score, threshold, is_positive, signal_timestamp, signal_type,
  action_id, action_type, policy_id, enforced_by, enforcement_reason, action_timestamp, was_enforced,
  _loaded_at, metadata
"""
relation("fct_signals", ["int_signals_enriched"], _FACT + "FROM int_signals_enriched")
relation("fct_signals_first", ["int_signals_enriched"], _FACT + """
FROM (SELECT *, row_number() OVER (PARTITION BY signal_id ORDER BY action_timestamp NULLS LAST, action_id) AS rn
      FROM int_signals_enriched) WHERE rn = 1
""")
relation("fct_signals_all", ["fct_signals", "stg_reports", "stg_enforcement", "stg_model_outputs"], """
SELECT signal_id, model_id, entity_id, signal_timestamp, signal_type, action_id, action_type,
  NULL AS report_type, NULL AS severity, NULL AS reporter_id, NULL AS reported_entity_id,
  NULL AS prompt_hash, CAST(NULL AS BIGINT) AS latency_ms, score, is_positive, was_enforced, _loaded_at
FROM fct_signals
UNION ALL
SELECT report_id, NULL, reported_entity_id, report_timestamp, 'report', NULL, NULL, report_type, severity,
  reporter_id, reported_entity_id, NULL, NULL, NULL, NULL, NULL, _loaded_at FROM stg_reports
UNION ALL
SELECT action_id, NULL, entity_id, action_timestamp, 'enforcement', action_id, action_type, NULL, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL, NULL, _loaded_at FROM stg_enforcement
UNION ALL
SELECT output_id, model_id, NULL, output_timestamp, 'model_output', NULL, NULL, NULL, NULL, NULL, NULL,
  prompt_hash, latency_ms, NULL, NULL, NULL, _loaded_at FROM stg_model_outputs
""")
relation("signals_once", ["stg_signals", "stg_reports", "stg_enforcement", "stg_model_outputs"], """
SELECT signal_type, entity_id, signal_timestamp, _loaded_at FROM stg_signals
UNION ALL SELECT 'report', reported_entity_id, report_timestamp, _loaded_at FROM stg_reports
UNION ALL SELECT 'enforcement', entity_id, action_timestamp, _loaded_at FROM stg_enforcement
UNION ALL SELECT 'model_output', NULL, output_timestamp, _loaded_at FROM stg_model_outputs
""")
relation("dim_actions", ["fct_signals"], """
SELECT DISTINCT action_id, entity_id, action_type, policy_id, enforced_by, enforcement_reason, action_timestamp,
  signal_id
FROM fct_signals WHERE action_id IS NOT NULL
""")
relation("dim_entities", ["fct_signals"], """
SELECT entity_id, min(signal_timestamp) AS first_seen_at, max(signal_timestamp) AS last_seen_at, count(*) AS total_signals,
  count(*) FILTER (is_positive) AS positive_signal_count, count(*) FILTER (was_enforced) AS enforcement_count
FROM fct_signals GROUP BY entity_id
""")
relation("dim_models", ["fct_signals"], """
SELECT model_id, signal_type, first_seen_at, last_seen_at, total_signals, avg_score, positive_rate
FROM (SELECT model_id, min(signal_timestamp) AS first_seen_at, max(signal_timestamp) AS last_seen_at, count(*) AS total_signals,
    avg(score) AS avg_score, CAST(count(*) FILTER (is_positive) AS DOUBLE) / count(*) AS positive_rate
  FROM fct_signals GROUP BY model_id)
JOIN (SELECT model_id, signal_type FROM fct_signals GROUP BY ALL) USING (model_id)
""")

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], final: str | None = None) -> None:
    ORACLES[name] = chain(needs, final if final is not None else f"SELECT * FROM {needs[-1]}")


for _name in ("stg_signals", "stg_enforcement", "stg_reports", "stg_model_outputs", "int_signals_enriched",
              "fct_signals", "fct_signals_first", "fct_signals_all", "dim_actions", "dim_entities"):
    oracle(_name, [_name])
oracle("dim_actions_written", ["dim_actions"], "SELECT * FROM dim_actions")
oracle("stg_signals_with_offsets", ["stg_signals"], """
SELECT signal_id, signal_timestamp - CASE CAST(substr(signal_id, 5) AS BIGINT) % 3 WHEN 0 THEN INTERVAL '0' MINUTE
  WHEN 1 THEN INTERVAL '120' MINUTE ELSE INTERVAL '-330' MINUTE END AS signal_timestamp FROM stg_signals
""")
oracle("dim_models", ["dim_models"], """
SELECT model_id, signal_type, first_seen_at, last_seen_at, total_signals,
  round(avg_score, 6) AS avg_score, round(positive_rate, 6) AS positive_rate
FROM dim_models
""")

# A signal counts once for each of its actions, and once without any.
_PRECISION = """
SELECT day, model_id, CAST(sum(greatest(actions, 1)) AS BIGINT) AS total_signals, CAST(sum(positives) AS BIGINT) AS predicted_positives,
  CAST(sum(hits) AS BIGINT) AS true_positives, round(sum(hits) / nullif(CAST(sum(positives) AS DOUBLE), 0), 4) AS precision
FROM (SELECT day, model_id, actions, if(is_positive, greatest(actions, 1), 0) AS positives, if(is_positive, actions, 0) AS hits
  FROM (SELECT date_trunc('day', s.signal_timestamp)::TIMESTAMP AS day, s.model_id, s.is_positive, coalesce(n, 0) AS actions
    FROM fct_signals s LEFT JOIN (SELECT signal_id, count(*) AS n FROM dim_actions GROUP BY 1) USING (signal_id) {where}))
GROUP BY day, model_id
"""
_RATE = """
SELECT day, action_type, enforcement_count, total_signals, round(enforcement_count / CAST(total_signals AS DOUBLE), 4) AS enforcement_rate
FROM (SELECT date_trunc('day', a.action_timestamp)::TIMESTAMP AS day, a.action_type, count(*) AS enforcement_count
  FROM dim_actions a {where} GROUP BY ALL)
JOIN (SELECT date_trunc('day', signal_timestamp)::TIMESTAMP AS day, count(*) AS total_signals FROM fct_signals {inner} GROUP BY ALL) USING (day)
"""
_VOLUME = """
SELECT date_trunc('hour', signal_timestamp)::TIMESTAMP AS hour, report_type, severity, count(*) AS report_count,
  count(DISTINCT reporter_id) AS unique_reporters, count(DISTINCT reported_entity_id) AS unique_entities_reported
FROM fct_signals_all WHERE signal_type = 'report' {where}
GROUP BY 1, 2, 3
"""
oracle("classifier_precision", ["dim_actions"], _PRECISION.format(where=""))
oracle("classifier_precision_one_model", ["dim_actions"], _PRECISION.format(
    where="WHERE s.model_id = 'toxicity-v3' AND s.signal_timestamp >= TIMESTAMP '2024-01-05'"
          " AND s.signal_timestamp < TIMESTAMP '2024-01-20'"))
oracle("kept_precision", ["fct_signals_first"], """
SELECT CAST(signal_timestamp AS DATE) AS signal_day, model_id, count(*) AS total_signals,
  count(*) FILTER (is_positive) AS predicted_positives, count(*) FILTER (is_positive AND action_id IS NOT NULL) AS true_positives,
  round(count(*) FILTER (is_positive AND action_id IS NOT NULL) / nullif(CAST(count(*) FILTER (is_positive) AS DOUBLE), 0), 4) AS precision,
  count(DISTINCT entity_id) AS entities
FROM fct_signals_first GROUP BY ALL
""")
oracle("enforcement_rate", ["dim_actions"], _RATE.format(inner="", where=""))
oracle("enforcement_rate_bans", ["dim_actions"], _RATE.format(
    inner="WHERE signal_timestamp >= TIMESTAMP '2024-01-05' AND signal_timestamp < TIMESTAMP '2024-01-20'",
    where="WHERE a.action_type = 'ban' AND a.action_timestamp >= TIMESTAMP '2024-01-05'"
          " AND a.action_timestamp < TIMESTAMP '2024-01-20'"))
oracle("report_volume", ["fct_signals_all"], _VOLUME.format(where=""))
oracle("report_volume_first_100", ["fct_signals_all"], _VOLUME.format(where="")
       + "ORDER BY hour DESC, report_count DESC, report_type, severity LIMIT 100")
oracle("report_volume_spam", ["fct_signals_all"], _VOLUME.format(
    where="AND report_type = 'spam' AND signal_timestamp >= TIMESTAMP '2024-01-30 06:00:00'"
          " AND signal_timestamp < TIMESTAMP '2024-01-30 18:00:00'"))
oracle("sql_retrieve", ["dim_actions"], "SELECT *, 'sql' AS source FROM (" + _PRECISION.format(
    where="WHERE s.model_id = 'spam-classifier-v4' AND s.signal_timestamp >= TIMESTAMP '2024-01-01'"
          " AND s.signal_timestamp < TIMESTAMP '2024-02-01'") + "ORDER BY day DESC, model_id LIMIT 100)")


# -- ingestion -------------------------------------------------------------------------------
# Rules per field: ordered (condition, error type); the first that holds is the field's error.
# ``f`` in a condition stands for the JSON type of the field, ``t`` for its text.

_NO_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+|[iI][nN][fF]|[nN][aA][nN])\s*$"
_NUMBERS = "('DOUBLE', 'UBIGINT', 'BIGINT')"


def _text_rules(shortest: int = 0, longest: int | None = None, required: bool = True) -> list[tuple[str, str]]:
    rules = [("f IS NULL", "missing" if required else ""), ("f <> 'VARCHAR'", "string_type")]
    if shortest:
        rules.append((f"length(t) < {shortest}", "string_too_short"))
    if longest:
        rules.append((f"length(t) > {longest}", "string_too_long"))
    return rules


def _choice_rules(values: list[str], required: bool = True) -> list[tuple[str, str]]:
    listed = ", ".join(f"'{v}'" for v in values)
    return [("f IS NULL", "missing" if required else ""), (f"f <> 'VARCHAR' OR t NOT IN ({listed})", "enum")]


def _score_rules(required: bool) -> list[tuple[str, str]]:
    return [
        ("f IS NULL", "missing" if required else ""),
        (f"f NOT IN ('VARCHAR', 'BOOLEAN') AND f NOT IN {_NUMBERS}", "float_type"),
        (f"f = 'VARCHAR' AND NOT regexp_matches(t, '{_NO_NUMBER}')", "float_parsing"),
        ("NOT isnan(try_cast(t AS DOUBLE)) AND try_cast(t AS DOUBLE) < 0", "greater_than_equal"),
        ("NOT isnan(try_cast(t AS DOUBLE)) AND try_cast(t AS DOUBLE) > 1", "less_than_equal"),
    ]


_ID_RULES = [
    ("f IS NULL", ""), ("f <> 'VARCHAR'", "uuid_type"),
    ("NOT regexp_matches(t, '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$')", "uuid_parsing"),
]
_TIME_RULES = [
    ("f IS NULL", "missing"), (f"f <> 'VARCHAR' AND f NOT IN {_NUMBERS}", "datetime_type"),
    ("f = 'VARCHAR' AND try_cast(t AS TIMESTAMPTZ) IS NULL", "datetime_from_date_parsing"),
]
_OBJECT_RULES = [("f IS NULL", ""), ("f <> 'OBJECT'", "dict_type")]
_FLAG_RULES = [
    ("f IS NULL", "missing"), (f"f NOT IN ('VARCHAR', 'BOOLEAN') AND f NOT IN {_NUMBERS}", "bool_type"),
    ("lower(t) NOT IN ('true', 't', 'yes', 'y', 'on', '1', 'false', 'f', 'no', 'n', 'off', '0')", "bool_parsing"),
]
_LATENCY_RULES = [
    ("f IS NULL", ""), (f"f NOT IN ('VARCHAR', 'BOOLEAN') AND f NOT IN {_NUMBERS}", "int_type"),
    ("f = 'DOUBLE' AND try_cast(t AS DOUBLE) <> floor(try_cast(t AS DOUBLE))", "int_from_float"),
    ("try_cast(t AS BIGINT) IS NULL", "int_parsing"), ("try_cast(t AS BIGINT) < 0", "greater_than_equal"),
]

_CONTRACTS = {
    "classifier": {
        "signal_id": _ID_RULES, "model_id": _text_rules(1), "entity_id": _text_rules(1), "label": _text_rules(1),
        "score": _score_rules(True), "threshold": _score_rules(False), "is_positive": _FLAG_RULES,
        "timestamp": _TIME_RULES, "metadata": _OBJECT_RULES,
    },
    "reports": {
        "report_id": _ID_RULES, "reporter_id": _text_rules(1), "reported_entity_id": _text_rules(1),
        "report_type": _choice_rules(
            ["spam", "harassment", "hate_speech", "csam", "self_harm", "misinformation", "other"]),
        "description": _text_rules(0, 10000, required=False),
        "severity": _choice_rules(["low", "medium", "high", "critical"], required=False),
        "status": _choice_rules(["pending", "under_review", "resolved", "dismissed"], required=False),
        "timestamp": _TIME_RULES, "metadata": _OBJECT_RULES,
    },
    "enforcement": {
        "action_id": _ID_RULES, "entity_id": _text_rules(1),
        "action_type": _choice_rules(["warn", "suspend", "ban", "content_removal", "shadowban", "escalate"]),
        "policy_id": _text_rules(1), "enforced_by": _text_rules(1), "reason": _text_rules(1, 5000),
        "timestamp": _TIME_RULES, "metadata": _OBJECT_RULES,
    },
    "model_outputs": {
        "output_id": _ID_RULES, "model_id": _text_rules(1),
        "prompt_hash": [*_text_rules(), ("NOT regexp_matches(t, '^[a-f0-9]{64}$')", "string_pattern_mismatch")],
        "output_text": _text_rules(1),
        "safety_labels": [
            ("f IS NULL", ""), ("f <> 'OBJECT'", "dict_type"),
            ("try_cast(json_extract_string(raw, '$.safety_labels.pii') AS DOUBLE) IS NULL"
             " AND json_extract_string(raw, '$.safety_labels.pii') IS NOT NULL", "pii:float_parsing"),
            ("try_cast(json_extract_string(raw, '$.safety_labels.pii') AS DOUBLE) NOT BETWEEN 0 AND 1",
             "value_error"),
        ],
        "latency_ms": _LATENCY_RULES, "timestamp": _TIME_RULES, "metadata": _OBJECT_RULES,
    },
}


def _field_error(name: str, rules: list[tuple[str, str]]) -> str:
    """The field's ``name:type`` text, or NULL."""
    branches = []
    for condition, kind in rules:
        if not kind:
            shown = "NULL"
        elif ":" in kind:
            key, code = kind.split(":")
            shown = f"'{name} -> {key}:{code}'"
        else:
            shown = f"'{name}:{kind}'"
        branches.append((condition, shown))
    cases = " ".join(f"WHEN {condition} THEN {shown}" for condition, shown in branches)
    # bind f and t of this field
    return (f"(SELECT CASE {cases} ELSE NULL END FROM (SELECT "
            f"json_type(safe, '$.{name}') AS f, json_extract_string(safe, '$.{name}') AS t))")


def _checked(kind: str, rules: dict[str, list[tuple[str, str]]]) -> None:
    """raw_id, raw, safe (an object even when the text is none) and the errors as one text."""
    errors = ", ".join(_field_error(name, field_rules) for name, field_rules in rules.items())
    record_rule = "''"
    if kind == "classifier":
        score, threshold = "CAST(json_extract_string(safe, '$.score') AS DOUBLE)", \
            "coalesce(CAST(json_extract_string(safe, '$.threshold') AS DOUBLE), 0.5)"
        flag = "lower(json_extract_string(safe, '$.is_positive')) IN ('true', 't', 'yes', 'y', 'on', '1')"
        record_rule = (f"CASE WHEN isnan({score}) OR ({flag}) <> ({score} >= {threshold})"
                       " THEN ':value_error' ELSE '' END")
    relation(f"fields_{kind}", [f"json_{kind}"], f"""
SELECT raw_id, raw, json_valid(raw) AS is_json,
  CASE WHEN json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw ELSE 'null' END) = 'OBJECT'
    THEN raw ELSE NULL END AS object,
  coalesce(CASE WHEN json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw ELSE 'null' END) = 'OBJECT'
    THEN raw END, '{{}}') AS safe
FROM json_{kind}
""")
    relation(f"problems_{kind}", [f"fields_{kind}"], f"""
SELECT raw_id, raw, safe, CASE WHEN NOT is_json THEN ':json_invalid' WHEN object IS NULL THEN ':model_type'
  ELSE concat_ws('|', {errors}) END AS found
FROM fields_{kind}
""")
    relation(f"checked_{kind}", [f"problems_{kind}"], f"""
SELECT raw_id, raw, safe, CASE WHEN found <> '' THEN found ELSE {record_rule} END AS errors
FROM problems_{kind}
""")


for _kind, _rules in _CONTRACTS.items():
    _checked(_kind, _rules)


def _value(name: str, cast: str = "VARCHAR", default: str | None = None) -> str:
    text = f"CAST(json_extract_string(safe, '$.{name}') AS {cast})"
    if default is not None:
        text = f"coalesce({text}, {default})"
    return f"CASE WHEN errors = '' THEN {text} END AS {name}"


_WHEN = ("CASE WHEN errors = '' THEN CAST(replace(replace(json_extract_string(safe, '$.timestamp'), 'T', ' '), 'Z', '')"
         " AS TIMESTAMP) END AS timestamp")
oracle("validate_classifier", ["checked_classifier"], f"""
SELECT raw_id, errors, {_value("signal_id")}, {_value("model_id")}, {_value("entity_id")}, {_value("label")},
  {_value("score", "DOUBLE")}, {_value("threshold", "DOUBLE", "0.5")},
  CASE WHEN errors = '' THEN lower(json_extract_string(safe, '$.is_positive')) IN ('true', 'on', '1') END
    AS is_positive, {_WHEN}
FROM checked_classifier
""")
oracle("validate_reports", ["checked_reports"], f"""
SELECT raw_id, errors, {_value("report_id")}, {_value("reporter_id")}, {_value("reported_entity_id")},
  {_value("report_type")}, CASE WHEN errors = '' THEN trim(coalesce(json_extract_string(safe, '$.description'), ''))
  END AS description, {_value("severity", default="'medium'")}, {_value("status", default="'pending'")}, {_WHEN}
FROM checked_reports
""")
oracle("validate_enforcement", ["checked_enforcement"], f"""
SELECT raw_id, errors, {_value("action_id")}, {_value("entity_id")}, {_value("action_type")},
  {_value("policy_id")}, {_value("enforced_by")}, {_value("reason")}, {_WHEN}
FROM checked_enforcement
""")
oracle("validate_model_outputs", ["checked_model_outputs"], f"""
SELECT raw_id, errors, {_value("output_id")}, {_value("model_id")}, {_value("prompt_hash")},
  {_value("output_text")}, {_value("latency_ms", "BIGINT", "0")}, {_WHEN},
  CASE WHEN errors = '' THEN CAST(json_extract_string(safe, '$.safety_labels.toxicity') AS DOUBLE) END AS toxicity,
  CASE WHEN errors = '' THEN CAST(json_extract_string(safe, '$.safety_labels.pii') AS DOUBLE) END AS pii
FROM checked_model_outputs
""")
_ALL_CHECKED = [f"checked_{kind}" for kind in _CONTRACTS]
_TYPE_NAMES = {"classifier": "classifier", "reports": "report", "enforcement": "enforcement",
               "model_outputs": "model_output"}
relation("checked_all", _ALL_CHECKED, " UNION ALL ".join(
    f"SELECT '{_TYPE_NAMES[kind]}' AS signal_type, raw_id, raw, errors FROM checked_{kind}" for kind in _CONTRACTS))
oracle("dead_letters", ["checked_all"], """
SELECT raw AS raw_payload, 'ValidationError' AS error_type, errors, 'nightly-batch' AS source,
  CAST(len(string_split(errors, '|')) AS INTEGER) AS problems, TIMESTAMP '2024-01-31 00:00:00' AS failed_at
FROM checked_all WHERE errors <> ''
""")
oracle("dead_letter_problems", ["checked_all"], """
SELECT string_split(e, ':')[1] AS field, string_split(e, ':')[2] AS type, count(*) AS problems
FROM (SELECT unnest(string_split(errors, '|')) AS e FROM checked_all WHERE errors <> '') GROUP BY 1, 2
""")
oracle("dead_letter_stats", ["checked_all"], """
SELECT CASE WHEN NOT json_valid(raw) THEN '_malformed_line' ELSE 'unknown' END AS error_type, count(*) AS failures
FROM checked_all GROUP BY 1
UNION ALL SELECT 'ValidationError', count(*) FROM checked_all WHERE errors <> ''
""")
oracle("ingest_summary", ["checked_all"], """
SELECT coalesce(signal_type, 'TOTAL') AS signal_type, CAST(count(*) FILTER (errors = '') AS BIGINT) AS valid,
  CAST(count(*) FILTER (errors <> '') AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total
FROM checked_all GROUP BY ROLLUP (signal_type)
""")
_DRIFT_TYPES = {"score": ("number", "integer"), "threshold": ("number", "integer"), "is_positive": ("flag",), "metadata": ("object",),
                "safety_labels": ("object",), "latency_ms": ("integer",)}


def _drift(kind: str, view: str) -> str:
    rules = _CONTRACTS[view]
    required = [name for name, field in rules.items() if ("f IS NULL", "missing") in field]
    usual = " ".join(f"WHEN '{name}' THEN {list(types)}" for name, types in _DRIFT_TYPES.items())
    objects = f"(SELECT object FROM fields_{view} WHERE object IS NOT NULL)"
    return f"""SELECT '{kind}' AS signal_type, field, found, count(*) AS records,
  CASE WHEN found = 'nothing' THEN 'missing' WHEN field NOT IN {tuple(rules)} THEN 'added' ELSE 'retyped' END AS change
FROM (SELECT field, CASE json_type(object, '$.' || field) WHEN 'VARCHAR' THEN 'text' WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer'
      WHEN 'DOUBLE' THEN 'number' WHEN 'BOOLEAN' THEN 'flag' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' ELSE 'null' END AS found
    FROM (SELECT object, unnest(json_keys(object)) AS field FROM {objects})
  UNION ALL SELECT field, 'nothing' FROM (SELECT object, unnest({required}) AS field FROM {objects}) WHERE NOT list_contains(json_keys(object), field))
WHERE found = 'nothing' OR field NOT IN {tuple(rules)} OR NOT list_contains(CASE field {usual} ELSE ['text'] END, found)
GROUP BY field, found"""


oracle("schema_drift", [f"fields_{view}" for view in _CONTRACTS], " UNION ALL ".join(
    _drift(kind, view) for kind, view in (("classifier", "classifier"), ("report", "reports"), ("enforcement", "enforcement"),
                                          ("model_output", "model_outputs"))))
oracle("ingest_mixed", ["checked_all"], """
SELECT coalesce(signal_type, 'TOTAL') AS signal_type, CAST(count(*) FILTER (errors = '') AS BIGINT) AS valid,
  CAST(count(*) FILTER (errors <> '') AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total
FROM checked_all GROUP BY ROLLUP (signal_type)
""")
oracle("envelopes_of_wrong_type", ["checked_all"], """
SELECT CASE signal_type WHEN 'report' THEN 'enforcement' ELSE signal_type END AS signal_type,
  signal_type <> 'report' AS payload_matches, count(*) AS records
FROM checked_all WHERE errors = '' GROUP BY 1, 2
""")
oracle("envelopes_written", ["checked_all"], """
SELECT 'report' AS signal_type, '{source}' AS source, TIMESTAMP '2024-01-31 00:00:00' AS ingested_at, count(*) AS records
FROM checked_all WHERE errors = '' AND signal_type = 'report'
""".replace("{source}", source_name("report", None)))
oracle("dead_letters_written", ["checked_all"], """
SELECT 'ValidationError' AS error_type, 'nightly-batch' AS source,
  CASE signal_type WHEN 'report' THEN '2024-01-29' ELSE '2024-01-31' END AS day, count(*) AS records
FROM checked_all WHERE errors <> '' AND signal_type IN ('report', 'enforcement') GROUP BY 1, 2, 3
""")
oracle("dead_letters_of_last_day", ["checked_all"], """
SELECT count(*) AS dead_letters FROM checked_all WHERE errors <> '' AND signal_type = 'enforcement'
""")
oracle("envelopes", ["checked_all"], """
SELECT signal_type, 'nightly-batch' AS source, TIMESTAMP '2024-01-31 00:00:00' AS ingested_at,
  true AS payload_matches, CAST(count(*) AS BIGINT) AS records
FROM checked_all WHERE errors = '' GROUP BY 1
""")


# -- incremental load ------------------------------------------------------------------------

oracle("incremental_upsert", ["fct_signals_first"])
oracle("since_watermark_rows", ["stg_signals"], """
SELECT signal_id, _loaded_at FROM stg_signals WHERE _loaded_at > (
  SELECT max(_loaded_at) - INTERVAL '3' HOUR FROM stg_signals WHERE _loaded_at <= TIMESTAMP '2024-01-20 00:00:00')
""")

# -- runs ------------------------------------------------------------------------------------

_RETRY = "(retry_count < 2 AND (confidence_score IS NULL OR confidence_score < 0.5))"
_NEXT = ("CASE WHEN NOT list_contains(string_split(history, ','), 'sql') THEN 'sql' "
         "WHEN NOT list_contains(string_split(history, ','), 'vector') THEN 'vector' "
         "WHEN NOT list_contains(string_split(history, ','), 'keyword') THEN 'keyword' END")
oracle("route", ["runs"], """
SELECT run_id, CASE retrieval_strategy WHEN 'sql' THEN 'retrieval_sql' WHEN 'keyword' THEN 'retrieval_keyword'
  ELSE 'retrieval_vector' END AS node FROM runs
""")
oracle("should_retry", ["runs"], f"SELECT run_id, {_RETRY} AS should_retry FROM runs")
oracle("next_strategy", ["runs"], f"SELECT run_id, {_NEXT} AS next_strategy FROM runs")
oracle("after_scoring", ["runs"], f"""
SELECT run_id, CASE WHEN {_RETRY} AND {_NEXT} IS NOT NULL THEN 'retry' ELSE 'end' END AS decision FROM runs
""")
oracle("apply_retry", ["runs"], f"""
SELECT run_id, retry_count + 1 AS retry_count, CAST(NULL AS DOUBLE) AS confidence_score,
  CAST(0 AS INTEGER) AS context_size, CAST(NULL AS VARCHAR) AS synthesised_answer,
  CAST(NULL AS VARCHAR) AS failure_reason,
  CASE WHEN {_NEXT} IS NOT NULL AND coalesce(retrieval_strategy, '') <> ''
      AND NOT list_contains(string_split(history, ','), retrieval_strategy)
    THEN concat(history, CASE WHEN history = '' THEN '' ELSE ',' END, retrieval_strategy)
    ELSE history END AS history
FROM runs
""")
oracle("curate_runs", ["runs"], """
SELECT run_id, query, confidence_score, retry_count FROM runs WHERE confidence_score < 0.5 OR retry_count > 0
""")
oracle("eval_set_written", ["runs"], """
SELECT run_id, query, confidence_score, retry_count FROM runs WHERE retry_count > 0
UNION ALL SELECT run_id, query, confidence_score, retry_count FROM runs WHERE retry_count = 0 AND confidence_score < 0.5
""")
oracle("initial_runs", [], """
SELECT item_id AS run_id, text AS query, CAST(NULL AS VARCHAR) AS signal_type,
  CAST(NULL AS VARCHAR) AS retrieval_strategy, CAST(NULL AS DOUBLE) AS confidence_score,
  CAST(0 AS BIGINT) AS retry_count, CAST(0 AS INTEGER) AS context_size, '' AS history FROM benchmark
""")

# -- dashboard -------------------------------------------------------------------------------

oracle("signals_24h", ["signals_once"], """
SELECT count(*) AS signals FROM signals_once
WHERE _loaded_at > TIMESTAMP '2024-01-30 00:00:00' AND _loaded_at <= TIMESTAMP '2024-01-31 00:00:00'
""")
oracle("dead_letters_24h", ["checked_all"], "SELECT count(*) AS dead_letters FROM checked_all WHERE errors <> ''")
oracle("avg_confidence", ["runs"], "SELECT round(avg(confidence_score), 6) AS avg_confidence FROM runs")
_SHARE = "round(CAST(count(*) FILTER (retry_count > 0) AS DOUBLE) / count(*), 4) AS retry_rate"
oracle("retry_rate", ["runs"], f"SELECT {_SHARE} FROM runs")
oracle("signal_volume", ["signals_once"], """
SELECT date_trunc('day', signal_timestamp)::TIMESTAMP AS day, signal_type, count(*) AS signals
FROM signals_once GROUP BY 1, 2
""")
oracle("strategy_distribution", ["runs"], """
SELECT retrieval_strategy, count(*) AS runs,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM runs), 4) AS share FROM runs GROUP BY 1
""")
oracle("confidence_histogram", ["runs"], """
SELECT CAST(least(floor(confidence_score * 10), 9) AS BIGINT) AS bin, count(*) AS runs
FROM runs WHERE confidence_score IS NOT NULL GROUP BY 1
""")
oracle("retry_trend", ["runs"], f"""
SELECT date_trunc('day', started_at)::TIMESTAMP AS day, count(*) AS runs, {_SHARE} FROM runs GROUP BY 1
""")
relation("latest_loaded", ["signals_once"], """
SELECT signal_type, max(_loaded_at) AS latest_timestamp FROM signals_once GROUP BY 1
""")
relation("freshness", ["latest_loaded"], """
SELECT w.signal_type, coalesce(l.latest_timestamp >= TIMESTAMP '2024-01-31 00:00:00' - w.minutes * INTERVAL '1' MINUTE,
    false) AS is_fresh, l.latest_timestamp, w.minutes AS window_minutes, TIMESTAMP '2024-01-31 00:00:00' AS checked_at
FROM (VALUES ('classifier', 15), ('report', 60), ('enforcement', 60), ('model_output', 30)) w(signal_type, minutes)
LEFT JOIN latest_loaded l ON l.signal_type = w.signal_type
""")
oracle("latest_loaded", ["latest_loaded"])
oracle("freshness", ["freshness"])
oracle("freshness_gauges", ["freshness"], """
SELECT signal_type, CASE signal_type WHEN 'classifier' THEN 'Classifier' WHEN 'report' THEN 'Report'
    WHEN 'enforcement' THEN 'Enforcement' ELSE 'Model Output' END AS label,
  CAST(floor(epoch(checked_at - latest_timestamp) / 60) AS BIGINT) AS minutes_since, window_minutes,
  CASE WHEN is_fresh THEN 'fresh' ELSE 'stale' END AS status
FROM freshness
""")

# -- quality ---------------------------------------------------------------------------------


def _check(table: str, check: str, column: str, broken: str, details: str) -> str:
    return (f"SELECT 'signals' AS suite, '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\","
            f" count(*) FILTER ({broken}) = 0 AS passed, count(*) FILTER ({broken}) AS failing_rows,"
            f" count(*) AS observed, '{details}' AS details FROM {table}")


def _unique(table: str, key: str) -> str:
    return _check("k", "unique", key, "n > 1", "keys that repeat").replace("'k'", f"'{table}'").replace(
        "FROM k", f"FROM (SELECT {key}, count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY 1)")


def _not_null(table: str, columns: list[str]) -> list[str]:
    return [_check(table, "not_null", name, f"{name} IS NULL", "NULL") for name in columns]


_OFF = "outside the accepted values"
oracle("quality_not_null", ["fct_signals_all"], " UNION ALL ".join(
    _not_null("fct_signals_all", [name for name in NOT_NULL["fct_signals"] if name not in ("label", "threshold")])
    + [_check("fct_signals_all", "not_null", name, "signal_type <> 'classifier'", "NULL")
       for name in ("label", "threshold")]))
oracle("quality_unique", ["dim_actions"],
       _unique("fct_signals", "signal_id") + " UNION ALL " + _unique("dim_actions", "action_id"))
oracle("quality_accepted_values", ["fct_signals_all"], " UNION ALL ".join([
    _check("fct_signals_all", "accepted_values", "signal_type", "signal_type NOT IN ('classifier', 'report')", _OFF),
    _check("fct_signals_all", "accepted_values", "severity", "severity NOT IN ('low', 'high')", _OFF),
    _check("fct_signals_all", "accepted_values", "was_enforced", "was_enforced NOT IN (true, false)", _OFF),
    _check("fct_signals_all", "range", "score", "score NOT BETWEEN 0 AND 0.75", "outside [0, 0.75]"),
]))
relation("judged", ["signals_once"], """
SELECT signal_type, day, rows, count(rows) OVER w3 AS n3, avg(rows) OVER w3 AS e3, stddev_pop(rows) OVER w3 AS d3,
  count(rows) OVER w7 AS n7, avg(rows) OVER w7 AS e7, stddev_pop(rows) OVER w7 AS d7
FROM (SELECT signal_type, date_trunc('day', signal_timestamp)::TIMESTAMP AS day, count(*) AS rows
      FROM signals_once GROUP BY 1, 2)
WINDOW w3 AS (PARTITION BY signal_type ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  w7 AS (PARTITION BY signal_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
""")
oracle("row_count_anomaly", ["judged"], """
SELECT signal_type, day, rows, n3 AS days_before, round(e3, 6) AS expected, round(d3, 6) AS deviation,
  coalesce(n3 >= 3 AND abs(rows - e3) > 2 * d3, false) AS is_anomaly FROM judged
""")
relation("suite", ["dim_actions", "dim_entities", "dim_models", "judged", "freshness"], " UNION ALL ".join([
    *[text for table, columns in NOT_NULL.items() for text in _not_null(table, columns)],
    _unique("fct_signals", "signal_id"), _unique("dim_entities", "entity_id"), _unique("dim_models", "model_id"),
    _unique("dim_actions", "action_id"),
    _check("fct_signals", "accepted_values", "signal_type",
           "signal_type NOT IN ('classifier', 'report', 'enforcement', 'model_output')", _OFF),
    _check("fct_signals", "accepted_values", "is_positive", "is_positive NOT IN (true, false)", _OFF),
    _check("fct_signals", "accepted_values", "was_enforced", "was_enforced NOT IN (true, false)", _OFF),
    _check("dim_actions", "accepted_values", "action_type",
           "action_type NOT IN ('warn', 'suspend', 'ban', 'content_removal', 'shadowban', 'escalate')", _OFF),
    _check("fct_signals", "range", "score", "score NOT BETWEEN 0 AND 1", "outside [0, 1]"),
    """SELECT 'signals', 'dim_actions', 'relationship', 'signal_id', count(*) = 0, count(*), count(*),
      'missing in fct_signals' FROM dim_actions WHERE signal_id NOT IN (SELECT signal_id FROM fct_signals)""",
    """SELECT 'signals', 'fct_signals', 'row_count', 'signal_timestamp',
      count(*) FILTER (n7 >= 7 AND abs(rows - e7) > 3 * d7) = 0, count(*) FILTER (n7 >= 7 AND abs(rows - e7) > 3 * d7),
      count(*), 'unusual days' FROM judged""",
    """SELECT 'signals', 'fct_signals', 'freshness', '_loaded_at', is_fresh, CAST(NOT is_fresh AS BIGINT),
      CAST(window_minutes AS BIGINT), signal_type FROM freshness""",
]))
oracle("quality_suite", ["suite"])
oracle("quality_checkpoint", ["suite"], """
SELECT bool_and(passed) AS success, count(*) AS evaluated, count(*) FILTER (passed) AS successful,
  count(*) FILTER (NOT passed) AS unsuccessful,
  round(CAST(count(*) FILTER (passed) AS DOUBLE) * 100 / count(*), 2) AS success_percent FROM suite
""")
oracle("quality_alerts", ["suite"], """
SELECT CASE WHEN "check" = 'freshness' THEN 'freshness' ELSE 'quality' END AS alert_type,
  concat("table", '.', "column") AS subject, "check",
  CASE WHEN "check" = 'freshness' THEN concat('no recent ', details, ' signals')
    ELSE concat(failing_rows, ' ', details) END AS message, TIMESTAMP '2024-01-31 00:00:00' AS raised_at
FROM suite WHERE NOT passed
""")


# -- retrieval -------------------------------------------------------------------------------

_COSINE = "coalesce(nullif(list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[]), 'nan'::DOUBLE), 0)"
oracle("cosine_similarity", [], f"""
SELECT a.vec_id, round({_COSINE.format(a="a.embedding", b="b.embedding")}, 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")


def _ranked(scored: str, k: int, extra: str = "") -> str:
    """The k best per query, by score to 9 places and then id."""
    return f"""
SELECT query_id, id{extra}, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM {scored}
) WHERE rank <= {k}
"""


relation("vector_scores", [], f"""
SELECT q.vec_id AS query_id, d.vec_id AS id, d.label, d.embedding,
  {_COSINE.format(a="q.embedding", b="d.embedding")} AS score
FROM embeddings q CROSS JOIN embeddings d
""")
relation("candidates", ["vector_scores"], _ranked("vector_scores", 10, ", label, embedding"))
oracle("similarity_topk", ["candidates"],
       "SELECT query_id, id, label, round(score, 6) AS score, rank FROM candidates")
oracle("similarity_topk_by_cell", ["candidates"], "SELECT query_id, id, round(score, 6) AS score, rank FROM candidates")
oracle("similarity_topk_filtered", ["vector_scores"], "SELECT query_id, id, round(score, 6) AS score, rank FROM ("
       + _ranked("vector_scores WHERE label = 1", 5) + ")")


def _mmr(candidates: str, steps: int, weight: float) -> list[str]:
    """One relation per step: what is open, its greatest similarity to what is taken, and the pick."""
    names = []
    for step in range(1, steps + 1):
        taken = " UNION ALL ".join(f"SELECT query_id, id, embedding FROM {candidates}_pick{i}" for i in range(1, step))
        if step == 1:
            relation(f"{candidates}_open1", [candidates],
                     f"SELECT query_id, id, embedding, score, {weight} * score AS value FROM {candidates}")
        else:
            similarity = _COSINE.format(a="c.embedding", b="t.embedding")
            relation(f"{candidates}_open{step}", names[:], f"""
SELECT c.query_id, c.id, any_value(c.embedding) AS embedding, any_value(c.score) AS score,
  {weight} * any_value(c.score) - {1 - weight} * max({similarity}) AS value
FROM {candidates} c JOIN ({taken}) t ON t.query_id = c.query_id
GROUP BY c.query_id, c.id HAVING NOT bool_or(c.id = t.id)
""")
        relation(f"{candidates}_pick{step}", [f"{candidates}_open{step}"], f"""
SELECT query_id, id, embedding, score, value, {step} AS step FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(value, 9) DESC, id) AS place
  FROM {candidates}_open{step}) WHERE place = 1
""")
        names.append(f"{candidates}_pick{step}")
    return names


def _mmr_result(names: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT query_id, id, round(score, 6) AS score, round(value, 6) AS mmr_score,"
        f" CAST(step AS INTEGER) AS mmr_rank{extra} FROM {name}" for name in names)


_picks = _mmr("candidates", 5, 0.5)
oracle("mmr", _picks, _mmr_result(_picks))

_WORDS = "list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _embedding(name: str, table: str, key: str) -> None:
    relation(f"{name}_slots", [], f"""
SELECT id, slot, sum(sign) AS total FROM (
  SELECT id, CAST(h % 64 AS INTEGER) AS slot, CASE WHEN (h // 64) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0 END AS sign FROM (
    SELECT id, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM (
      SELECT {key} AS id, unnest({_WORDS.format(text="text")}) AS token FROM {table})))
GROUP BY 1, 2
""")
    relation(f"{name}_unit", [f"{name}_slots"], f"""
SELECT s.id, s.slot, s.total / n.length AS value FROM {name}_slots s JOIN (
  SELECT id, sqrt(sum(total * total)) AS length FROM {name}_slots GROUP BY 1) n ON n.id = s.id
WHERE n.length > 0
""")
    relation(f"{name}_vectors", [f"{name}_unit"], f"""
SELECT t.{key} AS id, list(coalesce(u.value, 0) ORDER BY r.slot) AS embedding
FROM {table} t CROSS JOIN (SELECT CAST(unnest(range(64)) AS INTEGER) AS slot) r
LEFT JOIN {name}_unit u ON u.id = t.{key} AND u.slot = r.slot GROUP BY 1
""")


_embedding("document", "documents", "doc_id")
_embedding("question", "benchmark", "item_id")
oracle("embed_texts", ["document_unit"], "SELECT id, slot, round(value, 6) AS value FROM document_unit WHERE value <> 0")
relation("text_scores", ["question_vectors", "document_vectors"], f"""
SELECT q.id AS query_id, d.id, d.embedding, {_COSINE.format(a="q.embedding", b="d.embedding")} AS score
FROM question_vectors q CROSS JOIN document_vectors d
""")
relation("text_candidates", ["text_scores"], _ranked("text_scores", 10, ", embedding"))
_text_picks = _mmr("text_candidates", 5, 0.5)
oracle("vector_retrieval", _text_picks, _mmr_result(_text_picks, ", 'vector' AS source"))


def _bm25(name: str, where: str) -> None:
    relation(f"{name}_words", [], f"SELECT doc_id AS id, lang, {_WORDS.format(text='text')} AS words FROM documents {where}")
    relation(f"{name}_scores", [f"{name}_words", "terms"], f"""
SELECT t.query_id, c.id, any_value(c.lang) AS lang,
  sum(ln(1 + (s.n - f.df + 0.5) / (f.df + 0.5)) * c.tf * 2.2 / (c.tf + 1.2 * (0.25 + 0.75 * c.length / s.mean_length)))
    AS score
FROM terms t
JOIN (SELECT id, any_value(lang) AS lang, any_value(len(words)) AS length, term, count(*)::DOUBLE AS tf
      FROM (SELECT id, lang, words, unnest(words) AS term FROM {name}_words) GROUP BY id, term) c ON c.term = t.term
JOIN (SELECT term, count(DISTINCT id)::DOUBLE AS df FROM (SELECT id, unnest(words) AS term FROM {name}_words) GROUP BY 1) f
  ON f.term = t.term
CROSS JOIN (SELECT count(*)::DOUBLE AS n, avg(len(words))::DOUBLE AS mean_length FROM {name}_words) s
GROUP BY 1, 2
""")


relation("terms", [], f"SELECT DISTINCT item_id AS query_id, unnest({_WORDS.format(text='text')}) AS term FROM benchmark")
_bm25("all", "")
_bm25("english", "WHERE lang = 'en'")
oracle("keyword_retrieval", ["all_scores"],
       "SELECT query_id, id, lang, round(score, 6) AS score, rank FROM (" + _ranked("all_scores", 10, ", lang") + ")")
ORACLES["keyword_retrieval_indexed"] = ORACLES["keyword_retrieval"]
oracle("keyword_retrieval_filtered", ["english_scores"],
       "SELECT query_id, id, round(score, 6) AS score, rank FROM (" + _ranked("english_scores", 3) + ")")


# -- streaming -------------------------------------------------------------------------------

oracle("stream_ingest", ["checked_all"], """
SELECT signal_type, CASE WHEN e = '' THEN 'valid' ELSE 'dead' END AS outcome, e AS problem, count(*) AS records
FROM (SELECT signal_type, unnest(string_split(errors, '|')) AS e FROM checked_all) GROUP BY 1, 2, 3
""")
oracle("stream_enriched_pairs", ["int_signals_enriched"], """
SELECT signal_id, action_id, signal_timestamp, action_timestamp, was_enforced
FROM int_signals_enriched WHERE action_id IS NOT NULL
""")
oracle("stream_unique_signals", ["stg_signals"], "SELECT signal_id, entity_id, signal_timestamp FROM stg_signals")
oracle("stream_fact", ["fct_signals_first"])
oracle("stream_fact_late", ["fct_signals_first"])
oracle("stream_unique_late", ["stg_signals"], "SELECT signal_id, entity_id, signal_timestamp FROM stg_signals")
oracle("stream_enriched_late", ["int_signals_enriched"], """
SELECT signal_id, action_id, signal_timestamp, action_timestamp, was_enforced FROM int_signals_enriched
""")
oracle("stream_volume_late", ["signals_once"], """
SELECT date_trunc('hour', signal_timestamp)::TIMESTAMP AS window_start,
  date_trunc('hour', signal_timestamp)::TIMESTAMP + INTERVAL '1' HOUR AS window_end, signal_type, count(*) AS signals,
  count(DISTINCT entity_id) AS entities
FROM signals_once GROUP BY 1, 2, 3
""")
oracle("stream_volume", ["signals_once"], """
SELECT date_trunc('hour', signal_timestamp)::TIMESTAMP AS window_start,
  date_trunc('hour', signal_timestamp)::TIMESTAMP + INTERVAL '1' HOUR AS window_end, signal_type, count(*) AS signals
FROM signals_once GROUP BY 1, 2, 3
""")
oracle("stream_freshness", ["freshness"])
