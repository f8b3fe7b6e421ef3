"""Raw records as JSON text, derived from every row of the supplied tables.

A fixed share of the rows carries one fault or one unusual but valid spelling per kind, chosen by the row
number, so that each validation rule meets data at every scale. The texts run in both engines.
"""

from __future__ import annotations


def _cases(number: str, usual: str, special: dict[int, str]) -> str:
    if not special:
        return usual
    branches = " ".join(f"WHEN {key} THEN {text}" for key, text in special.items())
    return f"CASE {number} {branches} ELSE {usual} END"


def _quoted(expression: str) -> str:
    """The expression's text as a JSON string."""
    return f"concat('\"', {expression}, '\"')"


def _real(column: str, shown: str | None = None) -> str:
    """A text column (or what is shown of it) as JSON: quotes, backslashes and control characters escaped, null kept."""
    text = shown or column
    for plain, escaped in (("chr(92)", "chr(92)"), ("chr(34)", "chr(34)"), ("chr(10)", "'n'"), ("chr(13)", "'r'"), ("chr(9)", "'t'")):
        text = f"replace({text}, {plain}, concat(chr(92), {escaped}))"
    return f"CASE WHEN {column} IS NULL THEN 'null' ELSE {_quoted(text)} END"


def _record(number: str, fields: dict[str, tuple[str, dict[int, str]]], whole: dict[int, str]) -> str:
    """SQL for one JSON object. A special of ``''`` leaves the field out."""
    parts = []
    for name, (usual, special) in fields.items():
        shown = {k: ("''" if v == "''" else f"concat(', \"{name}\": ', {v})") for k, v in special.items()}
        parts.append(_cases(number, f"concat(', \"{name}\": ', {usual})", shown))
    body = "concat('{{\"seen\": true', " + ", ".join(parts) + ", '}}')"
    return _cases(number, body, whole)


def _text(expression: str) -> str:
    return f"CAST({expression} AS {{text_type}})"


def _uuid(seed: str) -> str:
    digest = f"md5({seed})"
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat(" + ", '-', ".join(f"substr({digest}, {a}, {n})" for a, n in spans) + ")"


_TIME = "concat(substr(CAST(ts AS {text_type}), 1, 10), 'T', substr(CAST(ts AS {text_type}), 12, 8), 'Z')"
_SHARE = "(event_id * 7919) % 10000"
_SCORE = f"concat('0.', lpad({_text(_SHARE)}, 4, '0'))"
_MODEL = ("CASE event_id % 5 WHEN 0 THEN 'toxicity-v3' WHEN 1 THEN 'pii-detector-v1' "
          "WHEN 2 THEN 'prompt-injection-v2' WHEN 3 THEN 'spam-classifier-v4' ELSE 'hate-speech-v2' END")
_ENTITY = f"concat('user-', {_text('user_id')})"

JSON_CLASSIFIER = f"""
SELECT event_id AS raw_id, {_record("event_id % 29", {
    "signal_id": (_quoted(_uuid(f"concat('sig-', {_text('event_id')})")), {10: "'\"sig-1\"'", 27: "'7'"}),
    "model_id": (_quoted(_MODEL), {3: "''", 4: "'\"\"'", 16: "'\"\"'"}),
    "entity_id": (_quoted(_ENTITY), {5: "'null'", 22: "''"}),
    "label": (f"CASE WHEN {_SHARE} < 5000 THEN '\"clean\"' ELSE '\"toxic\"' END", {12: "'5'", 23: "'\"\"'"}),
    "score": (_SCORE, {0: "'1.5'", 1: "'-0.01'", 6: _quoted(_SCORE), 13: "'\"abc\"'", 16: "'2'",
                       20: "'[0.1]'", 24: "'\"nan\"'"}),
    "threshold": ("'0.5'", {8: "'null'", 9: "''", 25: "'1.25'"}),
    "is_positive": (
        f"CASE WHEN {_SHARE} >= 5000 THEN 'true' ELSE 'false' END",
        {2: f"CASE WHEN {_SHARE} >= 5000 THEN 'false' ELSE 'true' END",
         7: f"CASE WHEN {_SHARE} >= 5000 THEN '\"on\"' ELSE '\"off\"' END",
         18: f"CASE WHEN {_SHARE} >= 5000 THEN '1' ELSE '0' END", 26: "'\"maybe\"'"}),
    "timestamp": (_quoted(_TIME), {14: "'\"not a time\"'", 28: "'true'"}),
    "metadata": ("props", {15: "'[1]'", 17: "''"}),
}, {11: "'{{\"model_id\": \"broken'", 21: "'[\"not an object\"]'"})} AS raw
FROM events WHERE event_type IN ('click', 'view', 'signup')
"""

JSON_REPORTS = f"""
SELECT event_id AS raw_id, {_record("event_id % 19", {
    "report_id": (_quoted(_uuid(f"concat('rep-', {_text('event_id')})")), {1: "'\"rep-1\"'"}),
    "reporter_id": (_quoted(f"concat('user-', {_text('user_id % 25')})"), {2: "''", 3: "'\"\"'"}),
    "reported_entity_id": (_quoted(f"concat('user-', {_text('(user_id * 31 + event_id) % 40')})"), {4: "''"}),
    "report_type": (_quoted("CASE event_id % 7 WHEN 0 THEN 'spam' WHEN 1 THEN 'harassment' WHEN 2 THEN "
                            "'hate_speech' WHEN 3 THEN 'csam' WHEN 4 THEN 'self_harm' WHEN 5 THEN "
                            "'misinformation' ELSE 'other' END"), {5: "'\"phishing\"'", 6: "''"}),
    "description": (_quoted(f"concat('  report ', {_text('event_id')}, '  ')"),
                    {7: "''", 8: _quoted("repeat('x', 10001)"), 9: "'\"\"'", 10: "'5'",
                     11: _quoted("concat(repeat(' ', 9000), repeat('x', 1001))")}),
    "severity": (_quoted("CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' "
                         "ELSE 'critical' END"), {12: "''", 13: "'\"urgent\"'", 14: "'null'"}),
    "status": ("'\"pending\"'", {15: "'\"closed\"'", 16: "''"}),
    "timestamp": (_quoted(_TIME), {17: "''"}),
    "metadata": ("props", {18: "'null'"}),
}, {})} AS raw
FROM events WHERE event_type = 'purchase'
"""

JSON_ENFORCEMENT = f"""
SELECT event_id AS raw_id, {_record("event_id % 17", {
    "action_id": (_quoted(_uuid(f"concat('act-', {_text('event_id')})")), {1: "'\"act-1\"'"}),
    "entity_id": (_quoted(_ENTITY), {2: "'\"\"'", 3: "''"}),
    "action_type": (_quoted("CASE event_id % 6 WHEN 0 THEN 'warn' WHEN 1 THEN 'suspend' WHEN 2 THEN 'ban' "
                            "WHEN 3 THEN 'content_removal' WHEN 4 THEN 'shadowban' ELSE 'escalate' END"),
                    {4: "'\"mute\"'", 5: "''"}),
    "policy_id": (_quoted("CASE event_id % 2 WHEN 0 THEN 'policy-tos-v3' ELSE 'policy-spam-v2' END"),
                  {6: "''", 7: "'9'"}),
    "enforced_by": ("'\"auto-enforcer-v2\"'", {8: "'\"\"'"}),
    "reason": (_quoted(f"concat('reason ', {_text('event_id')})"),
               {9: "'\"\"'", 10: _quoted("repeat('r', 5001)"), 11: "''", 12: _quoted("repeat('r', 5000)")}),
    "timestamp": (_quoted(_TIME), {13: "'[]'"}),
    "metadata": ("props", {14: "'\"text\"'"}),
}, {15: "'not json'", 16: "'null'"})} AS raw
FROM events WHERE event_type = 'error'
"""

_HUNDREDTHS = _text("(conv_id * 31 + turn) % 100")
JSON_MODEL_OUTPUTS = f"""
SELECT conv_id * 1000 + turn AS raw_id, {_record("(conv_id + turn) % 13", {
    "output_id": (_quoted(_uuid(f"concat('out-', {_text('conv_id')}, '-', {_text('turn')})")), {}),
    "model_id": (_quoted("CASE conv_id % 2 WHEN 0 THEN 'model-a' ELSE 'model-b' END"), {1: "''"}),
    "prompt_hash": (_real("text", "{sha256}"), {2: "'\"zz\"'", 3: _quoted("concat({sha256}, '0')")}),
    "output_text": (_real("text"), {4: "'\"\"'"}),
    "safety_labels": (f"concat('{{{{\"toxicity\": 0.', lpad({_HUNDREDTHS}, 2, '0'), ', \"pii\": 0.5}}}}')",
                      {5: "'{{\"toxicity\": 0.1, \"pii\": 1.5}}'", 6: "'{{\"pii\": -0.1}}'", 7: "'{{}}'",
                       8: "'{{\"pii\": \"high\"}}'", 9: "''"}),
    "latency_ms": (_text("50 + (conv_id * 13 + turn) % 451"), {10: "'-1'", 11: "'1.5'", 12: "'\"300\"'"}),
    "timestamp": (f"concat('\"2024-01-', lpad({_text('1 + conv_id % 28')}, 2, '0'), 'T10:00:00Z\"')", {}),
}, {})} AS raw
FROM conversations WHERE role = 'assistant'
"""

JSON_VIEWS = {
    "json_classifier": JSON_CLASSIFIER,
    "json_reports": JSON_REPORTS,
    "json_enforcement": JSON_ENFORCEMENT,
    "json_model_outputs": JSON_MODEL_OUTPUTS,
}
