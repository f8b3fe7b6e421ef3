"""Record validation as columns.

A record arrives as one line of JSON text. It is parsed once into a struct of VARIANT fields, which keeps
the three cases apart that validation must tell apart: a field that is absent (SQL NULL), one that is
explicitly null (a VARIANT null) and one of the wrong kind. Each field contributes a typed value and an
array of problems; a record is valid when the concatenated problems are empty. No Python runs per record.

The field checks are written as SQL expressions: a contract is some hundred of them, and one parsed text
builds far faster than as many separate column calls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sigmart.functions.text import WHITESPACE
from sigmart.schemas import (
    ACTION_TYPES, DEFAULT_SEVERITY, DEFAULT_STATUS, DEFAULT_THRESHOLD, ERROR_SCHEMA, MAX_DESCRIPTION_CHARS,
    MAX_REASON_CHARS, REPORT_STATUSES, REPORT_TYPES, SEVERITIES, SHA256_HEX_PATTERN,
)

# --------------------------------------------------------------------------------------------
# Accepted spellings, the epoch unit boundary and the texts of the error types.
# --------------------------------------------------------------------------------------------
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]
EPOCH_SECONDS_LIMIT = 2e10
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*\z"
LEADING_INTEGER = r"^\s*([+-]?\d+)"
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0+)?\s*\z"
UUID_TEXT = r"(?i)^(urn:uuid:)?\{?[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\}?\z"
TIME_TEXT = r"(?i)^\d{4}-\d{2}-\d{2}([T_ ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?\z"
OFFSET_TEXT = r"(?i)(Z|:\d{2}(\.\d+)?[+-]\d{2}:?\d{2})\z"
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "string_too_short": "String should have at least {0} character",
    "string_too_long": "String should have at most {0} characters",
    "string_pattern_mismatch": "String should match pattern '{0}'",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "greater_than_equal": "Input should be greater than or equal to {0}",
    "less_than_equal": "Input should be less than or equal to {0}",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "datetime_type": "Input should be a valid datetime",
    "datetime_from_date_parsing": "Input should be a valid datetime or date",
    "enum": "Input should be {0}",
    "uuid_type": "UUID input should be a string, bytes or UUID object",
    "uuid_parsing": "Input should be a valid UUID",
    "dict_type": "Input should be a valid dictionary",
    "model_type": "Input should be a valid dictionary or instance of {0}",
    "json_invalid": "Invalid JSON",
    "value_error": "Value error, {0}",
}
SCORE_OUTSIDE = (
    "Value error, score=%s is outside the valid range [0.0, 1.0]. Classifier scores must be probabilities."
)
FLAG_INCONSISTENT = (
    "Value error, is_positive=%s is inconsistent with score=%s and threshold=%s. Expected is_positive=%s."
)
LABEL_OUTSIDE = (
    "Value error, safety_labels['%s']=%s is outside [0.0, 1.0]. All safety scores must be probabilities."
)
# --------------------------------------------------------------------------------------------

PARSED = "_parsed"
CORRUPT = "_corrupt"
PROBLEM_TYPE = "STRUCT<field: STRING, message: STRING, type: STRING, input: STRING>"
NO_PROBLEMS = f"CAST(array() AS ARRAY<{PROBLEM_TYPE}>)"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(words: list[str]) -> str:
    return ", ".join(quoted(word) for word in words)


def problem_at(field: str, message: str, code: str, shown: str) -> str:
    """One error, as SQL for where, what in words, what as a code, and the offending input as JSON text."""
    return f"named_struct('field', {field}, 'message', {message}, 'type', {code}, 'input', {shown})"


def case(*branches: tuple[str, str], otherwise: str = "NULL") -> str:
    """SQL CASE over (condition, result); the first condition that holds decides."""
    return f"CASE {' '.join(f'WHEN {when} THEN {then}' for when, then in branches)} ELSE {otherwise} END"


class Value:
    """A VARIANT and the expressions validation needs of it.

    ``facts`` of a field are computed once, as columns named after it; ``inline`` values, such as the
    entries of a map, repeat the expressions instead.
    """

    def __init__(self, variant: str, kind: str, text: str, number: str, flag: str, typed: str) -> None:
        self.variant, self.kind, self.text, self.number, self.flag, self.typed = variant, kind, text, number, flag, typed
        self.shown = f"to_json({variant})"
        self.absent = f"{variant} IS NULL"
        self.is_text = f"{kind} = 'ST'"
        self.is_flag = f"{kind} = 'BO'"
        self.is_integer = f"{kind} = 'BI'"
        self.is_number = f"{kind} IN ('BI', 'DE', 'DO', 'FL')"
        self.is_scalar = f"{kind} IN ('ST', 'BO', 'BI', 'DE', 'DO', 'FL')"
        self.is_object = f"{kind} = 'OB'"

    @classmethod
    def inline(cls, variant: str) -> Value:
        return cls(variant, *cls.facts_of(variant).values(), typed="NULL")

    @classmethod
    def of_field(cls, name: str) -> Value:
        return cls(f"`_variant_{name}`", *[f"`_{fact}_{name}`" for fact in cls.facts_of("")], typed=f"`_typed_{name}`")

    @staticmethod
    def facts_of(variant: str) -> dict[str, str]:
        """What is asked of a value more than once. The kind is the first two letters of the type's name.

        A value is read only as what it is: reading text as a number would fail inside for every record.
        """
        kind = f"left(schema_of_variant({variant}), 2)"
        return {
            "kind": kind,
            "text": f"CASE WHEN {kind} = 'ST' THEN try_variant_get({variant}, '$', 'string') END",
            "number": f"CASE WHEN {kind} IN ('BI', 'DE', 'DO', 'FL') THEN try_variant_get({variant}, '$', 'double') END",
            "flag": f"CASE WHEN {kind} = 'BO' THEN try_variant_get({variant}, '$', 'boolean') END",
        }

    def read_as(self, dtype: str) -> str:
        return f"try_variant_get({self.variant}, '$', '{dtype}')"

    def text_like(self, pattern: str) -> str:
        return f"{self.text} RLIKE {quoted(pattern)}"

    @property
    def as_double(self) -> str:
        """Numbers, booleans and numeric text; NULL when it cannot be read as a number."""
        return case(
            (self.is_number, self.number),
            (f"{self.is_text} AND {self.text_like(NUMBER_TEXT)}", f"try_cast(trim({self.text}) AS DOUBLE)"),
            (self.is_flag, f"CAST({self.flag} AS DOUBLE)"),
        )

    @property
    def as_boolean(self) -> str:
        return case(
            (self.is_flag, self.flag),
            (f"{self.is_text} AND lower({self.text}) IN ({listed(TRUE_WORDS)})", "true"),
            (f"{self.is_text} AND lower({self.text}) IN ({listed(FALSE_WORDS)})", "false"),
            (f"{self.is_number} AND {self.number} = 1", "true"),
            (f"{self.is_number} AND {self.number} = 0", "false"),
        )

    @property
    def as_bigint(self) -> str:
        digits = f"regexp_extract({self.text}, {quoted(LEADING_INTEGER)}, 1)"
        return case(
            (self.is_integer, self.read_as("bigint")),
            (f"{self.is_text} AND {self.text_like(INTEGER_TEXT)}", f"try_cast({digits} AS BIGINT)"),
            (self.is_flag, f"CAST({self.flag} AS BIGINT)"),
            (f"{self.is_number} AND {self.number} = floor({self.number})", f"try_cast({self.number} AS BIGINT)"),
        )

    @property
    def as_timestamp(self) -> str:
        """ISO text or epoch seconds (milliseconds beyond the boundary), as UTC wall-clock time."""
        iso = f"translate({self.text}, 't_ ', 'TTT')"
        instant = f"to_utc_timestamp(try_cast({iso} AS TIMESTAMP), current_timezone())"
        unit = f"CASE WHEN abs({self.as_double}) > {EPOCH_SECONDS_LIMIT:.0f} THEN 1000 ELSE 1 END"
        seconds = f"({self.as_double}) / ({unit})"
        in_reach = f"NOT isnan({self.as_double}) AND abs({seconds}) < 1e11"
        epoch = ("TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
                 f"CASE WHEN {in_reach} THEN CAST({seconds} AS DECIMAL(18, 6)) END)")
        return case(
            (f"{self.is_text} AND {self.text_like(TIME_TEXT)} AND {self.text_like(OFFSET_TEXT)}",
             f"CAST({instant} AS TIMESTAMP_NTZ)"),
            (f"{self.is_text} AND {self.text_like(TIME_TEXT)}", f"try_cast({iso} AS TIMESTAMP_NTZ)"),
            (f"{self.is_text} OR {self.is_number}", epoch),
        )


Faults = Callable[[Value], list[tuple[str, str, str]]]


@dataclass(frozen=True)
class Field:
    """How one field is read.

    ``typed`` is SQL for its typed value, NULL where it cannot be read as its type. ``faults`` lists
    (condition, code, message): the first condition that holds is the field's problem. ``default`` stands in
    when the field is absent. ``details`` overrides the array of problems made from the code.
    """

    name: str
    typed: Callable[[Value], str]
    faults: Faults
    default: str | None = None
    required: bool = True
    details: Callable[[Value], str] | None = None

    @property
    def code(self) -> str:
        return f"`_fault_{self.name}`"

    def value(self, v: Value) -> str:
        return v.typed if self.default is None else case((v.absent, self.default), otherwise=v.typed)

    def fault(self, v: Value) -> str:
        """The code of the field's problem, or NULL."""
        absent = "'missing'" if self.required else "NULL"
        found = [(condition, quoted(code) if code else "NULL") for condition, code, _ in self.faults(v)]
        return case((v.absent, absent), *found)

    def problems(self, v: Value, record: str) -> str:
        """The field's problems as an array, given its code."""
        if self.details is not None:
            return case((f"{self.code} IS NULL", NO_PROBLEMS), otherwise=self.details(v))
        words = [(f"{self.code} = {quoted(code)}", quoted(message)) for _, code, message in self.faults(v) if code]
        message = case((f"{self.code} = 'missing'", quoted(MESSAGES["missing"])), *words)
        shown = case((f"{self.code} = 'missing'", record), otherwise=v.shown)
        return case(
            (f"{self.code} IS NULL", NO_PROBLEMS),
            otherwise=f"array({problem_at(quoted(self.name), message, self.code, shown)})",
        )


def fault(condition: str, code: str, *details: object) -> tuple[str, str, str]:
    return condition, code, MESSAGES[code].format(*details)


def text_field(
    name: str, shortest: int = 0, longest: int | None = None, pattern: str | None = None,
    default: str | None = None, stripped: bool = False,
) -> Field:
    def faults(v: Value) -> list[tuple[str, str, str]]:
        out = [fault(f"NOT ({v.is_text})", "string_type")]
        if shortest:
            out.append(fault(f"length({v.text}) < {shortest}", "string_too_short", shortest))
        if longest is not None:
            out.append(fault(f"length({v.text}) > {longest}", "string_too_long", longest))
        if pattern is not None:
            # `$` would let a trailing newline through
            whole = pattern.removesuffix("$") + r"\z"
            out.append(fault(f"NOT ({v.text_like(whole)})", "string_pattern_mismatch", pattern))
        return out

    def typed(v: Value) -> str:
        return f"btrim({v.text}, {quoted(WHITESPACE)})" if stripped else v.text

    return Field(name, typed, faults, None if default is None else quoted(default), default is None)


def choice_field(name: str, choices: list[str], default: str | None = None) -> Field:
    words = [f"'{choice}'" for choice in choices]
    offered = f"{', '.join(words[:-1])} or {words[-1]}"

    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [fault(f"NOT ({v.is_text} AND {v.text} IN ({listed(choices)}))", "enum", offered)]

    return Field(name, lambda v: v.text, faults, None if default is None else quoted(default), default is None)


def number_field(name: str, low: float, high: float, default: float | None = None) -> Field:
    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [
            fault(f"NOT ({v.is_scalar})", "float_type"),
            fault(f"{v.typed} IS NULL", "float_parsing"),
            # NaN is no fault of the field; the record rule catches it
            (f"isnan({v.typed})", "", ""),
            fault(f"{v.typed} < {low}", "greater_than_equal", f"{low:g}"),
            fault(f"{v.typed} > {high}", "less_than_equal", f"{high:g}"),
        ]

    shown_default = None if default is None else f"CAST({default} AS DOUBLE)"
    return Field(name, lambda v: v.as_double, faults, shown_default, default is None)


def integer_field(name: str, low: int, default: int | None = None) -> Field:
    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [
            fault(f"NOT ({v.is_scalar})", "int_type"),
            fault(f"{v.typed} IS NULL AND {v.is_number}", "int_from_float"),
            fault(f"{v.typed} IS NULL", "int_parsing"),
            fault(f"{v.typed} < {low}", "greater_than_equal", low),
        ]

    shown_default = None if default is None else f"CAST({default} AS BIGINT)"
    return Field(name, lambda v: v.as_bigint, faults, shown_default, default is None)


def flag_field(name: str) -> Field:
    def faults(v: Value) -> list[tuple[str, str, str]]:
        fraction = f"{v.is_number} AND {v.number} <> floor({v.number})"
        return [
            fault(f"NOT ({v.is_scalar}) OR ({fraction})", "bool_type"),
            fault(f"{v.typed} IS NULL", "bool_parsing"),
        ]

    return Field(name, lambda v: v.as_boolean, faults)


def time_field(name: str) -> Field:
    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [
            fault(f"NOT ({v.is_text} OR {v.is_number})", "datetime_type"),
            fault(f"{v.typed} IS NULL", "datetime_from_date_parsing"),
        ]

    return Field(name, lambda v: v.as_timestamp, faults)


def id_field(name: str) -> Field:
    """A UUID, generated when absent. Generated ids are new on every evaluation: write before reuse."""

    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [fault(f"NOT ({v.is_text})", "uuid_type"), fault(f"NOT ({v.text_like(UUID_TEXT)})", "uuid_parsing")]

    def typed(v: Value) -> str:
        lower = f"lower({v.text})"
        digits = f"regexp_replace({lower}, {quoted('^urn:uuid:|[{}-]')}, '')"
        dashed = f"regexp_replace({digits}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
        usual = f"length({lower}) = 36 AND substring({lower}, 9, 1) = '-' AND substring({lower}, 24, 1) = '-'"
        return case((usual, lower), otherwise=dashed)

    return Field(name, typed, faults, "uuid()", required=False)


def object_field(name: str) -> Field:
    """A free-form object, kept as JSON text; an empty object when absent."""

    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [fault(f"NOT ({v.is_object})", "dict_type")]

    return Field(name, lambda v: v.shown, faults, "'{}'", required=False)


def score_map_field(name: str) -> Field:
    """A map of scores. Unreadable scores are reported per key; of scores out of range, the first."""
    entry = Value.inline("e.value")
    unreadable = f"({entry.is_scalar}) IS NOT TRUE OR ({entry.as_double}) IS NULL"
    outside = f"isnan({entry.as_double}) OR NOT ({entry.as_double}) BETWEEN 0 AND 1"

    def entries(v: Value) -> str:
        return f"CASE WHEN {v.is_object} THEN map_entries({v.read_as('map<string,variant>')}) END"

    def faults(v: Value) -> list[tuple[str, str, str]]:
        return [
            fault(f"NOT ({v.is_object})", "dict_type"),
            fault(f"exists({entries(v)}, e -> {unreadable})", "float_parsing"),
            (f"exists({entries(v)}, e -> {outside})", "value_error", ""),
        ]

    def details(v: Value) -> str:
        where = f"concat({quoted(name + ' -> ')}, e.key)"
        code = case((f"({entry.is_scalar}) IS NOT TRUE", "'float_type'"), otherwise="'float_parsing'")
        words = case((f"({entry.is_scalar}) IS NOT TRUE", quoted(MESSAGES["float_type"])),
                     otherwise=quoted(MESSAGES["float_parsing"]))
        per_key = f"transform(filter({entries(v)}, e -> {unreadable}), e -> {problem_at(where, words, code, entry.shown)})"
        first = f"slice(filter({entries(v)}, e -> {outside}), 1, 1)"
        complaint = f"format_string({quoted(LABEL_OUTSIDE)}, e.key, to_json(e.value))"
        return case(
            (f"`_fault_{name}` = 'dict_type'",
             f"array({problem_at(quoted(name), quoted(MESSAGES['dict_type']), quoted('dict_type'), v.shown)})"),
            (f"`_fault_{name}` = 'float_parsing'", per_key),
            otherwise=f"transform({first}, e -> {problem_at(quoted(name), complaint, quoted('value_error'), v.shown)})",
        )

    def typed(v: Value) -> str:
        return f"map_from_entries(transform({entries(v)}, e -> struct(e.key, {entry.as_double})))"

    return Field(name, typed, faults, "CAST(map() AS MAP<STRING, DOUBLE>)", required=False, details=details)


# Record rules look at the typed values and give the words of their complaint, or NULL.
_SCORE, _THRESHOLD, _FLAG = "_values.score", "_values.threshold", "_values.is_positive"
_OUTSIDE = case((
    f"isnan({_SCORE}) OR {_SCORE} < 0 OR {_SCORE} > 1",
    f"format_string({quoted(SCORE_OUTSIDE)}, CAST({_SCORE} AS STRING))",
))
# Spark orders NaN above every number; a NaN threshold is reached by nothing
_REACHED = f"({_SCORE} >= {_THRESHOLD} AND NOT isnan({_THRESHOLD}))"
_INCONSISTENT = case((
    f"{_FLAG} <> {_REACHED}",
    f"format_string({quoted(FLAG_INCONSISTENT)}, initcap(CAST({_FLAG} AS STRING)), CAST({_SCORE} AS STRING), "
    f"CAST({_THRESHOLD} AS STRING), initcap(CAST({_REACHED} AS STRING)))",
))


@dataclass(frozen=True)
class Contract:
    """The fields of a signal type in declared order, then its record rules over the typed values."""

    title: str
    fields: list[Field]
    rules: tuple[str, ...] = ()


CONTRACTS = {
    "classifier": Contract(
        "ClassifierOutput",
        [
            id_field("signal_id"),
            text_field("model_id", shortest=1),
            text_field("entity_id", shortest=1),
            text_field("label", shortest=1),
            number_field("score", 0, 1),
            number_field("threshold", 0, 1, default=DEFAULT_THRESHOLD),
            flag_field("is_positive"),
            time_field("timestamp"),
            object_field("metadata"),
        ],
        (_OUTSIDE, _INCONSISTENT),
    ),
    "report": Contract(
        "UserReport",
        [
            id_field("report_id"),
            text_field("reporter_id", shortest=1),
            text_field("reported_entity_id", shortest=1),
            choice_field("report_type", REPORT_TYPES),
            text_field("description", longest=MAX_DESCRIPTION_CHARS, default="", stripped=True),
            choice_field("severity", SEVERITIES, default=DEFAULT_SEVERITY),
            choice_field("status", REPORT_STATUSES, default=DEFAULT_STATUS),
            time_field("timestamp"),
            object_field("metadata"),
        ],
    ),
    "enforcement": Contract(
        "EnforcementLog",
        [
            id_field("action_id"),
            text_field("entity_id", shortest=1),
            choice_field("action_type", ACTION_TYPES),
            text_field("policy_id", shortest=1),
            text_field("enforced_by", shortest=1),
            text_field("reason", shortest=1, longest=MAX_REASON_CHARS),
            time_field("timestamp"),
            object_field("metadata"),
        ],
    ),
    "model_output": Contract(
        "ModelOutput",
        [
            id_field("output_id"),
            text_field("model_id", shortest=1),
            text_field("prompt_hash", pattern=SHA256_HEX_PATTERN),
            text_field("output_text", shortest=1),
            score_map_field("safety_labels"),
            integer_field("latency_ms", 0, default=0),
            time_field("timestamp"),
            object_field("metadata"),
        ],
    ),
}


def contract(kind: str) -> Contract:
    if kind not in CONTRACTS:
        raise ValueError(f"unknown signal type {kind!r}; known: {', '.join(CONTRACTS)}")
    return CONTRACTS[kind]


def parse(df: DataFrame, fields: list[Field], raw: str) -> DataFrame:
    """Add the parsed record: one VARIANT per field, and the text itself where it is no JSON object."""
    columns = ", ".join(f"`{field.name}` VARIANT" for field in fields)
    options = {"columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn(PARSED, F.from_json(F.col(raw), f"{columns}, `{CORRUPT}` STRING", options))


def validate(df: DataFrame, kind: str, raw: str = "raw") -> DataFrame:
    """Add ``payload`` (the typed record, NULL when invalid) and ``errors`` (empty when valid).

    Four projections: what each value is, its typed form, the code of its problem, and, for records that have
    one, the problems in full.
    """
    spec = contract(kind)
    fields = spec.fields
    record = f"`{raw}`"
    read = {field.name: Value.of_field(field.name) for field in fields}

    opened = parse(df, fields, raw).select(
        *df.columns,
        F.expr(f"({PARSED} IS NULL OR {PARSED}.{CORRUPT} IS NOT NULL) AS _unreadable"),
        *[F.expr(f"{PARSED}.`{name}` AS {v.variant}") for name, v in read.items()],
    )
    facts = {
        f"_{fact}_{name}": F.expr(sql) for name, v in read.items() for fact, sql in Value.facts_of(v.variant).items()
    }
    typed = {f"_typed_{field.name}": F.expr(field.typed(read[field.name])) for field in fields}
    codes = {f"_fault_{field.name}": F.expr(field.fault(read[field.name])) for field in fields}
    judged = opened.withColumns(facts).withColumns(typed).withColumns(codes)

    # Exploding one element per record fixes these results as columns: a later filter on them reads the columns
    # instead of being pushed down as a second copy of every field check.
    values = ", ".join(f"{field.value(read[field.name])} AS `{field.name}`" for field in fields)
    kept = ["_unreadable", *[field.code for field in fields], *[v.variant for v in read.values()],
            *[v.kind for v in read.values()]]
    fixed = F.expr(f"explode(array(struct({', '.join(kept)}, struct({values}) AS _values)))")
    checked = judged.select(*df.columns, fixed.alias("_fixed")).select(*df.columns, "_fixed.*")

    unreadable = case(
        (f"try_parse_json({record}) IS NULL",
         problem_at("''", quoted(MESSAGES["json_invalid"]), "'json_invalid'", record)),
        otherwise=problem_at("''", quoted(MESSAGES["model_type"].format(spec.title)), "'model_type'", record),
    )
    complaint = f"coalesce({', '.join(spec.rules)}, NULL)" if spec.rules else "NULL"
    any_fault = f"coalesce({', '.join(field.code for field in fields)}) IS NOT NULL"
    in_full = f"concat({', '.join(field.problems(read[field.name], record) for field in fields)})"
    errors = case(
        ("_unreadable", f"array({unreadable})"),
        (any_fault, in_full),
        (f"{complaint} IS NOT NULL", f"array({problem_at(quoted(''), complaint, quoted('value_error'), record)})"),
        otherwise=NO_PROBLEMS,
    )
    return checked.select(
        *df.columns,
        F.expr(errors).cast(ERROR_SCHEMA).alias("errors"),
        F.expr(case((f"_unreadable OR {any_fault} OR {complaint} IS NOT NULL", "NULL"), otherwise="_values")).alias("payload"),
    )


def validate_classifier(df: DataFrame, raw: str = "raw") -> DataFrame:
    return validate(df, "classifier", raw)


def validate_reports(df: DataFrame, raw: str = "raw") -> DataFrame:
    return validate(df, "report", raw)


def validate_enforcement(df: DataFrame, raw: str = "raw") -> DataFrame:
    return validate(df, "enforcement", raw)


def validate_model_outputs(df: DataFrame, raw: str = "raw") -> DataFrame:
    return validate(df, "model_output", raw)
