"""Data quality checks. Every check is a row: suite, table, check, column, passed, failing rows, details.

All row-level checks of a table are one aggregation over one scan; its single row is then unfolded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sigmart.functions.time import day_of
from sigmart.operators.marts import count_where
from sigmart.operators.validate import contract
from sigmart.schemas import ACTION_TYPES, SIGNAL_TYPES

SUITE = "signals"
ANOMALY_DAYS = 7
ANOMALY_DEVIATIONS = 3.0

# Which columns of which table must hold.
NOT_NULL = {
    "fct_signals": ["signal_id", "model_id", "entity_id", "label", "score", "threshold", "is_positive",
                    "signal_timestamp", "signal_type", "_loaded_at", "was_enforced"],
    "dim_entities": ["entity_id", "first_seen_at", "last_seen_at", "total_signals", "positive_signal_count",
                     "enforcement_count"],
    "dim_models": ["model_id", "signal_type", "first_seen_at", "last_seen_at", "total_signals"],
    "dim_actions": ["action_id", "entity_id", "action_type", "policy_id", "enforced_by", "enforcement_reason",
                    "action_timestamp", "signal_id"],
}
UNIQUE = {"fct_signals": "signal_id", "dim_entities": "entity_id", "dim_models": "model_id",
          "dim_actions": "action_id"}
ACCEPTED = {
    "fct_signals": {"signal_type": SIGNAL_TYPES, "is_positive": [True, False], "was_enforced": [True, False]},
    "dim_actions": {"action_type": ACTION_TYPES},
}
RANGES = {"fct_signals": {"score": (0.0, 1.0)}}


def _row(table: str, check: str, column: str, failing: Column, observed: Column, details: Column) -> Column:
    return F.struct(
        F.lit(SUITE).alias("suite"), F.lit(table).alias("table"), F.lit(check).alias("check"),
        F.lit(column).alias("column"), (failing == 0).alias("passed"), failing.alias("failing_rows"),
        observed.alias("observed"), details.alias("details"),
    )


def column_checks(
    df: DataFrame,
    table: str,
    not_null: list[str] | None = None,
    accepted: dict[str, list] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Not-null, accepted-value and range checks of one table in one pass. NULL passes the latter two."""
    checks: list[tuple[str, str, Column, str]] = []
    for name in not_null or []:
        checks.append(("not_null", name, F.col(name).isNull(), "NULL"))
    for name, values in (accepted or {}).items():
        checks.append(("accepted_values", name, ~F.col(name).isin(values), "outside the accepted values"))
    for name, (low, high) in (ranges or {}).items():
        outside = ~F.col(name).between(low, high)
        checks.append(("range", name, outside, f"outside [{low:g}, {high:g}]"))
    if not checks:
        raise ValueError("no checks given")
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_where(broken).alias(f"_{i}") for i, (_, _, broken, _) in enumerate(checks)],
    )
    rows = [
        _row(table, check, name, F.col(f"_{i}"), F.col("_rows"), F.lit(details))
        for i, (check, name, _, details) in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def unique_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that occur more than once. Counts combine before the shuffle, so a hot key is one row per task."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(count_where(F.col("_n") > 1).alias("_failing"), F.count(F.lit(1)).alias("_keys"))
    return totals.select(F.inline(F.array(
        _row(table, "unique", key, F.col("_failing"), F.col("_keys"), F.lit("keys that repeat"))
    )))


def reference_check(child: DataFrame, parent: DataFrame, key: str, table: str, parent_table: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    orphans = child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
    totals = orphans.agg(F.count(F.lit(1)).alias("_failing"))
    return totals.select(F.inline(F.array(
        _row(table, "relationship", key, F.col("_failing"), F.col("_failing"), F.lit(f"missing in {parent_table}"))
    )))


def daily_counts(signals: DataFrame) -> DataFrame:
    day = day_of(F.col("signal_timestamp"))
    return signals.groupBy("signal_type", day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def row_count_anomaly(
    signals: DataFrame, days: int = ANOMALY_DAYS, deviations: float = ANOMALY_DEVIATIONS
) -> DataFrame:
    """Each day's count per type against the mean of the days before it.

    The window runs over daily counts: one row per type and day, whatever the number of signals.
    """
    before = Window.partitionBy("signal_type").orderBy("day").rowsBetween(-days, -1)
    judged = daily_counts(signals).select(
        "signal_type", "day", "rows",
        F.count("rows").over(before).alias("days_before"),
        F.avg("rows").over(before).alias("expected"),
        F.stddev_pop("rows").over(before).alias("deviation"),
    )
    odd = (F.col("days_before") >= days) & (
        F.abs(F.col("rows") - F.col("expected")) > deviations * F.col("deviation")
    )
    return judged.withColumn("is_anomaly", F.coalesce(odd, F.lit(False)))


def anomaly_check(signals: DataFrame, table: str) -> DataFrame:
    totals = row_count_anomaly(signals).agg(
        count_where(F.col("is_anomaly")).alias("_failing"), F.count(F.lit(1)).alias("_days")
    )
    return totals.select(F.inline(F.array(
        _row(table, "row_count", "signal_timestamp", F.col("_failing"), F.col("_days"), F.lit("unusual days"))
    )))


def freshness_checks(fresh: DataFrame, table: str) -> DataFrame:
    failing = F.when(F.col("is_fresh"), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    return fresh.select(
        F.lit(SUITE).alias("suite"), F.lit(table).alias("table"), F.lit("freshness").alias("check"),
        F.lit("_loaded_at").alias("column"), F.col("is_fresh").alias("passed"), failing.alias("failing_rows"),
        F.col("window_minutes").cast("bigint").alias("observed"), F.col("signal_type").alias("details"),
    )


class SchemaDrift(ValueError):
    """The columns of a batch differ from those of its target."""


def schema_guard(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The DataFrame unchanged, or an error naming every added, missing or retyped column. Reads no data."""
    have = {field.name: field.dataType for field in df.schema}
    want = {field.name: field.dataType for field in expected}
    drift = [f"added {name}" for name in have if name not in want]
    drift += [f"missing {name}" for name in want if name not in have]
    drift += [
        f"{name} is {have[name].simpleString()}, not {want[name].simpleString()}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    if drift:
        raise SchemaDrift("; ".join(drift))
    return df


# JSON types by the first letters of their variant type's name, and what the contract's fields hold where it is not text.
JSON_TYPES = {"ST": "text", "BI": "integer", "DE": "number", "DO": "number", "FL": "number", "BO": "flag", "OB": "object", "AR": "list"}
USUAL_TYPES = {"score": ["number", "integer"], "threshold": ["number", "integer"], "is_positive": ["flag"], "metadata": ["object"],
               "safety_labels": ["object"], "latency_ms": ["integer"]}


def field_drift(records: DataFrame, kind: str, raw: str = "raw") -> DataFrame:
    """How the JSON objects among raw records differ from the contract: one row for each field and type found.

    ``signal_type``, ``field``, ``found`` (JSON type, or nothing), ``records`` and ``change``: added for a field the
    contract does not know, retyped for a type that is not the field's usual one, missing for a required field that is
    left out. Texts that are no object are none of this check's business. Counts combine before the shuffle.
    """
    fields = contract(kind).fields
    entries = F.from_json(F.col(raw), "map<string, variant>")
    objects = records.select(entries.alias("_entries")).filter(F.col("_entries").isNotNull())
    prefix = F.expr("left(schema_of_variant(value), 2)")
    found = F.coalesce(*(F.when(prefix == start, name) for start, name in JSON_TYPES.items()), F.lit("null"))
    required = [field.name for field in fields if field.required]
    # One more entry per record and required field that it leaves out.
    missing = F.filter(F.array(*map(F.lit, required)), lambda name: ~F.map_contains_key("_entries", name))
    present = objects.select(F.explode("_entries").alias("field", "value")).select("field", found.alias("found"))
    absent = objects.select(F.explode(missing).alias("field")).withColumn("found", F.lit("nothing"))
    usual = F.coalesce(*(F.when(F.col("field") == name, F.array(*map(F.lit, types))) for name, types in USUAL_TYPES.items()),
                       F.array(F.lit("text")))
    change = F.when(F.col("found") == "nothing", "missing").when(~F.col("field").isin([field.name for field in fields]), "added").when(
        ~F.array_contains(usual, F.col("found")), "retyped")
    counts = present.unionAll(absent).groupBy("field", "found").agg(F.count(F.lit(1)).alias("records"))
    return counts.select(F.lit(kind).alias("signal_type"), "field", "found", "records", change.alias("change")).filter(
        F.col("change").isNotNull())


def table_checks(df: DataFrame, table: str) -> DataFrame:
    """All declared checks of one mart table."""
    rows = column_checks(df, table, NOT_NULL.get(table), ACCEPTED.get(table), RANGES.get(table))
    return rows.unionByName(unique_check(df, table, UNIQUE[table])) if table in UNIQUE else rows


def signals_suite(tables: dict[str, DataFrame], signals: DataFrame | None = None,
                  fresh: DataFrame | None = None) -> DataFrame:
    """Every check of the warehouse. ``signals`` adds row-count checks, ``fresh`` adds freshness rows."""
    parts = [table_checks(df, name) for name, df in tables.items()]
    if "dim_actions" in tables and "fct_signals" in tables:
        parts.append(
            reference_check(tables["dim_actions"], tables["fct_signals"], "signal_id", "dim_actions", "fct_signals")
        )
    if signals is not None:
        parts.append(anomaly_check(signals, "fct_signals"))
    if fresh is not None:
        parts.append(freshness_checks(fresh, "fct_signals"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_checkpoint(checks: DataFrame) -> DataFrame:
    """One row: did every check pass, and how many did."""
    passed = count_where(F.col("passed"))
    total = F.count(F.lit(1))
    return checks.agg(
        F.coalesce(F.min("passed"), F.lit(True)).alias("success"),
        total.alias("evaluated"),
        passed.alias("successful"),
        (total - passed).alias("unsuccessful"),
        F.round(passed * 100.0 / F.nullif(total, F.lit(0)), 2).cast("double").alias("success_percent"),
    )


def alerts(checks: DataFrame, raised_at: Column) -> DataFrame:
    """One alert row per failed check."""
    is_stale = F.col("check") == "freshness"
    words = F.when(is_stale, F.concat(F.lit("no recent "), F.col("details"), F.lit(" signals"))).otherwise(
        F.concat(F.col("failing_rows").cast("string"), F.lit(" "), F.col("details"))
    )
    return checks.filter(~F.col("passed")).select(
        F.when(is_stale, F.lit("freshness")).otherwise(F.lit("quality")).alias("alert_type"),
        F.concat_ws(".", "table", "column").alias("subject"),
        F.col("check").alias("check"),
        words.alias("message"),
        raised_at.alias("raised_at"),
    )
