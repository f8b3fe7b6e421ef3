"""Loading a validated batch: envelopes for valid records, dead letters for the rest, and the counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sigmart.functions.time import ntz
from sigmart.operators.marts import count_where
from sigmart.operators.validate import contract, validate
from sigmart.schemas import DEFAULT_SOURCES, ERROR_SCHEMA, SIGNAL_TYPES
from sigmart.session import shared_dir

# The one error type a failed record gets, and two labels of the dead-letter statistics.
ERROR_TYPE = "ValidationError"
UNKNOWN_ERROR = "unknown"
MALFORMED_LINE = "_malformed_line"


@dataclass(frozen=True)
class Batch:
    """One loaded batch. ``checked`` feeds the other two; persist it when both are written."""

    kind: str
    checked: DataFrame
    valid: DataFrame
    dead: DataFrame


def now_utc() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def source_name(kind: str, source: str | None) -> str:
    name = DEFAULT_SOURCES[kind] if source is None else source
    if not name:
        raise ValueError("source must not be empty")
    return name


def envelopes(checked: DataFrame, kind: str, source: str, at: Column) -> DataFrame:
    """Valid records, each payload in the column named after its signal type."""
    return checked.filter(F.size("errors") == 0).select(
        F.expr("uuid()").alias("envelope_id"),
        F.lit(kind).alias("signal_type"),
        F.col("payload").alias(kind),
        F.lit(source).alias("source"),
        at.alias("ingested_at"),
        F.lit(None).cast("timestamp_ntz").alias("loaded_at"),
    )


def error_message(errors: Column, title: str) -> Column:
    """All problems as text: a heading, then field and message of each."""
    count = F.size(errors)
    noun = F.when(count == 1, F.lit(" validation error for ")).otherwise(F.lit(" validation errors for "))
    lines = F.transform(
        errors, lambda e: F.concat(e["field"], F.lit("\n  "), e["message"], F.lit(" [type="), e["type"], F.lit("]"))
    )
    return F.concat_ws("\n", F.concat(count.cast("string"), noun, F.lit(title)), F.array_join(lines, "\n"))


def dead_letters(checked: DataFrame, kind: str, source: str, at: Column, raw: str = "raw") -> DataFrame:
    return checked.filter(F.size("errors") > 0).select(
        F.expr("uuid()").alias("dead_letter_id"),
        F.col(raw).alias("raw_payload"),
        F.lit(ERROR_TYPE).alias("error_type"),
        error_message(F.col("errors"), contract(kind).title).alias("error_message"),
        F.col("errors").cast(ERROR_SCHEMA).alias("error_details"),
        F.lit(source).alias("source"),
        at.alias("failed_at"),
    )


def load_batch(
    df: DataFrame, kind: str, source: str | None = None, raw: str = "raw", at: str | Column | None = None
) -> Batch:
    """Validate a batch of one signal type. ``at`` fixes the ingestion time; by default it is now."""
    name = source_name(kind, source)
    moment = now_utc() if at is None else ntz(at)
    checked = validate(df, kind, raw)
    return Batch(
        kind, checked, envelopes(checked, kind, name, moment), dead_letters(checked, kind, name, moment, raw)
    )


def load_mixed(
    df: DataFrame, source: str | None = None, raw: str = "raw", at: str | Column | None = None
) -> dict[str, Batch]:
    """Split a mixed batch by ``signal_type`` and load each part by its own contract.

    The batch is read once and written into a folder for each type, under the shared folder; each part then reads its own.
    Records of other types, or of none, are in folders that no part reads.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "mixed")
    df.write.partitionBy("signal_type").parquet(path)
    dealt = spark.read.schema(df.schema).parquet(path)
    return {
        kind: load_batch(dealt.filter(F.col("signal_type") == kind).drop("signal_type"), kind, source, raw, at)
        for kind in SIGNAL_TYPES
    }


def union_envelopes(batches: list[Batch]) -> DataFrame:
    """All envelopes in one relation: one nullable payload column per signal type."""
    parts = [batch.valid for batch in batches]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_dead_letters(batches: list[Batch]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [batch.dead for batch in batches])


def payload_matches_type(df: DataFrame) -> Column:
    """True when exactly the payload named by ``signal_type`` is present."""
    present = [F.col(kind).isNotNull() for kind in SIGNAL_TYPES if kind in df.columns]
    named = reduce(
        lambda acc, kind: acc.when(F.col("signal_type") == kind, F.col(kind).isNotNull()),
        [kind for kind in SIGNAL_TYPES if kind in df.columns],
        F.when(F.lit(False), F.lit(False)),
    ).otherwise(F.lit(False))
    total = reduce(lambda a, b: a + b, [flag.cast("int") for flag in present])
    return named & (total == 1)


def flatten(envelope_rows: DataFrame, kind: str, loaded_at: str | Column | None = None) -> DataFrame:
    """Raw-table rows of one signal type. All rows of a load share one ``_loaded_at``."""
    moment = now_utc() if loaded_at is None else ntz(loaded_at)
    return (
        envelope_rows.filter(F.col("signal_type") == kind)
        .select(f"{kind}.*")
        .withColumn("_loaded_at", moment)
    )


def dead_letter_stats(lines: DataFrame) -> DataFrame:
    """Counts by error type over dead-letter lines, as read by ``read_dead_letters``."""
    kind = F.when(F.col("malformed"), F.lit(MALFORMED_LINE)).otherwise(
        F.coalesce(F.col("error_type"), F.lit(UNKNOWN_ERROR))
    )
    return lines.groupBy(kind.alias("error_type")).agg(F.count(F.lit(1)).alias("failures"))


def problem_stats(dead: DataFrame) -> DataFrame:
    """Counts by field and error code; finer than the error type, which is the same for every record."""
    details = dead.select("source", F.explode("error_details").alias("e"))
    return details.groupBy("source", F.col("e.field").alias("field"), F.col("e.type").alias("type")).agg(
        F.count(F.lit(1)).alias("problems")
    )


def ingest_summary(batches: list[Batch]) -> DataFrame:
    """Valid, failed and total records per signal type, and a TOTAL row. Types without records show zeros."""
    outcomes = reduce(
        lambda a, b: a.unionByName(b),
        [
            batch.checked.select(F.lit(batch.kind).alias("signal_type"), (F.size("errors") == 0).alias("_ok"))
            for batch in batches
        ],
    )
    counts = outcomes.groupBy("signal_type").agg(
        count_where(F.col("_ok")).alias("valid"), count_where(~F.col("_ok")).alias("failed")
    )
    spark = counts.sparkSession
    listed = spark.createDataFrame([(kind,) for kind in SIGNAL_TYPES], "signal_type string")
    filled = listed.join(counts, "signal_type", "left").fillna(0, ["valid", "failed"])
    return (
        filled.rollup("signal_type")
        .agg(F.sum("valid").alias("valid"), F.sum("failed").alias("failed"))
        .select(
            F.coalesce("signal_type", F.lit("TOTAL")).alias("signal_type"), "valid", "failed",
            (F.col("valid") + F.col("failed")).alias("total"),
        )
    )
