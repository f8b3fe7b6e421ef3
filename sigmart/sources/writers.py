"""Writers. Each is one distributed write; a retried job replaces its own output."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from sigmart.functions.time import day_of


def write_envelopes(df: DataFrame, path: str) -> None:
    """Valid envelopes as JSON lines, replacing what is there."""
    df.write.mode("overwrite").json(path)


def write_dead_letters(df: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Append dead letters, partitioned by the day they failed, so that retention drops whole folders."""
    dated = df.withColumn("failed_on", F.col("failed_at").cast("date"))
    dated.write.mode(mode).partitionBy("failed_on").format(fmt).save(path)


def write_dim(df: DataFrame, path: str) -> None:
    """Full refresh of a dimension."""
    df.write.mode("overwrite").parquet(path)


def write_fact(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The fact by signal day: time-range filters on ``signal_day`` prune folders.

    Rows of a day go to as many tasks as adaptive execution finds worth the size; a heavy day is split. An index of keys
    that upserts have left beside the table does not hold for a rewritten one; ``upsert_fact`` and ``build`` renew it.
    """
    dated = df.withColumn("signal_day", day_of(F.col("signal_timestamp")).cast("date"))
    dated.hint("rebalance", "signal_day").write.mode(mode).partitionBy("signal_day").parquet(path)


def write_eval_set(curated: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add curated runs to the evaluation set; see :func:`write_run`."""
    write_run(curated, path, run_id)


def write_alerts(alert_rows: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add alert rows; see :func:`write_run`."""
    write_run(alert_rows, path, run_id)


def write_run(df: DataFrame, path: str, run_id: str | None) -> None:
    """Add the rows of one run. With a ``run_id`` they have a folder of their own, which a repeated run replaces."""
    if run_id is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path}/run_id={quote(run_id, safe='')}")


def register_views(relations: dict[str, DataFrame]) -> list[str]:
    """Temporary views over lazy relations, for SQL users."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)
    return sorted(relations)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a readable Parquet table."""
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as error:  # the reader reports a missing path as an analysis error
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
