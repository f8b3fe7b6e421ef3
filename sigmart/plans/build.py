"""The warehouse build: raw tables to staging, the enriched join, the fact and its dimensions."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sigmart.operators import staging
from sigmart.operators.enrich import enrich_signals
from sigmart.operators.incremental import load_changes, stage_by_day, write_key_index
from sigmart.operators.marts import dim_actions, dim_entities, dim_models, fct_signals
from sigmart.operators.observability import freshness
from sigmart.operators.quality import alerts, run_checkpoint, signals_suite
from sigmart.schemas import ACTION_WINDOW_HOURS
from sigmart.session import prepare, shared_dir
from sigmart.sources.readers import read_raw
from sigmart.sources.writers import path_exists, write_alerts, write_dim, write_fact

DIMENSIONS = ("dim_actions", "dim_entities", "dim_models")
FACT_INPUTS = ("classifier_outputs", "enforcement_logs")
LOADS = "table string, file string, load string"
# How a raw table is staged, and the time and day columns of what comes out.
STAGES = {"classifier_outputs": (staging.stg_signals, "signal_timestamp", "signal_day"),
          "enforcement_logs": (staging.stg_enforcement, "action_timestamp", "action_day")}


class Warehouse:
    """Lazy relations of one build. ``raw`` gives the DataFrame of a raw table by name, on first use.

    Nothing runs until a relation is written or acted on.
    """

    def __init__(
        self, raw: Callable[[str], DataFrame], multi: str = "all", hours: int = ACTION_WINDOW_HOURS,
        fact: DataFrame | None = None,
    ) -> None:
        self._raw, self._multi, self._hours, self._fact = raw, multi, hours, fact

    def raw(self, table: str) -> DataFrame:
        return self._raw(table)

    @cached_property
    def stg_signals(self) -> DataFrame:
        return staging.stg_signals(self._raw("classifier_outputs"))

    @cached_property
    def stg_enforcement(self) -> DataFrame:
        return staging.stg_enforcement(self._raw("enforcement_logs"))

    @cached_property
    def stg_reports(self) -> DataFrame:
        return staging.stg_reports(self._raw("user_reports"))

    @cached_property
    def stg_model_outputs(self) -> DataFrame:
        return staging.stg_model_outputs(self._raw("model_outputs"))

    @cached_property
    def int_signals_enriched(self) -> DataFrame:
        return enrich_signals(self.stg_signals, self.stg_enforcement, self._hours, self._multi)

    @property
    def fct_signals(self) -> DataFrame:
        return self._fact if self._fact is not None else fct_signals(self.int_signals_enriched)

    def use_fact(self, fact: DataFrame) -> None:
        """Read a written fact from here on, instead of rebuilding it for each consumer."""
        self._fact = fact

    @property
    def fct_signals_all(self) -> DataFrame:
        return staging.all_signals(self.fct_signals, self.stg_reports, self.stg_enforcement, self.stg_model_outputs)

    @property
    def signals_once(self) -> DataFrame:
        """Every signal of every type once, from staging: what counts and loading times are taken from."""
        return staging.all_signals(self.stg_signals, self.stg_reports, self.stg_enforcement, self.stg_model_outputs)

    @property
    def reports(self) -> DataFrame:
        """The report side of ``fct_signals_all`` alone."""
        return staging.all_signals(reports=self.stg_reports)

    @property
    def dim_actions(self) -> DataFrame:
        return dim_actions(self.fct_signals)

    @property
    def dim_entities(self) -> DataFrame:
        return dim_entities(self.fct_signals)

    @property
    def dim_models(self) -> DataFrame:
        return dim_models(self.fct_signals)

    def relation(self, name: str) -> DataFrame:
        """A relation by name, for the metric registry."""
        return getattr(self, name)


def read_warehouse(spark: SparkSession, raw_root: str, fmt: str = "parquet", **options) -> Warehouse:
    """A build over raw tables stored as ``<raw_root>/<table>``."""
    return Warehouse(lambda table: read_raw(prepare(spark), table, f"{raw_root}/{table}", fmt), **options)


def _unseen_files(spark: SparkSession, warehouse: Warehouse, table: str, loads: DataFrame | None) -> list[str]:
    """Files of a raw table that no earlier build has noted. File names only; the driver lists them for any scan."""
    files = spark.createDataFrame([(file,) for file in warehouse.raw(table).inputFiles()], "file string")
    if loads is not None:
        files = files.join(loads.filter(F.col("table") == table), "file", "left_anti")
    return sorted(row.file for row in files.collect())


def build(spark: SparkSession, raw_root: str, mart_root: str, incremental: bool = True, fmt: str = "parquet") -> None:
    """Build or refresh the marts.

    The fact is written first, by signal day, and every dimension reads the written fact. A fact that exists is
    brought up to date with the raw files it has not seen, whatever their loading times: signals of such files, and
    earlier signals that an action of such files reaches. Every load is staged by event day, so that the next one reads the
    staged days it touches and the raw files that are new. The files seen are noted under the marts after the merge, with
    the load that staged them; staged loads that are not noted do not count, so a build that fails is simply repeated.
    One action per signal, as a keyed merge needs.
    """
    warehouse = read_warehouse(spark, raw_root, fmt, multi="first")
    fact_path, seen_path, staged_path = f"{mart_root}/fct_signals", f"{mart_root}/loads", f"{mart_root}/staged"
    merging = incremental and path_exists(spark, fact_path) and path_exists(spark, seen_path)
    loads = spark.read.schema(LOADS).parquet(seen_path) if merging else None
    fresh = {table: _unseen_files(spark, warehouse, table, loads) for table in FACT_INPUTS}
    load = uuid.uuid4().hex
    new: dict[str, DataFrame] = {}
    for table, files in fresh.items():
        if files:
            stage, column, day = STAGES[table]
            path = f"{staged_path}/{table}/load={load}"
            rows = stage(read_raw(spark, table, files, fmt))
            stage_by_day(rows, column, day, path)
            new[table] = spark.read.schema(StructType([*rows.schema.fields]).add(day, "date")).parquet(path)
    if new:
        noted = [] if loads is None else [row.load for row in loads.select("load").distinct().collect()]  # one for each build
        staged = {table: _staged(spark, f"{staged_path}/{table}", STAGES[table][0](warehouse.raw(table)), STAGES[table][2], [*noted, load])
                  for table in FACT_INPUTS}
        if merging:
            load_changes(spark, fact_path, staged["classifier_outputs"], staged["enforcement_logs"], new.get("classifier_outputs"),
                         new.get("enforcement_logs"), shared_dir(spark, "fact-upsert"))
        else:
            signals, actions = (staged[table].drop(STAGES[table][2], "load") for table in FACT_INPUTS)
            write_fact(fct_signals(enrich_signals(signals, actions, multi="first")), fact_path)
            write_key_index(spark, fact_path)
    elif not merging:
        write_fact(warehouse.fct_signals, fact_path)
    rows = [(table, file, load) for table, files in fresh.items() for file in files]
    spark.createDataFrame(rows, LOADS).coalesce(1).write.mode("append" if merging else "overwrite").parquet(seen_path)
    warehouse.use_fact(spark.read.parquet(fact_path))
    for name in DIMENSIONS:
        write_dim(getattr(warehouse, name), f"{mart_root}/{name}")


def _staged(spark: SparkSession, path: str, like: DataFrame, day: str, loads: list[str]) -> DataFrame:
    """The staged rows of these loads, with the columns ``day`` and load that their folders carry."""
    schema = StructType([*like.schema.fields]).add("load", "string").add(day, "date")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).filter(F.col("load").isin(loads))


def check(
    spark: SparkSession, raw_root: str, mart_root: str, as_of: str, alerts_path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Run every quality check over the written marts; returns the checkpoint row.

    The check rows, a few dozen, are written under the marts first, so that they are computed once.
    """
    tables = {name: spark.read.parquet(f"{mart_root}/{name}") for name in ("fct_signals", *DIMENSIONS)}
    warehouse = read_warehouse(spark, raw_root, fmt, fact=tables["fct_signals"].drop("signal_day"))
    signals = warehouse.signals_once
    rows = signals_suite(tables, signals, freshness(signals, as_of))
    rows.write.mode("overwrite").parquet(f"{mart_root}/quality_checks")
    written = spark.read.parquet(f"{mart_root}/quality_checks")
    if alerts_path is not None:
        write_alerts(alerts(written, F.lit(as_of).cast("timestamp_ntz")), alerts_path, run_id=as_of)
    return run_checkpoint(written)
