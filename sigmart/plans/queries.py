"""Every operator as a query over a folder of supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sigmart.functions.time import ntz
from sigmart.functions.vectors import cosine_col
from sigmart.operators import envelope as E
from sigmart.operators import kept as P
from sigmart.operators import metrics as M
from sigmart.operators import observability as K
from sigmart.operators import quality as Q
from sigmart.operators import runs as R
from sigmart.operators import staging as stg
from sigmart.operators.embed import embed_documents, md5_hash
from sigmart.operators.enrich import enrich_signals
from sigmart.operators.incremental import load_changes, since_watermark, stage_by_day
from sigmart.operators.keyword import keyword_search
from sigmart.operators.marts import fct_signals as fct
from sigmart.operators.postings import search_postings, write_postings
from sigmart.operators.retrieval import vector_retrieve
from sigmart.operators.similarity import mmr_rerank, similarity_search
from sigmart.operators.validate import validate
from sigmart.plans.build import Warehouse
from sigmart.plans.supplied import Supplied
from sigmart.session import materialize, shared_dir
from sigmart.sources.readers import parse_dead_letter_lines, read_dead_letters, read_documents, read_vectors, spread
from sigmart.sources.writers import write_dead_letters, write_dim, write_envelopes, write_eval_set, write_fact
from sigmart.streaming import jobs as S
from sigmart.streaming import late as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def warehouse(spark: SparkSession, sf_dir: str, multi: str = "all") -> Warehouse:
    data = Supplied(spark, sf_dir)

    def raw(table: str) -> DataFrame:
        df = data.raw(f"raw_{table}")
        if table == "model_outputs":
            labels = F.create_map(F.lit("toxicity"), "toxicity", F.lit("pii"), "pii")
            df = df.withColumn("safety_labels", labels)
        return df

    return Warehouse(raw, multi)


# -- staging, fact, dimensions ---------------------------------------------------------------


@query
def stg_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).stg_signals


@query
def stg_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).stg_enforcement


@query
def stg_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).stg_reports


@query
def stg_model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = warehouse(spark, sf_dir).stg_model_outputs
    labels = [F.element_at("safety_labels", name).alias(name) for name in ("toxicity", "pii")]
    return staged.select(*[c for c in staged.columns if c != "safety_labels"], *labels)


@query
def int_signals_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).int_signals_enriched


@query
def fct_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).fct_signals


@query
def fct_signals_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir, multi="first").fct_signals


@query
def fct_signals_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).fct_signals_all.select(
        "signal_id", "model_id", "entity_id", "signal_timestamp", "signal_type", "action_id", "action_type",
        "report_type", "severity", "reporter_id", "reported_entity_id", "prompt_hash", "latency_ms", "score",
        "is_positive", "was_enforced", "_loaded_at",
    )


@query
def dim_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).dim_actions


@query
def dim_actions_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after two full refreshes of a written one."""
    w, path = written(spark, sf_dir), shared_dir(spark, "dim_actions")
    for _ in range(2):
        write_dim(w.dim_actions, path)
    return spark.read.parquet(path)


@query
def stg_signals_with_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal times as text in three zones, staged as UTC."""
    raw = Supplied(spark, sf_dir).raw("raw_classifier_outputs")
    number = F.substring("signal_id", 5, 20).cast("long")
    zone = F.when(number % 3 == 0, "Z").when(number % 3 == 1, "+02:00").otherwise("-05:30")
    text = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone)
    return stg.stg_signals(raw.withColumn("timestamp", text)).select("signal_id", "signal_timestamp")


@query
def dim_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).dim_entities


@query
def dim_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = warehouse(spark, sf_dir).dim_models
    return dims.withColumns({name: F.round(name, 6) for name in ("avg_score", "positive_rate")})


# -- metrics ---------------------------------------------------------------------------------


def written(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse whose fact is built once and written by day, as the dimensions and both sides of a metric read it."""
    built = warehouse(spark, sf_dir)
    path = shared_dir(spark, "fct_signals")
    write_fact(built.fct_signals, path)
    built.use_fact(spark.read.parquet(path))
    return built


@query
def classifier_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = written(spark, sf_dir)
    return M.classifier_precision(w.fct_signals, w.dim_actions)


@query
def classifier_precision_one_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = written(spark, sf_dir)
    return M.metrics.run(
        "classifier_precision", w.relation,
        model_id="toxicity-v3", start_date="2024-01-05", end_date="2024-01-20",
    )


@query
def enforcement_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = written(spark, sf_dir)
    return M.enforcement_rate(w.fct_signals, w.dim_actions)


@query
def enforcement_rate_bans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.metrics.run(
        "enforcement_rate", written(spark, sf_dir).relation,
        action_type="ban", start_date="2024-01-05", end_date="2024-01-20",
    )


@query
def report_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.report_volume(warehouse(spark, sf_dir).reports)


@query
def report_volume_first_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest and largest hundred rows, as retrieval context takes them."""
    return M.report_volume(warehouse(spark, sf_dir).reports, row_limit=100)


@query
def report_volume_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.metrics.run(
        "report_volume", warehouse(spark, sf_dir).relation,
        report_type="spam", start_date="2024-01-30 06:00:00", end_date="2024-01-30 18:00:00",
    )


@query
def sql_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sql_retrieve(
        "classifier_precision", written(spark, sf_dir).relation,
        model_id="spam-classifier-v4", start_date="2024-01-01", end_date="2024-02-01",
    )


# -- ingestion -------------------------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"
BATCH_SOURCE = "nightly-batch"
JSON_KINDS = {
    "json_classifier": "classifier",
    "json_reports": "report",
    "json_enforcement": "enforcement",
    "json_model_outputs": "model_output",
}


def errors_text() -> Column:
    """Errors as ``field:type`` joined by ``|``."""
    shown = F.transform("errors", lambda e: F.concat(e["field"], F.lit(":"), e["type"]))
    return F.array_join(shown, "|").alias("errors")


def records(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return spread(Supplied(spark, sf_dir).raw(view))


def batches(spark: SparkSession, sf_dir: str) -> list[E.Batch]:
    return [
        E.load_batch(records(spark, sf_dir, view), kind, BATCH_SOURCE, at=AS_OF) for view, kind in JSON_KINDS.items()
    ]


@query
def validate_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(records(spark, sf_dir, "json_classifier"), "classifier")
    return checked.select("raw_id", errors_text(), "payload.*").drop("metadata")


@query
def validate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(records(spark, sf_dir, "json_reports"), "report")
    return checked.select("raw_id", errors_text(), "payload.*").drop("metadata")


@query
def validate_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(records(spark, sf_dir, "json_enforcement"), "enforcement")
    return checked.select("raw_id", errors_text(), "payload.*").drop("metadata")


@query
def validate_model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(records(spark, sf_dir, "json_model_outputs"), "model_output")
    labels = [F.try_element_at("payload.safety_labels", F.lit(name)).alias(name) for name in ("toxicity", "pii")]
    return checked.select("raw_id", errors_text(), "payload.*", *labels).drop("metadata", "safety_labels")


@query
def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.union_envelopes(batches(spark, sf_dir))
    return rows.groupBy(
        "signal_type", "source", "ingested_at", E.payload_matches_type(rows).alias("payload_matches")
    ).agg(F.count(F.lit(1)).alias("records"))


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = E.union_dead_letters(batches(spark, sf_dir)).withColumnRenamed("error_details", "errors")
    return dead.select(
        "raw_payload", "error_type", errors_text(), "source", F.size("errors").alias("problems"), "failed_at"
    )


@query
def dead_letter_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.problem_stats(E.union_dead_letters(batches(spark, sf_dir))).drop("source")


@query
def dead_letter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the dead letters as JSON lines, and the raw texts themselves for lines without an error type."""
    loaded = batches(spark, sf_dir)
    lines = E.union_dead_letters(loaded).select(F.to_json(F.struct("*")).alias("value"))
    for view in JSON_KINDS:
        lines = lines.unionByName(records(spark, sf_dir, view).select(F.col("raw").alias("value")))
    return E.dead_letter_stats(parse_dead_letter_lines(lines))


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the raw records that the contracts do not know, that have another type than usual, or that are left out."""
    return reduce(DataFrame.unionByName, (Q.field_drift(records(spark, sf_dir, view), kind) for view, kind in JSON_KINDS.items()))


@query
def ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds in one relation, split by type again and loaded each by its contract."""
    parts = [records(spark, sf_dir, view).select(F.lit(kind).alias("signal_type"), "raw") for view, kind in JSON_KINDS.items()]
    mixed = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    return E.ingest_summary(list(E.load_mixed(mixed, at=AS_OF).values()))


@query
def envelopes_of_wrong_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes whose type was exchanged for another one hold a payload that does not match."""
    rows = E.union_envelopes(batches(spark, sf_dir)).withColumn(
        "signal_type", F.when(F.col("signal_type") == "report", "enforcement").otherwise(F.col("signal_type")))
    return rows.groupBy("signal_type", E.payload_matches_type(rows).alias("payload_matches")).agg(
        F.count(F.lit(1)).alias("records"))


@query
def envelopes_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as JSON lines, written twice and read back."""
    path = shared_dir(spark, "envelopes")
    for _ in range(2):
        write_envelopes(E.load_batch(records(spark, sf_dir, "json_reports"), "report", at=AS_OF).valid, path)
    return spark.read.schema("signal_type STRING, source STRING, ingested_at TIMESTAMP_NTZ").json(path).groupBy(
        "signal_type", "source", "ingested_at").agg(F.count(F.lit(1)).alias("records"))


@query
def dead_letters_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of two days, written by day and read back as lines."""
    path = shared_dir(spark, "dead-letters")
    for view, at in (("json_reports", "2024-01-29 12:00:00"), ("json_enforcement", AS_OF)):
        write_dead_letters(E.load_batch(records(spark, sf_dir, view), JSON_KINDS[view], BATCH_SOURCE, at=at).dead, path)
    return read_dead_letters(spark, path).groupBy("error_type", "source", F.substring("failed_at", 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("records"))


@query
def dead_letters_of_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two loads, one a day and a half ago, the last 24 hours hold one."""
    loads = [E.load_batch(records(spark, sf_dir, view), JSON_KINDS[view], BATCH_SOURCE, at=at)
             for view, at in (("json_reports", "2024-01-29 12:00:00"), ("json_enforcement", AS_OF))]
    return K.dead_letters_24h(E.union_dead_letters(loads), AS_OF)


@query
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ingest_summary(batches(spark, sf_dir))


# -- incremental load ------------------------------------------------------------------------

CUT = "2024-01-20 00:00:00"


@query
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and actions in three loads of no particular order, merged into a written fact; equal to one full load."""
    root = shared_dir(spark, "incremental")
    _three_loads(spark, sf_dir, root)
    return spark.read.parquet(f"{root}/fact").drop("signal_day")


@query
def kept_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums kept over three loads, renewed for the days that each has written."""
    root = shared_dir(spark, "kept")
    _three_loads(spark, sf_dir, root, lambda days: P.refresh_daily(spark, f"{root}/fact", f"{root}/daily", days))
    return P.kept_precision(P.read_daily(spark, f"{root}/daily"))


def _three_loads(spark: SparkSession, sf_dir: str, root: str, after: Callable[[set], None] | None = None) -> None:
    w = warehouse(spark, sf_dir, multi="first")
    tables = {"signals": (w.stg_signals, "signal_id", "signal_timestamp", "signal_day"),
              "actions": (w.stg_enforcement, "action_id", "action_timestamp", "action_day")}
    for step in range(3):
        new = {}
        for name, (rows, key, time, day) in tables.items():
            path = f"{root}/{name}/load={step}"
            stage_by_day(rows.filter(F.crc32(F.col(key).cast("binary")) % 3 == step), time, day, path)
            new[name] = spark.read.parquet(path)
        signals, actions = (spark.read.parquet(f"{root}/{name}") for name in tables)
        days = load_changes(spark, f"{root}/fact", signals, actions, new["signals"], new["actions"], f"{root}/staging-{step}")
        if after is not None:
            after(days.written)


@query
def since_watermark_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged signals past the newest load before the cut, with a look-back of three hours."""
    staged = warehouse(spark, sf_dir).stg_signals
    loaded = staged.filter(F.col("_loaded_at") <= ntz(CUT))
    return since_watermark(staged, loaded, lookback_minutes=180).select("signal_id", "_loaded_at")


# -- runs ------------------------------------------------------------------------------------


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Supplied(spark, sf_dir).raw("runs")
    history = F.filter(F.split("history", ","), lambda s: s != "")
    return table.withColumn("strategy_history", history).drop("history")


def _history_text(column: str = "strategy_history") -> Column:
    return F.array_join(column, ",").alias("history")


@query
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs(spark, sf_dir).select("run_id", R.route_col(F.col("retrieval_strategy")).alias("node"))


@query
def should_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = R.should_retry_col(F.col("confidence_score"), F.col("retry_count"))
    return runs(spark, sf_dir).select("run_id", rule.alias("should_retry"))


@query
def next_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = R.next_strategy_col(F.col("strategy_history"))
    return runs(spark, sf_dir).select("run_id", rule.alias("next_strategy"))


@query
def after_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = R.after_scoring_col(F.col("confidence_score"), F.col("retry_count"), F.col("strategy_history"))
    return runs(spark, sf_dir).select("run_id", rule.alias("decision"))


@query
def apply_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.apply_retry(runs(spark, sf_dir)).select(
        "run_id", "retry_count", "confidence_score", F.size("retrieved_context").alias("context_size"),
        "synthesised_answer", "failure_reason", _history_text(),
    )


@query
def curate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.curate_runs(runs(spark, sf_dir)).select("run_id", "query", "confidence_score", "retry_count")


@query
def eval_set_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated runs of two runs of the job, one of them repeated."""
    path = shared_dir(spark, "eval-set")
    curated = R.curate_runs(runs(spark, sf_dir)).select("run_id", "query", "confidence_score", "retry_count")
    for run_id, part in (("first", "retry_count > 0"), ("second", "retry_count = 0"), ("second", "retry_count = 0")):
        write_eval_set(curated.filter(part).withColumnRenamed("run_id", "id"), path, run_id=run_id)
    return spark.read.parquet(path).drop("run_id").withColumnRenamed("id", "run_id")


@query
def initial_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = Supplied(spark, sf_dir).table("benchmark").select(F.col("item_id").alias("run_id"), "text")
    return R.initial_runs(asked, query="text").select(
        "run_id", "query", "signal_type", "retrieval_strategy", "confidence_score", "retry_count",
        F.size("retrieved_context").alias("context_size"), _history_text(),
    )


# -- dashboard -------------------------------------------------------------------------------


@query
def signals_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.signals_24h(warehouse(spark, sf_dir).signals_once, AS_OF)


@query
def dead_letters_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.dead_letters_24h(E.union_dead_letters(batches(spark, sf_dir)), AS_OF)


@query
def avg_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.avg_confidence(runs(spark, sf_dir)).select(F.round("avg_confidence", 6).alias("avg_confidence"))


@query
def retry_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.retry_rate(runs(spark, sf_dir))


@query
def signal_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.signal_volume(warehouse(spark, sf_dir).signals_once)


@query
def strategy_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.strategy_distribution(runs(spark, sf_dir))


@query
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.confidence_histogram(runs(spark, sf_dir))


@query
def retry_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.retry_trend(runs(spark, sf_dir))


@query
def latest_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.latest_loaded(warehouse(spark, sf_dir).signals_once)


@query
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.freshness(warehouse(spark, sf_dir).signals_once, AS_OF)


@query
def freshness_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.freshness_gauges(K.freshness(warehouse(spark, sf_dir).signals_once, AS_OF))


# -- quality ---------------------------------------------------------------------------------


def _marts(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, dict[str, DataFrame]]:
    """The marts over a written fact, which every check reads."""
    built = warehouse(spark, sf_dir)
    built.use_fact(materialize(built.fct_signals, "fct_signals"))
    names = ("fct_signals", "dim_entities", "dim_models", "dim_actions")
    return built, {name: getattr(built, name) for name in names}


def _suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    built, tables = _marts(spark, sf_dir)
    fresh = K.freshness(built.signals_once, AS_OF)
    return Q.signals_suite(tables, built.signals_once, fresh)


@query
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.column_checks(warehouse(spark, sf_dir).fct_signals_all, "fct_signals_all", Q.NOT_NULL["fct_signals"])


@query
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return Q.unique_check(w.fct_signals, "fct_signals", "signal_id").unionByName(
        Q.unique_check(w.dim_actions, "dim_actions", "action_id")
    )


@query
def quality_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.column_checks(
        warehouse(spark, sf_dir).fct_signals_all, "fct_signals_all",
        accepted={"signal_type": ["classifier", "report"], "severity": ["low", "high"], "was_enforced": [True, False]},
        ranges={"score": (0.0, 0.75)},
    )


@query
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, sf_dir)


@query
def quality_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.run_checkpoint(_suite(spark, sf_dir))


@query
def quality_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.alerts(_suite(spark, sf_dir), ntz(AS_OF))


@query
def row_count_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = Q.row_count_anomaly(warehouse(spark, sf_dir).signals_once, days=3, deviations=2.0)
    return judged.withColumns({name: F.round(name, 6) for name in ("expected", "deviation")})


# -- retrieval -------------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


@query
def cosine_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the one that follows it."""
    table = Supplied(spark, sf_dir).table("embeddings")
    following = table.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("_next"))
    return table.join(following, "vec_id").select(
        "vec_id", F.round(cosine_col(F.col("embedding"), F.col("_next")), 6).alias("cosine")
    )


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every vector as a query, over every vector."""
    docs = read_vectors(spark, f"{sf_dir}/embeddings.parquet")
    return docs.select(F.col("id").alias("query_id"), "embedding"), docs


@query
def similarity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, docs = _vectors(spark, sf_dir)
    return _rounded(similarity_search(queries, docs, carry=["label"]), "score")


@query
def similarity_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, docs = _vectors(spark, sf_dir)
    return _rounded(similarity_search(queries, docs, top_k=5, filters={"label": 1}), "score")


@query
def similarity_topk_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search with the query set treated as too large to travel."""
    queries, docs = _vectors(spark, sf_dir)
    return _rounded(similarity_search(queries, docs, query_bytes=0), "score")


@query
def mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, docs = _vectors(spark, sf_dir)
    return _rounded(mmr_rerank(similarity_search(queries, docs, carry=["embedding"])), "score", "mmr_score")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Supplied(spark, sf_dir).table("benchmark").select(F.col("item_id").alias("query_id"), "text")


def _embed(df: DataFrame, **names: str) -> DataFrame:
    return embed_documents(df, token_hash=md5_hash, **names)


@query
def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's vector, one row per slot that is not zero."""
    vectors = _embed(_documents(spark, sf_dir))
    slots = vectors.select("id", F.posexplode_outer("embedding").alias("slot", "value"))
    return slots.filter(F.col("value") != 0).select("id", "slot", F.round("value", 6).alias("value"))


@query
def vector_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = materialize(_embed(_documents(spark, sf_dir)), "document-vectors")
    found = vector_retrieve(_questions(spark, sf_dir), docs, embed=_embed)
    return _rounded(found, "score", "mmr_score")


@query
def keyword_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(keyword_search(_questions(spark, sf_dir), _documents(spark, sf_dir), carry=["lang"]), "score")


@query
def keyword_retrieval_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = keyword_search(_questions(spark, sf_dir), _documents(spark, sf_dir), top_k=3, filters={"lang": "en"})
    return _rounded(found, "score")


@query
def keyword_retrieval_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers from a written index, which holds no texts."""
    path = shared_dir(spark, "postings")
    write_postings(_documents(spark, sf_dir), path, carry=["lang"])
    return _rounded(search_postings(spark, path, _questions(spark, sf_dir), carry=["lang"]), "score")


# -- streaming -------------------------------------------------------------------------------
# Each job runs to the end of its input, into the shared folder, and the query reads its sink.


BATCHES = 3  # of streams whose newest rows come first


def _streamed(spark: SparkSession, sf_dir: str, batches: int = 1) -> tuple[Supplied, str]:
    """The supplied tables as streams, and a new folder for the job's sinks and checkpoint."""
    return Supplied(spark, sf_dir, stream=True, batches=batches), shared_dir(spark, "stream")


def _save(path: str):
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(S.batch_path(path, batch_id))


def _all_streamed(data: Supplied) -> DataFrame:
    """Every signal of every type once, as one stream."""
    labels = F.create_map(F.lit("toxicity"), "toxicity", F.lit("pii"), "pii")
    return stg.all_signals(
        stg.stg_signals(data.raw("raw_classifier_outputs")), stg.stg_reports(data.raw("raw_user_reports")),
        stg.stg_enforcement(data.raw("raw_enforcement_logs")),
        stg.stg_model_outputs(data.raw("raw_model_outputs").withColumn("safety_labels", labels)),
    )


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds, each by its own job."""
    data, root = _streamed(spark, sf_dir)
    counts = []
    for view, kind in JSON_KINDS.items():
        out = f"{root}/{kind}"
        S.ingest_stream(data.raw(view), kind, f"{out}/valid", f"{out}/dead", f"{out}/cp").awaitTermination()
        valid = spark.read.parquet(f"{out}/valid").select(F.lit("valid").alias("outcome"), F.lit("").alias("problem"))
        dead = spark.read.parquet(f"{out}/dead").select(F.explode("error_details").alias("e")).select(
            F.lit("dead").alias("outcome"), F.concat("e.field", F.lit(":"), "e.type").alias("problem")
        )
        counts.append(valid.union(dead).groupBy(F.lit(kind).alias("signal_type"), "outcome", "problem").agg(
            F.count(F.lit(1)).alias("records")))
    return reduce(DataFrame.unionByName, counts)


@query
def stream_enriched_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs of the stream join; unmatched rows wait for a later watermark."""
    data, root = _streamed(spark, sf_dir)
    joined = S.enrich_stream(
        stg.stg_signals(data.raw("raw_classifier_outputs")), stg.stg_enforcement(data.raw("raw_enforcement_logs"))
    )
    S.start(joined, f"{root}/cp", _save(f"{root}/out")).awaitTermination()
    pairs = spark.read.parquet(f"{root}/out").filter(F.col("action_id").isNotNull())
    return pairs.select("signal_id", "action_id", "signal_timestamp", "action_timestamp", "was_enforced")


@query
def stream_unique_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signal delivered twice, and kept once."""
    data, root = _streamed(spark, sf_dir)
    staged = stg.stg_signals(data.raw("raw_classifier_outputs"))
    unique = S.unique_signals(staged.union(staged))
    S.start(unique, f"{root}/cp", _save(f"{root}/out")).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("signal_id", "entity_id", "signal_timestamp")


@query
def stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, root = _streamed(spark, sf_dir)
    static = Supplied(spark, sf_dir)
    S.fact_stream(
        stg.stg_signals(data.raw("raw_classifier_outputs")),
        lambda: stg.stg_enforcement(static.raw("raw_enforcement_logs")),
        f"{root}/fact", f"{root}/staging", f"{root}/cp",
        arriving_actions=stg.stg_enforcement(data.raw("raw_enforcement_logs")),
        all_signals=lambda: stg.stg_signals(static.raw("raw_classifier_outputs")),
    ).awaitTermination()
    return spark.read.parquet(f"{root}/fact").drop("signal_day")


@query
def stream_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of every type by hour."""
    data, root = _streamed(spark, sf_dir)
    write = lambda batch, _: batch.write.mode("overwrite").parquet(f"{root}/out")
    S.start(S.volume_stream(_all_streamed(data)), f"{root}/cp", write, mode="complete").awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("entities")


@query
def stream_enriched_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval join over batches in reverse time order, unmatched signals included."""
    data, root = _streamed(spark, sf_dir, BATCHES)
    job = L.EnrichJob(
        stg.stg_signals(data.raw("raw_classifier_outputs")), stg.stg_enforcement(data.raw("raw_enforcement_logs")), root)
    job.start(f"{root}/cp").awaitTermination()
    return job.result(closed=True).select("signal_id", "action_id", "signal_timestamp", "action_timestamp", "was_enforced")


@query
def stream_unique_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signal delivered twice, in batches in reverse time order, and kept once."""
    data, root = _streamed(spark, sf_dir, BATCHES)
    staged = stg.stg_signals(data.raw("raw_classifier_outputs"))
    job = L.UniqueJob(staged.union(staged), root)
    job.start(f"{root}/cp").awaitTermination()
    return job.result().select("signal_id", "entity_id", "signal_timestamp")


@query
def stream_volume_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and distinct entities of every type by hour, over batches in reverse time order."""
    data, root = _streamed(spark, sf_dir, BATCHES)
    job = L.VolumeJob(_all_streamed(data), root)
    job.start(f"{root}/cp").awaitTermination()
    return job.result(closed=True)


@query
def stream_fact_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after several batches in reverse time order: later ones merge into what earlier ones wrote."""
    data, root = _streamed(spark, sf_dir, BATCHES)
    static = Supplied(spark, sf_dir)
    S.fact_stream(
        stg.stg_signals(data.raw("raw_classifier_outputs")),
        lambda: stg.stg_enforcement(static.raw("raw_enforcement_logs")),
        f"{root}/fact", f"{root}/staging", f"{root}/cp",
        arriving_actions=stg.stg_enforcement(data.raw("raw_enforcement_logs")),
        all_signals=lambda: stg.stg_signals(static.raw("raw_classifier_outputs")),
    ).awaitTermination()
    return spark.read.parquet(f"{root}/fact").drop("signal_day")


@query
def stream_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, root = _streamed(spark, sf_dir)
    S.freshness_stream(_all_streamed(data), lambda: AS_OF, f"{root}/out", f"{root}/cp").awaitTermination()
    rows = spark.read.parquet(f"{root}/out")
    newest = rows.select(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == newest).drop("batch_id")
