"""The raw relations as views over the supplied tables.

The texts run unchanged in Spark and in the SQL engine used as the oracle, apart from three tokens:
``{ts}`` (the zone-free timestamp literal), ``{sha256}`` and ``{text_type}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sigmart.plans.supplied_json import JSON_VIEWS
from sigmart.session import prepare, shared_dir

TIME_COLUMN = {"events": "ts", "conversations": "conv_id"}  # what gives a table's rows their place in time

SPARK_TOKENS = {"ts": "TIMESTAMP_NTZ", "sha256": "sha2(text, 256)", "text_type": "STRING"}
ORACLE_TOKENS = {"ts": "TIMESTAMP", "sha256": "sha256(text)", "text_type": "VARCHAR"}

RAW_CLASSIFIER_OUTPUTS = """
SELECT concat('sig-', CAST(event_id AS {text_type})) AS signal_id,
  CASE event_id % 5 WHEN 0 THEN 'toxicity-v3' WHEN 1 THEN 'pii-detector-v1' WHEN 2 THEN 'prompt-injection-v2'
    WHEN 3 THEN 'spam-classifier-v4' ELSE 'hate-speech-v2' END AS model_id,
  concat('user-', CAST(user_id AS {text_type})) AS entity_id,
  CASE WHEN (event_id * 7919) % 10000 < 5000 THEN 'clean' WHEN event_id % 3 = 0 THEN 'toxicity'
    WHEN event_id % 3 = 1 THEN 'pii' ELSE 'prompt_injection' END AS label,
  CAST((event_id * 7919) % 10000 AS DOUBLE) / 10000 AS score, CAST(0.5 AS DOUBLE) AS threshold,
  (event_id * 7919) % 10000 >= 5000 AS is_positive, ts AS timestamp,
  ts + (event_id % 40) * INTERVAL '1' MINUTE AS _loaded_at, props AS metadata
FROM events WHERE event_type IN ('click', 'view', 'signup')
"""

RAW_USER_REPORTS = """
SELECT concat('rep-', CAST(event_id AS {text_type})) AS report_id,
  concat('user-', CAST(user_id % 25 AS {text_type})) AS reporter_id,
  concat('user-', CAST((user_id * 31 + event_id) % 40 AS {text_type})) AS reported_entity_id,
  CASE event_id % 7 WHEN 0 THEN 'spam' WHEN 1 THEN 'harassment' WHEN 2 THEN 'hate_speech' WHEN 3 THEN 'csam'
    WHEN 4 THEN 'self_harm' WHEN 5 THEN 'misinformation' ELSE 'other' END AS report_type,
  concat('  report ', CAST(event_id AS {text_type}), '  ') AS description,
  CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS severity,
  'pending' AS status,
  {ts} '2024-01-30 00:00:00' + (event_id % 1440) * INTERVAL '1' MINUTE AS timestamp,
  {ts} '2024-01-30 00:00:00' + (event_id % 1440 + event_id % 90) * INTERVAL '1' MINUTE AS _loaded_at,
  props AS metadata
FROM events WHERE event_type = 'purchase'
"""

RAW_ENFORCEMENT_LOGS = """
SELECT concat('act-', CAST(event_id AS {text_type})) AS action_id,
  concat('user-', CAST(user_id AS {text_type})) AS entity_id,
  CASE event_id % 6 WHEN 0 THEN 'warn' WHEN 1 THEN 'suspend' WHEN 2 THEN 'ban' WHEN 3 THEN 'content_removal'
    WHEN 4 THEN 'shadowban' ELSE 'escalate' END AS action_type,
  CASE event_id % 2 WHEN 0 THEN 'policy-tos-v3' ELSE 'policy-spam-v2' END AS policy_id,
  CASE event_id % 3 WHEN 0 THEN 'auto-enforcer-v2' ELSE 'trust-safety-team' END AS enforced_by,
  concat('reason ', CAST(event_id AS {text_type})) AS reason, ts AS timestamp,
  ts + (event_id % 60) * INTERVAL '1' MINUTE AS _loaded_at, props AS metadata
FROM events WHERE event_type = 'error'
"""

RAW_MODEL_OUTPUTS = """
SELECT concat('out-', CAST(conv_id AS {text_type}), '-', CAST(turn AS {text_type})) AS output_id,
  CASE conv_id % 2 WHEN 0 THEN 'model-a' ELSE 'model-b' END AS model_id,
  {sha256} AS prompt_hash, text AS output_text,
  CAST((conv_id * 7919 + turn) % 10000 AS DOUBLE) / 10000 AS toxicity,
  CAST((conv_id * 104729 + turn) % 10000 AS DOUBLE) / 10000 AS pii,
  50 + (conv_id * 13 + turn) % 451 AS latency_ms,
  {ts} '2024-01-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS timestamp,
  {ts} '2024-01-01 00:00:00' + (conv_id * 60 + turn + conv_id % 30) * INTERVAL '1' MINUTE AS _loaded_at,
  '{{}}' AS metadata
FROM conversations WHERE role = 'assistant'
"""

RUNS = """
SELECT concat('run-', CAST(conv_id AS {text_type}), '-', CAST(turn AS {text_type})) AS run_id,
  text AS query,
  CASE conv_id % 5 WHEN 0 THEN 'classifier' WHEN 1 THEN 'report' WHEN 2 THEN 'enforcement'
    WHEN 3 THEN 'model_output' ELSE NULL END AS signal_type,
  CASE (conv_id + turn) % 6 WHEN 0 THEN 'sql' WHEN 1 THEN 'vector' WHEN 2 THEN 'keyword' WHEN 3 THEN NULL
    WHEN 4 THEN '' ELSE 'graph' END AS retrieval_strategy,
  CASE WHEN (conv_id + turn) % 17 = 0 THEN NULL
    ELSE CAST((conv_id * 37 + turn) % 101 AS DOUBLE) / 100 END AS confidence_score,
  (conv_id + turn) % 3 AS retry_count,
  CASE conv_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'sql' WHEN 2 THEN 'sql,vector' WHEN 3 THEN 'sql,vector,keyword'
    WHEN 4 THEN 'keyword' ELSE 'vector,keyword' END AS history,
  {ts} '2024-01-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS started_at
FROM conversations WHERE role = 'user'
"""

RAW_VIEWS = {
    "raw_classifier_outputs": RAW_CLASSIFIER_OUTPUTS,
    "raw_user_reports": RAW_USER_REPORTS,
    "raw_enforcement_logs": RAW_ENFORCEMENT_LOGS,
    "raw_model_outputs": RAW_MODEL_OUTPUTS,
    "runs": RUNS,
    **JSON_VIEWS,
}


def spark_text(sql: str) -> str:
    return sql.format(**SPARK_TOKENS)


def oracle_text(sql: str) -> str:
    return sql.format(**ORACLE_TOKENS)


class Supplied:
    """Relations over one folder of supplied tables, read as batch or as streams. Everything is lazy.

    The tables are bounded and their files in no order of time, so a stream takes all files in one batch: between
    batches the watermark would move on and drop the older rows of later files. With ``batches``, a table is dealt by time
    first, and streamed in so many batches, the newest rows in the first one.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stream: bool = False, batches: int = 1) -> None:
        self.spark = prepare(spark)
        self.stream, self.batches = stream, batches
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            if self.stream and self.batches > 1:
                table = self._newest_first(name, table)
            elif self.stream:
                files = self.spark.readStream.schema(table.schema)
                path = f"{self.sf_dir}/{name}.parquet"
                if any(file.endswith(f"/{name}.parquet") for file in table.inputFiles()):  # a table of one file
                    table = files.option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)
                else:
                    table = files.parquet(path)
            self._tables[name] = table
        return self._tables[name]

    def _newest_first(self, name: str, table: DataFrame) -> DataFrame:
        column = F.col(TIME_COLUMN[name])
        at = F.unix_micros(column.cast("timestamp")) if name == "events" else column
        ends = table.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
        low, span = ends.low or 0, (ends.high or 0) - (ends.low or 0) + 1
        path = shared_dir(self.spark, name)
        for part in reversed(range(self.batches)):  # files are streamed in the order they were written
            begin, stop = low + span * part // self.batches, low + span * (part + 1) // self.batches
            inside = (at >= begin) & (at < stop)
            table.filter(inside if part else inside | column.isNull()).write.mode("append").parquet(path)
        files = len(self.spark.read.schema(table.schema).parquet(path).inputFiles())
        return self.spark.readStream.schema(table.schema).option(
            "maxFilesPerTrigger", max(1, -(-files // self.batches))).parquet(path)

    def view(self, text: str) -> DataFrame:
        """A view text over the supplied tables; the tables bind as DataFrames, not as global names."""
        sql = spark_text(text).replace("{", "{{").replace("}", "}}")
        sources = {}
        for name in ("events", "conversations"):
            if f"FROM {name}" in sql:
                sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
                sources[name] = self.table(name)
        return self.spark.sql(sql, **sources)

    def raw(self, name: str) -> DataFrame:
        return self.view(RAW_VIEWS[name])
