"""The ingestion run: raw records in, envelopes, dead letters and raw-table rows out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from sigmart.operators.envelope import Batch, ingest_summary, load_batch, now_utc
from sigmart.schemas import RAW_TABLES, SIGNAL_TYPES
from sigmart.session import prepare
from sigmart.sources.readers import read_records
from sigmart.sources.writers import write_dead_letters, write_envelopes

TABLE_OF = {kind: table for table, kind in RAW_TABLES.items()}


def ingest(
    spark: SparkSession, paths: dict[str, str], out: str, source: str | None = None, load_id: str | None = None
) -> DataFrame:
    """Load JSON-lines files by signal type and return the summary, valid, failed and total per type.

    Under ``out``: ``envelopes/<type>`` holds this load alone; ``raw/<table>`` and ``dead_letters`` gain a folder
    named by ``load_id``, new by default. Repeating a failed load under its id replaces what it had written.
    Records are checked once and kept on executor disks for the three writes; a lost executor's part is
    checked again. Generated ids are drawn once, when the envelopes are written, and the raw tables read
    those envelopes back.
    """
    unknown = set(paths) - set(SIGNAL_TYPES)
    if unknown:
        raise ValueError(f"unknown signal types: {', '.join(sorted(unknown))}")
    prepare(spark)
    load = f"load_id={load_id or uuid.uuid4().hex}"
    done: list[Batch] = []
    for kind, path in paths.items():
        batch = load_batch(read_records(spark, path), kind, source)
        batch.checked.persist(StorageLevel.DISK_ONLY)
        write_envelopes(batch.valid, f"{out}/envelopes/{kind}")
        write_dead_letters(batch.dead, f"{out}/dead_letters/{load}/signal_type={kind}", mode="overwrite")
        written = spark.read.schema(batch.valid.schema).json(f"{out}/envelopes/{kind}")
        table = written.select(f"{kind}.*").withColumn("_loaded_at", now_utc())
        table.write.mode("overwrite").parquet(f"{out}/raw/{TABLE_OF[kind]}/{load}")
        done.append(batch)
    # five rows
    rows = ingest_summary(done).collect()
    summary = spark.createDataFrame(rows, "signal_type string, valid long, failed long, total long")
    for batch in done:
        batch.checked.unpersist()
    return summary
