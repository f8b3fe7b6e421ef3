"""Readers for raw records, dead letters, documents and vectors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sigmart.functions.text import strip
from sigmart.schemas import RAW_SCHEMAS, RAW_TABLES


def read_raw(spark: SparkSession, table: str, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """A raw table, or some of its files, under its fixed schema; nothing is inferred from the data."""
    kind = RAW_TABLES.get(table)
    if kind is None:
        raise ValueError(f"unknown raw table {table!r}; known: {', '.join(RAW_TABLES)}")
    return spark.read.schema(RAW_SCHEMAS[kind]).format(fmt).load(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text, for validation. Blank lines are skipped."""
    lines = spark.read.text(path).withColumnRenamed("value", "raw")
    return lines.filter(F.length(F.trim("raw")) > 0)


def parse_dead_letter_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Dead-letter lines with their error type. A line that is no JSON is kept and marked malformed."""
    kept = lines.select(strip(F.col(column)).alias("line")).filter(F.length("line") > 0)
    fields = "error_type STRING, source STRING, failed_at STRING, _corrupt STRING"
    document = F.from_json("line", fields, {"columnNameOfCorruptRecord": "_corrupt"})
    # JSON that is no object has no error type, but is not malformed
    no_object = F.col("_d").isNull() | F.col("_d._corrupt").isNotNull()
    malformed = F.when(no_object, F.try_parse_json("line").isNull()).otherwise(F.lit(False))
    return kept.withColumn("_d", document).select(
        "line", malformed.alias("malformed"), "_d.error_type", "_d.source", "_d.failed_at"
    )


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The stored dead letters; none where nothing was ever stored."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        lines = spark.createDataFrame([], "value string")
    return parse_dead_letter_lines(lines)


def spread(df: DataFrame) -> DataFrame:
    """A file scan over all cores where it yields fewer partitions than there are cores.

    For heavy per-row work on small or unsplittable files; a large table already has more splits than
    cores and is left as it is, without a shuffle. Only for scans: asking a plan with a shuffle for its
    partitions would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_documents(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
    metadata: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """Text documents as id, content and metadata columns."""
    table = spark.read.parquet(path)
    return spread(table.select(F.col(id_col).alias("id"), F.col(text_col).alias("content"), *metadata))


def read_vectors(
    spark: SparkSession, path: str, id_col: str = "vec_id", vector_col: str = "embedding",
    metadata: tuple[str, ...] = ("label",),
) -> DataFrame:
    """Vector documents as id, embedding and metadata columns."""
    table = spark.read.parquet(path)
    return table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"), *metadata)
