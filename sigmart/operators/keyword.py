"""Keyword search with BM25 ranking."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import DataFrame, functions as F

from sigmart.functions.broadcasting import at_most
from sigmart.functions.text import tokens
from sigmart.operators.similarity import filter_metadata, rank_within
from sigmart.schemas import VECTOR_TOP_K

# The usual BM25 parameters.
K1 = 1.2
B = 0.75
BROADCAST_TERMS = 500_000  # (query, term) rows that may travel to the tasks
TASK_PAIRS = 500_000  # (query, document) pairs that a task scores
MOST_TASKS = 100_000  # a task spills beyond


def query_terms(queries: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct terms of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))


def keyword_search(
    queries: DataFrame,
    docs: DataFrame,
    top_k: int = VECTOR_TOP_K,
    filters: dict[str, Any] | None = None,
    carry: list[str] | None = None,
    text_col: str = "text",
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(query_id, id, score, rank) of the best documents that share a term with the query.

    Texts are dealt by document once, so many to a task that it scores at most ``TASK_PAIRS`` pairs. Dropping the words
    no query asks for, counting, scoring and each task's own k best per query all happen on that one partitioning, and
    only those best rows are shuffled again. No (query, document) pair leaves the task that scored it.
    """
    docs = filter_metadata(docs, filters)
    texts = docs.select("id", "content")

    def words_of(texts: DataFrame) -> DataFrame:
        """``id`` and length of every document, and its words."""
        return texts.select("id", tokens(F.col("content")).alias("_tokens")).withColumn("_length", F.size("_tokens"))

    totals = words_of(texts).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_length").cast("double")).alias("mean_length"))
    terms = query_terms(queries, text_col)
    travels = at_most(terms, broadcast_terms)
    vocabulary = terms.select("term").distinct()
    pairs = docs.count() * terms.select("query_id").distinct().count()
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, math.ceil(pairs / TASK_PAIRS)))

    words = words_of(texts.repartition(tasks, "id") if travels else texts)
    # the plain explode would add a filter that splits every text a second time
    exploded = words.select("id", "_length", F.explode_outer("_tokens").alias("term"))
    asked = exploded.join(F.broadcast(vocabulary) if travels else vocabulary, "term", "left_semi")
    counts = (asked if travels else asked.repartition(tasks, "id")).groupBy("id", "_length", "term").agg(F.count(F.lit(1)).alias("_tf"))

    spread_of_term = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    n, mean_length = totals.select("n").scalar(), totals.select("mean_length").scalar()
    idf = F.log(1 + (n - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    weights = terms.join(spread_of_term, "term").select("query_id", "term", idf.alias("_idf"))
    saturation = F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_length") / mean_length))

    weighed = counts.join(F.broadcast(weights) if travels else weights, "term")
    scored = (
        (weighed if travels else weighed.repartition(tasks, "id"))
        .groupBy("id", "_length", "query_id")
        .agg(F.sum(F.col("_idf") * saturation).alias("score"))
        .select("query_id", "id", "score")
    )
    best = rank_within(scored, "score", top_k)
    if not carry:
        return best
    return docs.select("id", *carry).join(best, "id").select("query_id", "id", *carry, "score", "rank")
