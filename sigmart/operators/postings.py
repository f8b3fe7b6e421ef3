"""An inverted index for keyword search: written once, searched many times without reading a text again.

Documents are dealt into blocks by a hash of their id. ``postings`` holds a row for each word and block, sorted by word in
folders by hash of the word: how many documents have the word there, the most that it can add to a score there, and, in
columns that are read only to score, the ids, lengths and counts. ``documents`` holds lengths and the columns that
results carry.

A search bounds every block's scores by what its query's words can add, scores the most promising blocks, and then only
those whose bound reaches the k-th best score found so far. What is left out cannot be among the best, so the
result is that of :func:`sigmart.operators.keyword.keyword_search`.

Texts are shuffled once, by block, to be counted; a word's rows once, to be written; and the rows a search needs once, by
block, where they are scored. No single posting and no (query, document) pair is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sigmart.functions.broadcasting import at_most
from sigmart.functions.text import tokens
from sigmart.operators.keyword import B, BROADCAST_TERMS, K1, TASK_PAIRS, query_terms
from sigmart.operators.similarity import rank_within
from sigmart.schemas import VECTOR_TOP_K

BLOCK_DOCUMENTS = 1024
BUCKET_POSTINGS = 5_000_000  # words of texts, at most so many postings, for each folder
TASK_WORDS = 1_000_000  # that a task counts, unless one block has more
BROADCAST_PAIRS = 2_000_000  # (query, block) pairs that may travel to the tasks
FIRST_BLOCKS = 2  # of a query that are scored to find out what its best scores are
SLACK = 1e-6  # bounds and scores are sums of floating-point numbers, and ranking rounds them


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _saturation(mean_length: Column | float, tf: Column, length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def _by_block(df: DataFrame, least: int, blocks: int) -> DataFrame:
    """Rows dealt by ``block``, evenly, to ``least`` tasks or more; ``slot`` is in every grouping that follows."""
    tasks = min(blocks, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), least))
    return df.withColumn("slot", F.pmod("block", F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("slot"))


def write_postings(
    docs: DataFrame, path: str, carry: list[str] | None = None, block_documents: int = BLOCK_DOCUMENTS,
    bucket_postings: int = BUCKET_POSTINGS,
) -> None:
    """Index documents (id, content and the columns that results carry). Reads each text once; ids are distinct.

    A null text has no words and a length of 0 where it is counted; see :func:`tokens` for what a word is.
    """
    spark = docs.sparkSession
    words = docs.select("id", *(carry or []), tokens(F.col("content")).alias("_words")).withColumn("length", F.size("_words"))
    words.select("id", "length", *(carry or [])).write.mode("overwrite").parquet(f"{path}/documents")
    documents = spark.read.parquet(f"{path}/documents")
    totals = documents.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("length").cast("double")).alias("mean_length"))
    blocks = max(1, math.ceil(documents.count() / block_documents))
    n, mean_length = totals.first()
    words_in_all = n * (mean_length or 0)
    texts = docs.select("id", "content", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    words = _by_block(texts, math.ceil(words_in_all / TASK_WORDS), blocks).select(
        "slot", "block", "id", tokens(F.col("content")).alias("_words")).withColumn("length", F.size("_words"))
    counts = words.select("slot", "block", "id", "length", F.explode_outer("_words").alias("term")).where("term IS NOT NULL").groupBy(
        "slot", "block", "id", "length", "term").agg(F.count(F.lit(1)).cast("int").alias("tf"))
    buckets = max(4, math.ceil(words_in_all / bucket_postings))
    placed = counts.groupBy("slot", "block", "term").agg(
        F.count(F.lit(1)).alias("documents"),
        F.max(_saturation(F.lit(mean_length), F.col("tf"), F.col("length"))).alias("most"),
        F.collect_list(F.struct("id", "length", "tf")).alias("p"),
    ).select("term", "block", "documents", "most", F.col("p.id").alias("ids"), F.col("p.length").alias("lengths"),
             F.col("p.tf").alias("tfs"), _bucket(F.col("term"), buckets).alias("bucket"))
    placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block").write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{path}/postings")
    totals.withColumns({"buckets": F.lit(buckets), "blocks": F.lit(blocks)}).write.mode("overwrite").parquet(f"{path}/totals")


def search_postings(
    spark: SparkSession, path: str, queries: DataFrame, top_k: int = VECTOR_TOP_K, carry: list[str] | None = None,
    text_col: str = "text", broadcast_terms: int = BROADCAST_TERMS, first_blocks: int = FIRST_BLOCKS,
) -> DataFrame:
    """(query_id, id, score, rank) of the best documents that share a term with the query, from an index."""
    totals = spark.read.parquet(f"{path}/totals").first()
    if not totals.n:
        totals_n, mean = 0, 1.0
    else:
        totals_n, mean = totals.n, totals.mean_length or 1.0
    terms = query_terms(queries, text_col)
    small = at_most(terms, broadcast_terms)
    bucket = _bucket(F.col("term"), totals.buckets)
    asked = sorted(row[0] for row in terms.select(bucket).distinct().collect())  # at most one number for each bucket
    vocabulary = terms.select("term").distinct()
    n_queries = terms.select("query_id").distinct().count()
    least_tasks = math.ceil(totals_n * n_queries / TASK_PAIRS)

    # One scan for each set of columns: what is read for bounds holds no ids. Without any word there is no file to tell them.
    kind = spark.read.parquet(f"{path}/documents").schema["id"].dataType.simpleString()
    postings = spark.read.schema(f"term string, block long, documents long, most double, ids array<{kind}>, lengths array<int>,"
                                 " tfs array<int>, bucket int").parquet(f"{path}/postings")
    held = postings.filter(F.col("bucket").isin(asked)).drop("bucket").join(
        F.broadcast(vocabulary) if small else vocabulary, "term", "left_semi")
    spread = held.groupBy("term").agg(F.sum("documents").alias("df"))
    idf = F.log(1 + (totals_n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = terms.join(spread, "term").select("query_id", "term", idf.alias("idf"))
    travelling = lambda df, fits: F.broadcast(df) if fits else df

    def by_block(*columns: str) -> DataFrame:
        """(query, word, block) rows, those of a block in one task."""
        dealt = _by_block(held.select("term", "block", *columns), least_tasks, totals.blocks) if small else held
        rows = dealt.join(travelling(weights, small), "term")
        return rows if small else _by_block(rows.select("query_id", "term", "idf", "block", *columns), least_tasks, totals.blocks)

    bounds = by_block("most").groupBy("slot", "query_id", "block").agg(F.sum(F.col("idf") * F.col("most")).alias("bound")).drop("slot")
    few_pairs = n_queries * totals.blocks <= BROADCAST_PAIRS

    def scored(chosen: DataFrame) -> DataFrame:
        """Exact scores of the documents of some (query, block) pairs."""
        found = by_block("ids", "lengths", "tfs").join(
            travelling(chosen.select("query_id", "block"), few_pairs), ["query_id", "block"], "left_semi")
        each = found.select("slot", "block", "query_id", "idf", F.explode(F.arrays_zip("ids", "lengths", "tfs")).alias("p"))
        return each.groupBy("slot", "block", "query_id", F.col("p.ids").alias("id"), F.col("p.lengths").alias("length")).agg(
            F.sum(F.col("idf") * _saturation(mean, F.col("p.tfs"), F.col("p.lengths"))).alias("score")).select("query_id", "id", "score")

    first = rank_within(bounds.withColumnRenamed("block", "id"), "bound", first_blocks).select(
        "query_id", F.col("id").alias("block"))
    best = rank_within(scored(first), "score", top_k)
    reached = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    rest = bounds.join(first, ["query_id", "block"], "left_anti").join(reached, "query_id", "left").where(
        (F.coalesce("n", F.lit(0)) < top_k) | (F.col("bound") + SLACK >= F.col("least")))
    both = best.drop("rank").unionByName(rank_within(scored(rest), "score", top_k).drop("rank"))
    result = rank_within(both, "score", top_k)
    if not carry:
        return result
    return spark.read.parquet(f"{path}/documents").select("id", *carry).join(result, "id").select(
        "query_id", "id", *carry, "score", "rank")
