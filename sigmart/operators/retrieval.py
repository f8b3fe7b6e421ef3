"""Document retrieval for a table of questions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, functions as F

from sigmart.operators.embed import embed_documents
from sigmart.operators.similarity import mmr_rerank, similarity_search
from sigmart.schemas import MMR_LAMBDA, VECTOR_FINAL_K, VECTOR_TOP_K


def vector_retrieve(
    questions: DataFrame,
    docs: DataFrame,
    embed: Callable[..., DataFrame] = embed_documents,
    top_k: int = VECTOR_TOP_K,
    final_k: int = VECTOR_FINAL_K,
    lambda_mult: float = MMR_LAMBDA,
    filters: dict[str, Any] | None = None,
) -> DataFrame:
    """Embed the questions, search, and rerank once. ``docs`` carries its embeddings.

    ``questions`` has query_id and text.
    """
    asked = embed(questions, id_col="query_id", text_col="text").withColumnRenamed("id", "query_id")
    candidates = similarity_search(asked, docs, top_k, filters, carry=["embedding"])
    return mmr_rerank(candidates, final_k, lambda_mult).withColumn("source", F.lit("vector"))
