"""Exact top-k cosine search of many queries over many documents.

A query set of bounded size travels to the documents: each task scores its documents against the query
matrix block by block and keeps k rows per query, so documents are neither shuffled nor paired, and only
(query, id, score) rows leave the task.

A query set beyond that bound is cut into blocks of bounded size and the documents into chunks. A task holds one
block, with the k best of each of its queries, and its chunk streams past: whatever the tables' sizes, its
memory is that of a block. A row is copied once for each chunk or block of the other side, whose number grows with the
rows over ``CHUNK_ROWS`` or ``BLOCK_QUERIES``. Scores of all pairs are looked at once, in tasks, and never written.

Within a task documents are placed among a few pivot documents, and by the triangle inequality on angles a query
passes over those cells that cannot hold one of its k nearest.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sigmart.functions.vectors import RANK_DECIMALS, unit_column, unit_rows
from sigmart.schemas import VECTOR_TOP_K

QUERY_BYTES = 8 << 20  # query matrix that may travel to the tasks
RESULT_ROW_BYTES = 64  # of a result row that travels
SCORE_CELLS = 1 << 20  # scores held at once in a task
PIVOTS = 64
CHUNK_ROWS = 200_000  # documents that stream past a block in one task
BLOCK_QUERIES = 50_000  # queries that a task holds
BLOCK_BYTES = 32 << 20  # of their vectors
RESULT_ROWS = 50_000  # rows that leave a task at once
ANGLE_SLACK = 1e-4  # covers rounding, and documents that tie with the k-th after rank rounding


def filter_metadata(docs: DataFrame, filters: dict[str, Any] | None) -> DataFrame:
    """Equality on every given metadata column, before any search."""
    for name, value in (filters or {}).items():
        docs = docs.filter(F.col(name).eqNullSafe(F.lit(value)))
    return docs


def rank_within(df: DataFrame, score: str, k: int, rank: str = "rank") -> DataFrame:
    """The k best rows per query by rounded score, ties by id. Each task first cuts to its own k best."""
    window = Window.partitionBy("query_id").orderBy(F.round(score, RANK_DECIMALS).desc(), F.col("id"))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def _result_schema(queries: DataFrame, docs: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", docs.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


class _Nearest:
    """The k best documents so far of each query of a block, in arrays that do not grow with the documents.

    Scores are first taken in single precision; what could be among the k best is scored again in double.
    """

    def __init__(self, matrix: np.ndarray, k: int):
        self.matrix, self.rough, self.k = matrix, matrix.astype(np.float32), k
        self.scores = np.zeros((len(matrix), k))
        self.ranked = np.full((len(matrix), k), -np.inf)  # best first; -inf where nothing is yet
        self.ids = self.pivots = None
        # four times the most that rounding to single precision moves a product of unit vectors
        self.slack = 4 * (matrix.shape[1] + 8) * 2.0**-24

    def meet(self, ids: np.ndarray, docs: np.ndarray) -> None:
        known = np.isfinite(docs).all(axis=1)
        ids, docs = ids[known], docs[known]
        if not len(docs) or not len(self.matrix):
            return
        directed = docs.any(axis=1)  # zero vectors have no direction, and score 0 with everything
        if self.ids is None:
            self.ids = np.empty(self.ranked.shape, dtype=ids.dtype)
        if self.pivots is None and directed.any():
            self.pivots = docs[directed][:: max(1, int(directed.sum()) // PIVOTS)][:PIVOTS]
            step = max(1, SCORE_CELLS // len(self.pivots))
            self.to_pivot = np.concatenate([  # the angle is exact, what is kept of it need not be
                _angles(self.matrix[i:i + step], self.pivots).astype(np.float32) for i in range(0, len(self.matrix), step)
            ])
            self.undirected = ~self.matrix.any(axis=1)
        everyone = np.arange(len(self.matrix))
        self._cell(everyone, ids[~directed], docs[~directed])
        ids, docs = ids[directed], docs[directed]
        if not len(docs):
            return
        angles = _angles(docs, self.pivots)
        cell = angles.argmin(axis=1)
        for number in np.unique(cell):
            inside = np.flatnonzero(cell == number)
            near, far = angles[inside, number].min(), angles[inside, number].max()
            lowest = np.maximum(self.to_pivot[:, number] - far, near - self.to_pivot[:, number]) - ANGLE_SLACK
            reached = np.cos(np.maximum(lowest, 0)) >= self.ranked[:, -1]
            self._cell(np.flatnonzero(reached | self.undirected), ids[inside], docs[inside])

    def _cell(self, queries: np.ndarray, ids: np.ndarray, docs: np.ndarray) -> None:
        wide = max(1, math.isqrt(SCORE_CELLS))
        for start in range(0, len(docs), wide):
            part = docs[start:start + wide]
            rough, k = part.astype(np.float32), self.k
            step = max(1, SCORE_CELLS // len(part))
            for first in range(0, len(queries), step):
                some = queries[first:first + step]
                scores = self.rough[some] @ rough.T
                edge = self.ranked[some, -1]
                if len(part) >= k and np.isneginf(edge).any():
                    edge = np.maximum(edge, np.partition(scores, len(part) - k, axis=1)[:, len(part) - k])
                rows, columns = np.nonzero(scores >= (edge - self.slack).astype(np.float32)[:, None])
                if len(rows):
                    self._take(some[rows], columns, ids[start:start + wide], part)

    def _take(self, rows: np.ndarray, columns: np.ndarray, ids: np.ndarray, docs: np.ndarray) -> None:
        step = max(1, SCORE_CELLS // docs.shape[1])
        scores = np.concatenate([
            np.einsum("ij,ij->i", self.matrix[rows[i:i + step]], docs[columns[i:i + step]]) for i in range(0, len(rows), step)
        ])
        ranked = np.round(scores, RANK_DECIMALS)
        good = ranked >= self.ranked[rows, -1]
        rows, scores, ranked, ids = rows[good], scores[good], ranked[good], ids[columns[good]]
        hit = np.unique(rows)
        before, places = np.nonzero(self.ranked[hit] > -np.inf)
        before = hit[before]
        rows = np.concatenate([before, rows])
        scores = np.concatenate([self.scores[before, places], scores])
        ranked = np.concatenate([self.ranked[before, places], ranked])
        ids = np.concatenate([self.ids[before, places], ids])
        order = np.lexsort((ids, -ranked, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        best = place < self.k
        at, order = (rows[best], place[best]), order[best]
        self.scores[at], self.ranked[at], self.ids[at] = scores[order], ranked[order], ids[order]

    def found(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of the query, id, score), some rows at a time."""
        rows, places = np.nonzero(self.ranked > -np.inf)
        for start in range(0, len(rows), RESULT_ROWS):
            at = rows[start:start + RESULT_ROWS], places[start:start + RESULT_ROWS]
            yield at[0], self.ids[at], self.scores[at]


def _angles(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(matrix @ pivots.T, -1.0, 1.0))


def similarity_search(
    queries: DataFrame,
    docs: DataFrame,
    top_k: int = VECTOR_TOP_K,
    filters: dict[str, Any] | None = None,
    carry: list[str] | None = None,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, id, score, rank) of the ``top_k`` nearest documents per query, with ``carry`` columns.

    ``queries`` has query_id and embedding; ``docs`` has id, embedding and any metadata or content columns.
    """
    docs = filter_metadata(docs, filters)
    asked = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    vectors = docs.select("id", "embedding").filter(F.col("embedding").isNotNull())

    one = asked.limit(1).collect()
    width = len(one[0]["embedding"]) if one else 1
    limit = query_bytes // (8 * width)
    fetched = asked.limit(limit + 1).collect() if limit else None
    travels = fetched is not None and len(fetched) <= limit
    if travels:
        found = _search_with_matrix(fetched, vectors, top_k, _result_schema(queries, docs))
    else:
        found = _search_by_block(asked, vectors, top_k, _result_schema(queries, docs), width)
    best = rank_within(found, "score", top_k)
    if not carry:
        return best
    # a bounded query set has at most top_k rows each; the result travels if that bound is small enough too
    small = F.broadcast(best) if travels and len(fetched) * top_k * RESULT_ROW_BYTES <= query_bytes else best
    return docs.select("id", *carry).join(small, "id").select("query_id", "id", *carry, "score", "rank")


def _search_with_matrix(fetched: list, vectors: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    query_ids = np.array([row["query_id"] for row in fetched])
    matrix = unit_rows([row["embedding"] for row in fetched])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nearest = _Nearest(matrix, k)
        for batch in batches:
            nearest.meet(batch["id"].to_numpy(), unit_rows(batch["embedding"]))
        for rows, ids, scores in nearest.found():
            yield pd.DataFrame({"query_id": query_ids[rows], "id": ids, "score": scores})

    if not fetched:
        return vectors.sparkSession.createDataFrame([], schema)
    return vectors.mapInPandas(run, schema)


def _search_by_block(asked: DataFrame, vectors: DataFrame, k: int, schema: T.StructType, width: int) -> DataFrame:
    n_asked, n_vectors = asked.count(), vectors.count()
    if not n_asked or not n_vectors:
        return vectors.sparkSession.createDataFrame([], schema)
    tasks = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    held = max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * max(1, width))))
    blocks = max(math.ceil(n_asked / held), math.isqrt(tasks - 1) + 1)
    chunks = max(math.ceil(n_vectors / CHUNK_ROWS), math.ceil(tasks / blocks))

    def dealt(df: DataFrame, name: str, other: str, own: int, others: int, pair: str, side: int) -> DataFrame:
        """Each row, in a part of its own side, for every part of the other."""
        return df.select(
            F.col(name), F.lit(None).cast(schema[other].dataType).alias(other), "embedding",
            F.pmod(F.xxhash64(name, "embedding"), F.lit(own)).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other"),
        ).select("query_id", "id", "embedding", F.expr(pair).cast("int").alias("pair"), F.lit(side).alias("side"))

    queries = dealt(asked, "query_id", "id", blocks, chunks, f"part * {chunks} + other", 0)
    documents = dealt(vectors, "id", "query_id", chunks, blocks, f"other * {chunks} + part", 1)
    # a block comes before the chunk that streams past it
    together = queries.unionByName(documents).repartitionById(blocks * chunks, F.col("pair")).sortWithinPartitions("pair", "side")

    def run(batches):
        import pyarrow as pa

        def result():
            for rows, ids, scores in nearest.found():
                yield pa.RecordBatch.from_arrays(
                    [query_ids.take(pa.array(rows)), pa.array(ids, type=batch.schema.field("id").type), pa.array(scores)],
                    ["query_id", "id", "score"])

        at, block, nearest = None, [], None
        for batch in batches:
            pairs, sides = (batch.column(name).to_numpy() for name in ("pair", "side"))
            cuts = np.flatnonzero((np.diff(pairs) != 0) | (np.diff(sides) != 0)) + 1
            for start, stop in itertools.pairwise([0, *cuts, len(pairs)]):
                part = batch.slice(start, stop - start)
                if pairs[start] != at:
                    if nearest is not None:
                        yield from result()
                    at, block, nearest = pairs[start], [], None
                vectors_ = unit_column(part.column("embedding")) if len(part) else None
                if sides[start] == 0:
                    block.append((part.column("query_id"), vectors_))
                elif block or nearest is not None:
                    if nearest is None:
                        query_ids = pa.concat_arrays([ids for ids, _ in block])
                        nearest, block = _Nearest(np.concatenate([matrix for _, matrix in block]), k), []
                    nearest.meet(part.column("id").to_numpy(zero_copy_only=False), vectors_)
        if nearest is not None:
            yield from result()

    return together.mapInArrow(run, schema)


def mmr_rerank(
    candidates: DataFrame, top_k: int = 5, lambda_mult: float = 0.5
) -> DataFrame:
    """Maximal marginal relevance over each query's candidates.

    ``candidates`` has query_id, id, score (relevance to the query) and embedding, as the search returns
    them: at most its ``top_k`` rows per query, which is what one group holds. Each step takes the
    candidate with the best ``lambda * relevance - (1 - lambda) * similarity to what is taken``.
    """
    source = candidates.select("query_id", "id", "score", "embedding")
    schema = T.StructType([
        source.schema["query_id"], source.schema["id"], T.StructField("score", T.DoubleType()),
        T.StructField("mmr_score", T.DoubleType()), T.StructField("mmr_rank", T.IntegerType()),
    ])
    # one row per query; in id order, so that the first of equal values is the lower id
    sets = (
        source.groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("id", "score", "embedding"))).alias("_c"))
        .select("query_id", "_c.id", "_c.score", "_c.embedding")
    )

    def pick(relevance: np.ndarray, vectors: np.ndarray, sizes: np.ndarray):
        """Place of the pick of each step, and its value, for queries that have ``sizes`` candidates each."""
        everyone = np.arange(len(sizes))
        closest = np.zeros(relevance.shape)
        out = np.arange(relevance.shape[1]) >= sizes[:, None]
        for step in range(min(top_k, relevance.shape[1])):
            value = lambda_mult * relevance - (1 - lambda_mult) * closest
            ranked = np.round(value, RANK_DECIMALS)
            ranked[out] = -np.inf
            best = ranked.argmax(axis=1)
            alike = np.einsum("nmw,nw->nm", vectors, vectors[everyone, best])
            closest = np.maximum(closest, alike) if step else alike
            out[everyone, best] = True
            yield best, value[everyone, best]

    def rerank(batches):
        import pyarrow as pa

        for batch in batches:
            sizes = batch.column("id").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            ids, scores = batch.column("id").flatten(), batch.column("score").flatten()
            embeddings = batch.column("embedding").flatten()
            relevance = scores.to_numpy(zero_copy_only=False).astype(np.float64)
            per_query = max(1, int(sizes.max(initial=1))) * max(1, len(embeddings[0]) if len(embeddings) else 1)
            step = max(1, SCORE_CELLS // per_query)
            for first in range(0, len(sizes), step):
                size, start = sizes[first:first + step], starts[first:first + step]
                low, high = start[0], start[-1] + size[-1]
                if low == high:
                    continue
                places = np.minimum(start[:, None] + np.arange(size.max()), high - 1) - low
                vectors = unit_column(embeddings.slice(low, high - low))[places]
                picks = list(pick(relevance[low:high][places], vectors, size))
                taken = np.minimum(size, len(picks))
                rows = np.repeat(np.arange(len(size)), taken)
                steps = np.arange(len(rows)) - np.repeat(np.cumsum(taken) - taken, taken)
                best, values = (np.stack(column, axis=1)[rows, steps] for column in zip(*picks, strict=True))
                at = pa.array(start[rows] + best)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(pa.array(first + rows)), ids.take(at), scores.take(at).cast("double"),
                     pa.array(values), pa.array(steps + 1, type=pa.int32())], schema.names)

    return sets.mapInArrow(rerank, schema)
