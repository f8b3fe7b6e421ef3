"""Search, reranking, keyword ranking and embedding against brute force."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigmart.functions.vectors import cosine_col
from sigmart.operators import keyword as K
from sigmart.operators import similarity as S
from sigmart.operators.embed import embed_documents, embed_with
from sigmart.operators.keyword import keyword_search
from sigmart.operators.postings import search_postings, write_postings
from sigmart.operators.retrieval import vector_retrieve


def cosine(a, b) -> float:
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return 0.0 if na == 0 or nb == 0 else sum(x * y for x, y in zip(a, b, strict=True)) / (na * nb)


def brute_topk(queries, docs, k):
    out = {}
    for q, v in queries:
        scored = sorted(((-round(cosine(v, w), 9), d) for d, w in docs))[:k]
        out[q] = [d for _, d in scored]
    return out


def clustered(seed: int, n: int, dims: int = 6):
    """Vectors of which a third are copies of one, with some zero vectors."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(size=dims)
    rows = []
    for i in range(n):
        v = hot if i % 3 == 0 else np.zeros(dims) if i % 29 == 1 else rng.normal(size=dims)
        rows.append((i, [float(x) for x in v]))
    return rows


def test_cosine_column(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 1.0], [-1.0, -1.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [row[0] for row in df.select(cosine_col(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1.0, 0.0, -1.0, 0.0])


@pytest.mark.parametrize("by_cell", [False, True])
@pytest.mark.parametrize("k", [1, 7, 40])
def test_search_against_brute_force(spark, monkeypatch, by_cell, k):
    monkeypatch.setattr(S, "CHUNK_ROWS", 16)
    monkeypatch.setattr(S, "BLOCK_QUERIES", 9)
    monkeypatch.setattr(S, "PIVOTS", 8)
    monkeypatch.setattr(S, "SCORE_CELLS", 200)
    rows = clustered(k, 120)
    docs = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    queries = docs.select((F.col("id") + 1000).alias("query_id"), "embedding").filter("id % 4 < 2")
    found = S.similarity_search(queries, docs, top_k=k, query_bytes=0 if by_cell else 1 << 20).collect()
    got: dict = {}
    for row in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(row.query_id, []).append(row.id)
    asked = [(i + 1000, v) for i, v in rows if i % 4 < 2]
    assert got == brute_topk(asked, rows, k)


@pytest.mark.parametrize("by_cell", [False, True])
def test_search_of_nothing(spark, by_cell):
    none = spark.createDataFrame([], "id long, embedding array<double>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    limit = 0 if by_cell else 1 << 20
    as_query = lambda df: df.withColumnRenamed("id", "query_id")
    assert S.similarity_search(as_query(none), some, query_bytes=limit).count() == 0
    assert S.similarity_search(as_query(some), none, query_bytes=limit).count() == 0


def test_filters_apply_before_ranking(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.9, 0.1], "b"), (3, [0.0, 1.0], "b")],
                                 "id long, embedding array<double>, tag string")
    query = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    found = S.similarity_search(query, docs, top_k=2, filters={"tag": "b"}, carry=["tag"]).collect()
    assert sorted((row.id, row.tag) for row in found) == [(2, "b"), (3, "b")]


def brute_mmr(query, candidates, k, weight):
    taken, left = [], dict(candidates)
    while left and len(taken) < k:
        def value(d):
            closest = max((cosine(left[d], v) for _, v in taken), default=0.0)
            return round(weight * cosine(query, left[d]) - (1 - weight) * closest, 9)
        best = min(left, key=lambda d: (-value(d), d))
        taken.append((best, left.pop(best)))
    return [d for d, _ in taken]


@pytest.mark.parametrize("weight", [0.0, 0.3, 0.5, 1.0])
def test_mmr_against_brute_force(spark, weight):
    rows = clustered(5, 12)
    query = [0.3, 1.0, -0.2, 0.5, 0.0, 0.1]
    candidates = [("q", i, cosine(query, v), v) for i, v in rows]
    df = spark.createDataFrame(candidates, "query_id string, id long, score double, embedding array<double>")
    got = sorted(S.mmr_rerank(df, 5, weight).collect(), key=lambda row: row.mmr_rank)
    assert [row.id for row in got] == brute_mmr(query, rows, 5, weight)


def test_keyword_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["spam", "ban", "user", "été", "the", "policy", "appeal", "x1"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 30))).title()) for i in range(60)] + [(60, None)]
    asked = [("q1", "the spam, the SPAM"), ("q2", "été appeal?"), ("q3", "nothing here"), ("q4", "")]
    words = {d: re.findall(r"\w+", (t or "").lower()) for d, t in docs}
    present = [d for d, t in docs if t is not None]
    mean = sum(len(words[d]) for d in present) / len(present)
    expected = {}
    for q, text in asked:
        scores = Counter()
        for term in set(re.findall(r"\w+", text.lower())):
            df = sum(term in words[d] for d in words)
            for d in words:
                tf = words[d].count(term)
                if tf:
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    scores[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[d]) / mean))
        best = sorted(scores.items(), key=lambda item: (-round(item[1], 9), item[0]))[:5]
        expected.update({(q, d): round(s, 6) for d, s in best})
    table = spark.createDataFrame(docs, "id long, content string")
    queries = spark.createDataFrame(asked, "query_id string, text string")
    for limit in (1000, 0):
        found = keyword_search(queries, table, top_k=5, broadcast_terms=limit).collect()
        assert {(row.query_id, row.id): round(row.score, 6) for row in found} == expected


def test_embedding_is_unit_length_and_stable(spark):
    df = spark.createDataFrame([(1, "Spam spam ham"), (2, ""), (3, "ham, SPAM spam!"), (4, None)], "id long, content string")
    vectors = {row.id: row.embedding for row in embed_documents(df).collect()}
    assert vectors[1] == vectors[3] and sum(x * x for x in vectors[1]) == pytest.approx(1.0)
    assert not any(vectors[2]) and not any(vectors[4]) and len(vectors[2]) == 64


def test_embed_with_a_batch_function(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id long, content string")
    got = embed_with(df, lambda texts: [[float(len(t)), 1.0] for t in texts]).collect()
    assert {row.id: row.embedding for row in got} == {1: [2.0, 1.0], 2: [0.0, 1.0]}


def test_vector_retrieve(spark):
    docs = spark.createDataFrame([(1, "ban appeal policy"), (2, "spam report volume"), (3, "weather")], "id long, content string")
    embedded = embed_documents(docs).join(docs, "id")
    questions = spark.createDataFrame([("q", "spam volume report")], "query_id string, text string")
    rows = vector_retrieve(questions, embedded, final_k=2).orderBy("mmr_rank").collect()
    assert rows[0].id == 2 and len(rows) == 2 and rows[0].source == "vector"


def test_postings_give_the_same_answers_and_skip_blocks(spark, tmp_path):
    """Some words stand in every document, some in few; blocks of 8 documents, so that bounds decide."""
    random = np.random.RandomState(7)
    words = [f"w{n}" for n in range(300)]
    share = 1.0 / np.arange(1, 301)
    share /= share.sum()
    rows = [(n, " ".join(random.choice(words, size=random.randint(0, 60), p=share))) for n in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (401, "w1 " * 200), (402, "w290 w291 w292")], "id long, content string")
    queries = spark.createDataFrame([(n, " ".join(random.choice(words, size=4))) for n in range(20)] + [
        (20, "w290 w291 w292"), (21, "nowhere"), (22, ""), (23, "w1 w1 w2")], "query_id long, text string")
    path = str(tmp_path / "index")
    write_postings(docs, path, block_documents=8)
    want = sorted(map(tuple, keyword_search(queries, docs, top_k=5).selectExpr("query_id", "id", "round(score, 7)", "rank").collect()))
    for limit, blocks in ((500_000, 2), (0, 1), (500_000, 1000)):
        found = search_postings(spark, path, queries, top_k=5, broadcast_terms=limit, first_blocks=blocks)
        assert sorted(map(tuple, found.selectExpr("query_id", "id", "round(score, 7)", "rank").collect())) == want
    assert "content" not in found._jdf.queryExecution().optimizedPlan().toString()


def peak_of_workers(spark, action) -> float:
    """MB by which the largest Python worker grew during an action."""

    def ask(kind):
        def run(batches):
            import os
            import time

            for batch in batches:
                if kind == "reset":
                    with open("/proc/self/clear_refs", "w") as f:
                        f.write("5")
                time.sleep(0.2)  # so that every worker gets a task
                status = dict(line.split(":", 1) for line in open("/proc/self/status"))
                kb = int(status["VmRSS" if kind == "reset" else "VmHWM"].split()[0])
                yield batch.assign(pid=os.getpid(), kb=kb)[["pid", "kb"]]
        rows = spark.range(0, 16, 1, 16).mapInPandas(run, "pid long, kb long").collect()
        return {row.pid: row.kb for row in rows}

    before = ask("reset")
    action()
    after = ask("read")
    return max(after[pid] - before.get(pid, min(before.values())) for pid in after) / 1024


def test_a_task_holds_one_block_of_queries(spark):
    """10,000 queries in one partition: no task may hold a copy of each for every cell of the documents."""
    rng = np.random.default_rng(4)
    rows = [(i, row) for i, row in enumerate(rng.normal(size=(10_000, 64)).tolist())]
    vectors = spark.createDataFrame(rows, "id long, embedding array<float>").coalesce(1)
    queries = vectors.withColumnRenamed("id", "query_id")
    docs = vectors.filter("id % 20 = 0")
    found = []
    grown = peak_of_workers(spark, lambda: found.append(S.similarity_search(queries, docs, top_k=3, query_bytes=0).count()))
    assert found == [30_000]
    assert grown < 250


@pytest.mark.parametrize("by_block", [False, True])
def test_search_with_odd_rows(spark, monkeypatch, by_block):
    """Ids beyond 2 ** 53, repeated queries, one vector in most rows, null vectors; documents fewer than k in a tile."""
    monkeypatch.setattr(S, "SCORE_CELLS", 64)
    monkeypatch.setattr(S, "BLOCK_QUERIES", 7)
    big = 2**60
    rows = [(big + i, v) for i, v in clustered(9, 90)]
    docs = spark.createDataFrame([*rows, (big + 500, None)], "id long, embedding array<float>").repartition(4)
    rows = [(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows]
    asked = docs.selectExpr(f"concat('q', id - {big}) AS query_id", "embedding").filter("query_id < 'q5'")
    found = S.similarity_search(asked.unionAll(asked.filter("query_id = 'q10'")), docs, top_k=6, query_bytes=0 if by_block else 1 << 20)
    want = brute_topk([(f"q{i - big}", v) for i, v in rows if f"q{i - big}" < "q5"], rows, 6)
    want["q10"] = sorted(want["q10"] * 2, key=want["q10"].index)[:6]
    got: dict = {}
    for row in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(row.query_id, []).append(row.id)
    assert got == want


def test_mmr_of_queries_with_unlike_candidate_counts(spark, monkeypatch):
    monkeypatch.setattr(S, "SCORE_CELLS", 200)  # several slices of a batch
    rows = clustered(8, 60)
    query = [0.3, 1.0, -0.2, 0.5, 0.0, 0.1]
    sets = {f"q{n}": rows[n:n + n % 9 + 1] for n in range(40)}
    candidates = [(q, i, cosine(query, v), v) for q, some in sets.items() for i, v in some]
    df = spark.createDataFrame(candidates, "query_id string, id long, score double, embedding array<double>")
    got: dict = {}
    for row in sorted(S.mmr_rerank(df, 5, 0.3).collect(), key=lambda r: r.mmr_rank):
        got.setdefault(row.query_id, []).append(row.id)
    assert got == {q: brute_mmr(query, some, 5, 0.3) for q, some in sets.items()}


@pytest.mark.parametrize("limit", [1000, 0])
def test_keyword_tasks_grow_in_number_not_in_size(spark, monkeypatch, limit):
    """400 documents and 10 queries are 4,000 pairs: 40 tasks of 100 pairs score them, whatever the session deals by."""
    monkeypatch.setattr(K, "TASK_PAIRS", 100, raising=False)
    docs = spark.createDataFrame([(n % 380, f"spam word{n % 7}" * (n % 5)) for n in range(400)], "id long, content string")
    queries = spark.createDataFrame([(n, f"spam word{n}") for n in range(10)], "query_id long, text string")
    found = keyword_search(queries, docs, top_k=5, broadcast_terms=limit)
    assert re.search(r"hashpartitioning\(id#\d+L?, 40\)", found._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(K, "TASK_PAIRS", 10**9, raising=False)
    other = keyword_search(queries, docs, top_k=5, broadcast_terms=limit)
    rows = [sorted(map(tuple, x.selectExpr("query_id", "id", "round(score, 6)", "rank").collect())) for x in (found, other)]
    assert rows[0] == rows[1] and rows[0]


def test_postings_are_written_once_and_pairs_are_not_shuffled(spark, tmp_path):
    """The index holds a row for each word and block, and a search shuffles such rows by block, not what it scores."""
    docs = spark.createDataFrame([(n, f"spam word{n % 3} word{n % 50}") for n in range(200)] + [(200, "")], "id long, content string")
    queries = spark.createDataFrame([(1, "spam word2"), (2, "word7")], "query_id long, text string")
    path = str(tmp_path / "index")
    write_postings(docs, path, block_documents=50)
    assert {name for name in os.listdir(path) if not name.startswith(".")} == {"documents", "postings", "totals"}
    written = spark.read.parquet(f"{path}/postings")
    assert written.count() == written.select("term", "block").distinct().count()
    for limit in (500_000, 0):
        found = search_postings(spark, path, queries, top_k=3, broadcast_terms=limit)
        assert found.count() == 6
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\([^)]*\bid#", plan)


def test_postings_of_texts_without_words(spark, tmp_path):
    queries = spark.createDataFrame([(1, "spam")], "query_id long, text string")
    for name, rows in (("none", []), ("empty", [(1, ""), (2, None)])):
        path = str(tmp_path / name)
        write_postings(spark.createDataFrame(rows, "id long, content string"), path)
        assert search_postings(spark, path, queries, carry=[]).count() == 0
