"""The fitted quality model against the same steps over whole matrices, and isotonic blocks against all ways to pool."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd

from sigmart.llm import calibration, quality_classifier as Q

SF_DIR = "/root/testdata/sf0.001"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_ridge_over_partitions_equals_one_solve(spark):
    docs, labels = spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = Q.fit(Q.with_statistics(docs.repartition(7), ["doc_id"]), labels)
    texts = docs.toPandas().merge(labels.toPandas()[["doc_id", "quality"]], on="doc_id")
    fitting = texts[[fold(i) not in (2, 3) for i in texts.doc_id]]
    rows = np.array([Q.statistics(text.encode()) for text in fitting.text])
    mean, deviation = rows.mean(axis=0), np.sqrt(np.maximum(rows.var(axis=0), 1e-8))
    assert np.allclose(model.mean, mean) and np.allclose(model.deviation, deviation)
    x = Q.fourier(rows, mean, deviation)
    penalty = np.eye(x.shape[1]) * Q.RIDGE * len(rows) / Q.FEATURES
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(x.T @ x + penalty, x.T @ fitting.quality.to_numpy(dtype=float))
    assert np.allclose(x @ model.weights, x @ weights, atol=1e-6)
    # Cosines of random projections approximate the kernel that they stand for.
    scaled = np.clip((rows - mean) / deviation, -6, 6)
    kernel = np.exp(-((scaled[:, None] - scaled[None]) ** 2).sum(axis=2) / (2 * rows.shape[1]))
    assert np.abs(x[:, :-1] @ x[:, :-1].T - kernel).mean() < 0.1


def test_accepted_scores_like_the_query(spark):
    docs, labels = spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = Q.quality_scores(docs, labels).toPandas()
    kept = set(Q.accepted(docs, labels, 0.7).toPandas().doc_id)
    assert kept == set(scores[scores.score >= 0.7].doc_id)


def test_isotonic_is_the_best_rising_fit(spark):
    random = np.random.RandomState(3)
    raw = np.round(random.uniform(size=400), 2)
    label = (random.uniform(size=400) < raw ** 2).astype(float)
    frame = spark.createDataFrame(pd.DataFrame({"raw": raw, "label": label, "weight": 1.0}))
    fitted = calibration.fit_isotonic(frame, bins=100)
    order = np.argsort(raw, kind="stable")
    # The largest of lower averages and the smallest of upper ones meet in the isotonic fit.
    places, starts = np.unique(np.floor(raw[order] * 100), return_index=True)
    ones, n = np.add.reduceat(label[order], starts), np.diff([*starts, 400])
    k = len(places)
    mean = lambda i, j: ones[i:j + 1].sum() / n[i:j + 1].sum()
    want = [max(min(mean(i, j) for j in range(p, k)) for i in range(p + 1)) for p in range(k)]
    blocks = sorted(set(np.round(want, 9)))
    assert len(fitted.values) == len(blocks)
    rate = label.mean()
    sizes = [sum(n[p] for p in range(k) if np.round(want[p], 9) == block) for block in blocks]
    assert np.allclose(fitted.values, [(block * size + rate) / (size + 1) for block, size in zip(blocks, sizes, strict=True)])
