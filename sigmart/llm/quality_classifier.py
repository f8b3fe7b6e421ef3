"""Quality scores of documents: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of a document are scaled by the training mean and deviation. Cosines of random projections approximate a
Gaussian kernel over them. Every partition sums its share of the normal equations, the sums are added in two levels, and
the driver solves one system whose size is the number of features. Training rows whose id hashes to the third of
the folds calibrate; the others fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigmart.llm.calibration import Isotonic, fit_isotonic
from sigmart.llm.common import broadcast_ids, held_out, materialize, sum_blobs

STATISTICS = ["words", "characters_per_word", "upper", "digits", "marks", "symbols", "stops", "distinct_words",
              "distinct_pairs", "echoes", "bare", "lines", "words_per_line", "distinct_lines", "non_ascii", "longest_word"]
FEATURES = 192
RIDGE = 1e-3
SEED = 20240117
NO_LABELS = 1.0  # the score of every document when there is no labelled row to learn from

_UPPER, _DIGITS = np.arange(65, 91), np.arange(48, 58)
_MARKS = np.frombuffer(b"!?*", dtype=np.uint8).astype(np.intp)
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]\\^~=+_@", dtype=np.uint8).astype(np.intp)
_STOPS = np.frombuffer(b".,;:", dtype=np.uint8).astype(np.intp)
_OTHER = np.arange(128, 256)


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; zeros for null and empty texts."""
    text = text or b""
    found = text.split()
    n = len(found)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = lambda places: float(counts[places].sum()) / size
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = list(map(len, found))
    return [
        float(np.log1p(n)), sum(lengths) / n, share(_UPPER), share(_DIGITS), share(_MARKS), share(_SYMBOLS),
        share(_STOPS), len(set(found)) / n ** 0.9, len(set(zip(found, found[1:]))) / n, sum(map(eq, found, found[1:])) / n,
        lengths.count(1) / n, float(np.log1p(len(lines))), float(np.log1p(n / max(1, len(lines)))),
        len(set(lines)) / max(1, len(lines)), share(_OTHER), float(np.log1p(max(lengths))),
    ]


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``features``, the statistics of the whole text."""
    taken = [F.col(f"`{name}`") for name in keep]
    plain = docs.select(*taken, F.col("text").cast("binary").alias("features"))
    schema = docs.select(*taken, F.lit(None).cast("array<double>").alias("features")).schema

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            rows = pa.array([statistics(text) for text in batch.column("features").to_pylist()], type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rows], batch.schema.names)

    return plain.mapInArrow(scan, schema)


class QualityModel:
    def __init__(self, mean, deviation, weights, isotonic: Isotonic | None) -> None:
        self.mean, self.deviation, self.weights, self.isotonic = mean, deviation, weights, isotonic

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Ridge scores, brought into [0, 1] by clipping at -0.5 and 1.5."""
        return np.clip((fourier(rows, self.mean, self.deviation) @ self.weights + 0.5) / 2.0, 0.0, 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), NO_LABELS)
        return self.raw(rows) if self.isotonic is None else self.isotonic(self.raw(rows))


def fourier(rows: np.ndarray, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES) -> np.ndarray:
    """Random Fourier features of scaled statistics, and a constant. The projections are a fixed function of the sizes."""
    random = np.random.RandomState(SEED)
    width = rows.shape[1]
    projection = random.normal(scale=1.0 / np.sqrt(width), size=(width, features))
    phase = random.uniform(0, 2 * np.pi, size=features)
    scaled = np.clip((rows - mean) / deviation, -6.0, 6.0)
    return np.hstack([np.sqrt(2.0 / features) * np.cos(scaled @ projection + phase), np.ones((len(rows), 1))])


def _matrix(batch) -> np.ndarray:
    return np.asarray(batch.column("features").flatten(), dtype=np.float64).reshape(-1, len(STATISTICS))


def with_raw(featured: DataFrame, model: QualityModel, column: str, raw: bool = False) -> DataFrame:
    """``featured`` with the score (or the raw ridge score) in ``column``, in place of ``features``."""
    schema = featured.drop("features").withColumn(column, F.lit(None).cast("double")).schema

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            values = model.raw(_matrix(batch)) if raw else model.score(_matrix(batch))
            columns = [batch.column(name) for name in batch.schema.names if name != "features"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, type=pa.float64())], schema.names)

    return featured.mapInArrow(scan, schema)


def fit(featured: DataFrame, labels: DataFrame, features: int = FEATURES) -> QualityModel:
    """A model from all labelled rows of ``featured`` (doc_id, features) that are not held out.

    ``labels``: doc_id, quality; rows with a null in either are ignored, a document labelled twice counts by its mean.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("label"))
    rows = materialize(featured.select(F.col("doc_id").cast("long").alias("doc_id"), "features").join(known, "doc_id"),
                       "labelled")
    calibrating = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3
    fitting = rows.where(~calibrating)
    width, size = len(STATISTICS), features + 1

    def moments(batches):
        import pyarrow as pa

        total = np.zeros(1 + 2 * width)
        for batch in batches:
            part = _matrix(batch)
            total += np.concatenate([[len(part)], part.sum(axis=0), (part ** 2).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], ["blob"])

    total = sum_blobs(fitting.mapInArrow(moments, "blob binary"), 1 + 2 * width)
    if not total[0]:
        return QualityModel(None, None, None, None)
    mean = total[1:1 + width] / total[0]
    deviation = np.sqrt(np.maximum(total[1 + width:] / total[0] - mean ** 2, 1e-8))

    def equations(batches):
        import pyarrow as pa

        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            part = fourier(_matrix(batch), mean, deviation, features)
            left += part.T @ part
            right += part.T @ np.asarray(batch.column("label"), dtype=np.float64)
        blob = np.concatenate([left.ravel(), right]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([blob], type=pa.binary())], ["blob"])

    summed = sum_blobs(fitting.mapInArrow(equations, "blob binary"), size * size + size)
    penalty = np.eye(size) * RIDGE * total[0] / features
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(summed[:size * size].reshape(size, size) + penalty, summed[size * size:])
    model = QualityModel(mean, deviation, weights, None)
    scored = lambda part: with_raw(part, model, "raw", raw=True).withColumn("weight", F.lit(1.0))
    model.isotonic = fit_isotonic(scored(rows.where(calibrating))) or fit_isotonic(scored(fitting))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out and score, one row per row of ``docs``.

    Null and empty texts are scored as texts without words. A null doc_id is never held out nor labelled. Without any
    labelled row every score is ``NO_LABELS``. Other columns are ignored.
    """
    featured = materialize(with_statistics(docs, ["doc_id"]), "features")
    model = fit(featured, labels)
    return with_raw(featured, model, "score").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def score_of(text: Column, model: QualityModel) -> Column:
    """The score of a text. Only the text travels to Python and only the score comes back."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([statistics(text) for text in texts.to_pylist()], dtype=np.float64)
            yield pa.array(model.score(rows.reshape(-1, len(STATISTICS))), type=pa.float64())

    return score(text.cast("binary"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold. Learns from labelled documents alone."""
    known = materialize(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct(), "known")
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(broadcast_ids(known), "doc_id", "left_semi")
    model = fit(with_statistics(labelled, ["doc_id"]), labels)
    return docs.where(score_of(F.col("text"), model) >= threshold)
