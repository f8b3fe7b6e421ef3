"""Isotonic calibration of raw scores in [0, 1] from counts per bin, so its cost does not depend on the rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


class Isotonic:
    """Pool adjacent violators over bins, then a line between the centres of the blocks."""

    def __init__(self, centres: np.ndarray, values: np.ndarray) -> None:
        self.centres, self.values = centres, values

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.centres, self.values), 0.0, 1.0)


def fit_isotonic(rows: DataFrame, bins: int = BINS) -> Isotonic | None:
    """From rows (raw, label, weight); None without rows. The driver gets one row for each bin at most."""
    place = F.least(F.greatest(F.floor(F.col("raw") * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = rows.where("raw IS NOT NULL AND NOT isnan(raw)").groupBy(place.alias("bin")).agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("ones"),
        F.sum(F.col("weight") * F.col("raw")).alias("mass")).orderBy("bin").collect()
    if not counts:
        return None
    blocks: list[list[float]] = []  # weight, ones, weighted sum of raw scores
    for row in counts:
        blocks.append([row.n, row.ones, row.mass])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    # One pseudo row at the overall rate keeps small end blocks off 0 and 1.
    total = np.sum(blocks, axis=0)
    rate = total[1] / total[0]
    table = np.array(blocks)
    return Isotonic(table[:, 2] / table[:, 0], (table[:, 1] + rate) / (table[:, 0] + 1.0))
