"""Toxicity by a weighted lexicon matched with Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digit substitutions to one letter, and puts one space
before every word. Entries are word beginnings and whole words, learned from labelled documents: those that toxic
documents hold far more often than clean ones suggest. Their matches, less those inside exception phrases, are taken per
hundred words; a logistic regression weighs them, and isotonic calibration turns the sum into a probability.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigmart.llm.calibration import Isotonic, fit_isotonic
from sigmart.llm.common import held_out, materialize, sum_blobs

SAMPLE = 10_000  # labelled documents of either class that are learned from, those with the smallest id hashes
LEXICON = 256  # entries at most, the surest first
SHORTEST, LONGEST = 4, 8  # letters of a word beginning
SUREST = 7.0  # deviations by which the toxic documents with an entry must exceed what clean documents suggest
LEAST_ODDS = 1.0  # log odds
LEAST_DOCUMENTS = 5
SMOOTHING = 20.0  # words added to every document's length
PENALTY, STEPS = 1.0, 12  # of the regression that weighs the entries
NO_LABELS = 0.0

# Look-alike letters and substitutions. l and i share a letter because 1 stands for both.
FOLDED = str.maketrans({
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a",
    "$": "s", "l": "i",
})
# Phrases in which an entry is meant kindly.
EXCEPTIONS = ("clown fish", "clownfish", "trash can", "trash bin", "trash bag", "circus clown", "idiot proof", "sore loser",
              "stupid simple", "not stupid", "scum line", "pond scum")
WORD = re.compile(r"[^\W_]+")


def folded(text: str | None) -> tuple[str, int]:
    """The folded text, a space before every word and at the end, and its number of words."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    found = WORD.findall(text.lower().translate(FOLDED))
    return " " + " ".join(found) + " ", len(found)


def candidates(text: str | None) -> set[str]:
    """The lexicon candidates of one text: word beginnings, and whole words closed by a space."""
    out: set[str] = set()
    for word in set(folded(text)[0].split()):
        out.update(word[:size] for size in range(SHORTEST, min(len(word), LONGEST) + 1))
        if len(word) < SHORTEST or len(word) > LONGEST:
            out.add(word[:64] + " ")
    return out


class ToxicityModel:
    """Entries, their weights and the calibration. Tasks build the matcher once each."""

    def __init__(self, entries: list[str], exceptions: tuple[str, ...]) -> None:
        self.entries, self.exceptions = entries, exceptions
        self.weights = np.zeros(len(entries) + 1)  # the last one is the constant
        self.isotonic: Isotonic | None = None

    def matcher(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for place, entry in enumerate(self.entries):
            machine.add_word(" " + entry, (len(entry) + 1, place))
        for phrase in self.exceptions:
            key = folded(phrase)[0].rstrip()
            if key and key not in machine:
                machine.add_word(key, (len(key), -1))
        machine.make_automaton()
        return machine

    def densities(self, machine, text: str | None) -> np.ndarray:
        """log1p of each entry's matches per hundred words, matches that begin inside an exception phrase left out."""
        body, count = folded(text)
        out = np.zeros(len(self.entries) + 1)
        hits: list[tuple[int, int]] = []
        calm: list[tuple[int, int]] = []
        for stop, (size, place) in machine.iter(body):
            if place < 0:
                calm.append((stop - size + 1, stop))
            else:
                hits.append((stop - size + 1, place))
        if calm and hits:
            calm.sort()
            starts = [start for start, _ in calm]
            reach = np.maximum.accumulate([stop for _, stop in calm])
            before = np.searchsorted(starts, [start for start, _ in hits], side="right") - 1
            hits = [hit for hit, at in zip(hits, before.tolist(), strict=True) if at < 0 or reach[at] < hit[0]]
        for _, place in hits:
            out[place] += 1.0
        out = np.log1p(100.0 * out / (count + SMOOTHING))
        out[-1] = 1.0
        return out

    def raw(self, machine, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.densities(machine, text) @ self.weights, -30.0, 30.0))))


def _scored(docs: DataFrame, model: ToxicityModel, column: str, calibrated: bool) -> DataFrame:
    """``docs`` without text, with the score in ``column``."""
    plain = docs.select(*(name for name in docs.columns if name != "text"), "text")
    schema = plain.drop("text").withColumn(column, F.lit(None).cast("double")).schema

    def scan(batches):
        import pyarrow as pa

        machine = model.matcher() if model.entries else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = np.full(len(texts), NO_LABELS)
            if machine is not None:
                values = np.array([model.raw(machine, text) for text in texts], dtype=np.float64)
            if calibrated and model.isotonic:
                values = model.isotonic(values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, type=pa.float64())], schema.names)

    return plain.mapInArrow(scan, schema)


def fit_weights(rows: DataFrame, model: ToxicityModel) -> None:
    """Ridge logistic regression of label on densities by Newton steps; tasks sum their share of each step."""
    size = len(model.entries) + 1

    def measure(batches):
        import pyarrow as pa

        machine = model.matcher()
        for batch in batches:
            values = [model.densities(machine, text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("weight"),
                                              pa.array(values, type=pa.list_(pa.float64()))], ["label", "weight", "x"])

    measured = materialize(rows.select("label", "weight", "text").mapInArrow(
        measure, "label double, weight double, x array<double>"), "densities")
    penalty = np.full(size, PENALTY)
    penalty[-1] = 1e-6
    for _ in range(STEPS):
        weights = model.weights.copy()

        def step(batches, weights=weights):
            import pyarrow as pa

            gradient, curvature = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                x = np.asarray(batch.column("x").flatten(), dtype=np.float64).reshape(-1, size)
                label, weight = (np.asarray(batch.column(name), dtype=np.float64) for name in ("label", "weight"))
                chance = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30.0, 30.0)))
                gradient += x.T @ (weight * (label - chance))
                curvature += (x * (weight * np.maximum(chance * (1 - chance), 1e-6))[:, None]).T @ x
            blob = np.concatenate([gradient, curvature.ravel()]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([blob], type=pa.binary())], ["blob"])

        summed = sum_blobs(measured.mapInArrow(step, "blob binary"), size + size * size)
        change = np.linalg.solve(summed[size:].reshape(size, size) + np.diag(penalty), summed[:size] - penalty * weights)
        model.weights = weights + np.clip(change, -3.0, 3.0)
        if np.abs(change).max() < 1e-3:
            break


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, label, weight, text of at most ``sample`` labelled documents of either class, none of them held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("double").alias("label"))
    totals = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label, total in sorted(totals.items()):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn(
            "weight", F.lit(total / min(total, sample)))
        chosen = part if chosen is None else chosen.unionAll(part)
    if chosen is None:
        chosen = known.withColumn("weight", F.lit(1.0))
    # At most two classes of ``sample`` narrow rows: a proven bound for the broadcast.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")


def learn(rows: DataFrame, exceptions: tuple[str, ...], lexicon: int = LEXICON) -> ToxicityModel:
    """A model from ``rows`` of :func:`labelled_sample`: one part of the ids gives entries and weights, one calibrates."""
    calibrating = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3

    def tally(batches):
        import pyarrow as pa

        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                counts[label >= 0.5].update(candidates(text))
            entries = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries, type=pa.string())]
                + [pa.array([count[entry] for entry in entries], type=pa.int64()) for count in counts],
                ["entry", "clean", "toxic"])

    fitting = rows.where(~calibrating)
    totals = fitting.agg(F.sum(F.when(F.col("label") >= 0.5, 1).otherwise(0)).alias("toxic"),
                         F.sum(F.when(F.col("label") >= 0.5, 0).otherwise(1)).alias("clean")).first()
    toxic, clean = totals.toxic or 0, totals.clean or 0
    entries: list[str] = []
    if toxic and clean:
        odds = F.log((F.col("toxic") + 0.5) / (toxic - F.col("toxic") + 0.5)) - F.log(
            (F.col("clean") + 0.5) / (clean - F.col("clean") + 0.5))
        usual = (F.col("clean") + 1) * (toxic / (clean + 2))  # toxic documents that had it if it meant nothing
        surest = fitting.select("text", "label").mapInArrow(tally, "entry string, clean long, toxic long").groupBy("entry").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCUMENTS).select(
            "entry", odds.alias("odds"), ((F.col("toxic") - usual) / F.sqrt(usual)).alias("sure")).where(
            (F.col("sure") > SUREST) & (F.col("odds") > LEAST_ODDS)).orderBy(
            F.desc("sure"), "entry").limit(8 * lexicon)
        for row in surest.collect():  # a bounded list, the surest first
            if len(entries) < lexicon and not any(row.entry.startswith(other) or other.startswith(row.entry) for other in entries):
                entries.append(row.entry)
    model = ToxicityModel(entries, exceptions)
    if not entries:
        return model
    fit_weights(fitting, model)
    scored = lambda part: _scored(part.select("doc_id", "label", "weight", "text"), model, "raw", False)
    model.isotonic = fit_isotonic(scored(rows.where(calibrating))) or fit_isotonic(scored(fitting))
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS,
                    sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out and score, one row per row of ``docs``.

    Null and empty texts have no matches. Null ids are never labelled. Without labelled rows of both classes every
    score is ``NO_LABELS``. Repeated rows score alike; other columns are ignored.
    """
    model = learn(materialize(labelled_sample(docs, labels, sample), "labelled"), exceptions)
    scored = _scored(docs.select("doc_id", "text"), model, "score", True)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
