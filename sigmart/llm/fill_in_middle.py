"""Fill-in-middle transformation of texts, cut at unit boundaries that a wavelet matrix locates.

A unit is a run of white space and the word after it; white space at the end of a text is a unit of its own. Every byte
of a text belongs to one of four classes: it closes a unit or not, and it begins a character or not. A wavelet matrix of
two levels stands over the classes of a whole batch of texts and answers how many bytes of a class lie before a place.
Boundaries before a place are the ranks of the two closing classes, characters those of the two beginning ones. The
cuts are found for all texts at once, by bisection on the ranks.

Which units the cuts fall on, and the form of the result, follow from a hash of the document id and a seed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80  # of documents that are transformed; of those, as spm
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT = "struct<n: bigint, prefix_chars: bigint, middle_chars: bigint, output: string>"

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


class Bits:
    """A bit vector with constant-time rank: running counts by word of 64 bits."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[:len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """The ones before each place."""
        word, rest = places >> 6, (places & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Ranks of symbols below ``2 ** levels``: a bit vector for each bit, from the highest, symbols sorted by the bits before."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.levels: list[tuple[Bits, int]] = []
        for shift in range(levels - 1, -1, -1):
            bits = (symbols >> shift) & 1 == 1
            self.levels.append((Bits(bits), len(bits) - int(np.count_nonzero(bits))))  # zeros go first
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        begin, stop = np.zeros_like(places), places
        for depth, (bits, zeros) in enumerate(self.levels):
            if symbol >> (len(self.levels) - 1 - depth) & 1:
                begin, stop = zeros + bits.rank(begin), zeros + bits.rank(stop)
            else:
                begin, stop = begin - bits.rank(begin), stop - bits.rank(stop)
        return stop - begin


class Units:
    """Counts and cuts of the units in a batch of texts, given as one run of bytes and the offsets of the texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.begins, self.stops = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        spaces = _SPACES[data]
        last = np.zeros(len(data), dtype=bool)  # last bytes of texts
        last[self.stops[self.stops > self.begins] - 1] = True
        closing = last.copy()
        closing[:-1] |= ~spaces[:-1] & spaces[1:]
        starting = (data & 0xC0) != 0x80
        self.matrix = WaveletMatrix(closing.astype(np.uint8) << 1 | starting, 2)

    def boundaries(self, places: np.ndarray) -> np.ndarray:
        return self.matrix.rank(2, places) + self.matrix.rank(3, places)

    def characters(self, places: np.ndarray) -> np.ndarray:
        return self.matrix.rank(1, places) + self.matrix.rank(3, places)

    def counts(self) -> np.ndarray:
        return self.boundaries(self.stops) - self.boundaries(self.begins)

    def cuts(self, units: np.ndarray) -> np.ndarray:
        """The smallest place in each text before which so many units are closed."""
        wanted = self.boundaries(self.begins) + units
        low, high = self.begins.copy(), self.stops.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.boundaries(middle) >= wanted
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned integers of 32 bits for a document: the first groups of a digest's hex text. A null id is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long") for place in range(4)]


def form_of(text: Column, draw: list[Column]) -> Column:
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    return F.when((text == "") | marked | (draw[2] % 100 >= PLAIN_PERCENT), "plain").when(
        draw[3] % 100 < SUFFIX_FIRST_PERCENT, "spm").otherwise("psm")


def cut_texts(text: Column, form: Column, first: Column, second: Column) -> Column:
    """n, lengths and output of each text (not null) from its form and two draws."""

    @F.arrow_udf(CUT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, forms, first, second in batches:
            texts = texts.cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
            units = Units(data, offsets - offsets[0])
            counts = units.counts()
            ends = [np.asarray(draw).astype(np.int64) % (counts + 1) for draw in (first, second)]
            cuts = [units.cuts(np.minimum(*ends)), units.cuts(np.maximum(*ends))]
            chars = [units.characters(places) for places in (units.begins, *cuts)]
            raw, output = data.tobytes(), []
            for form, begin, one, two, stop in zip(forms.to_pylist(), units.begins.tolist(), *(c.tolist() for c in cuts),
                                                   units.stops.tolist(), strict=True):
                prefix, middle, suffix = raw[begin:one], raw[one:two], raw[two:stop]
                if form == "plain":
                    output.append(raw[begin:stop])
                elif form == "psm":
                    output.append(b"<P>" + prefix + b"<S>" + suffix + b"<M>" + middle)
                else:
                    output.append(b"<S>" + suffix + b"<P>" + prefix + b"<M>" + middle)
            plain = np.array([form == "plain" for form in forms.to_pylist()], dtype=bool)
            lengths = [pa.array(chars[place + 1] - chars[place], type=pa.int64(), mask=plain) for place in range(2)]
            yield pa.StructArray.from_arrays(
                [pa.array(counts, type=pa.int64()), *lengths, pa.array(output, type=pa.binary()).cast(pa.string())],
                ["n", "prefix_chars", "middle_chars", "output"])

    return cut(text.cast("binary"), form, first, second)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Marks never stand in a transformed text, so its three parts are found exactly."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda place: F.get(parts, F.lit(place))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).otherwise(
        F.concat(part(2), part(3), part(1)))


def transformed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (null if plain) and output.

    A null text is an empty one, and empty texts are plain with no units. A null doc_id draws as the empty text; repeated
    rows are transformed alike. Columns of ``docs`` with one of these names are replaced.
    """
    fresh = ("n", "form", "prefix_chars", "middle_chars", "output")
    # Columns of the caller travel as one, so that no name clashes.
    plain = docs.select(F.struct(F.lit(0).alias("0"), *(F.col(f"`{name}`") for name in docs.columns if name.lower() not in fresh)).alias("row"),
                        F.coalesce("text", F.lit("")).alias("body"), *(draw.alias(f"h{place + 1}") for place, draw in enumerate(draws(F.col("doc_id"), seed))))
    formed = plain.withColumn("form", form_of(F.col("body"), [F.col(f"h{place}") for place in range(1, 5)]))
    cut = formed.select("row", "form", cut_texts(*map(F.col, ("body", "form", "h1", "h2"))).alias("cut"))
    return cut.select(*(F.col(f"row.`{name}`") for name in docs.columns if name.lower() not in fresh),
                      "cut.n", "form", "cut.prefix_chars", "cut.middle_chars", "cut.output")
