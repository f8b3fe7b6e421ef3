"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmart.session import materialize, prepare

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\f\r"
BROADCAST_BYTES = 32 << 20

__all__ = ["BROADCAST_BYTES", "SPACE", "HashedWords", "broadcast_ids", "document_columns", "held_out", "hashed_words", "list_array",
           "materialize", "mix64", "prepare", "sha256_hex", "sum_blobs", "table", "words"]


# What a Python worker holds at a time; whole texts travel in these batches.
ARROW_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Also bounds the batches between executors and their Python workers, for the session."""
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D; none for null."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARACTERS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document must not be learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col(f"`{name}`") for name in columns))


def broadcast_ids(ids: DataFrame, row_bytes: int = 16, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``ids`` (materialised) with a broadcast hint if its counted rows fit the limit, else as it is."""
    return F.broadcast(ids) if ids.count() * row_bytes <= limit else ids


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (multiply and shift, twice)."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(32))


class HashedWords(dict):
    """64-bit hash of a word, remembered; forgets everything at ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed_words(memo: HashedWords, found: Iterable[bytes], count: int) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, found), dtype=np.uint64, count=count)


def list_array(rows: list[np.ndarray | None], kind):
    """An Arrow list array from NumPy rows; None becomes null."""
    import pyarrow as pa

    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([0 if row is None else len(row) for row in rows], out=offsets[1:])
    values = pa.array(np.concatenate([row for row in rows if row is not None] or [np.zeros(0)]), type=kind)
    mask = pa.array([row is None for row in rows], type=pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def sha256_hex(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def sum_blobs(partials: DataFrame, length: int, groups: int = 16) -> np.ndarray:
    """The element-wise sum of float64 blobs in column ``blob``, added in two levels.

    Tasks add up what hashes to them, one blob in memory at a time; the driver adds at most ``groups`` blobs.
    """

    def add(batches):
        import pyarrow as pa

        total = np.zeros(length)
        for batch in batches:
            for blob in batch.column("blob"):
                total += np.frombuffer(blob.as_buffer(), dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], ["blob"])

    rows = partials.repartition(groups).mapInArrow(add, "blob binary").collect()
    return np.sum([np.frombuffer(row.blob, dtype=np.float64) for row in rows] or [np.zeros(length)], axis=0)
