"""Text to vectors: signed feature hashing in built-in functions, or any batch function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sigmart.functions.text import tokens

DIMENSIONS = 64


def md5_hash(token: Column) -> Column:
    """32 bits of MD5; slower than the default, but computable by other engines."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def embed_documents(
    df: DataFrame,
    id_col: str = "id",
    text_col: str = "content",
    dimensions: int = DIMENSIONS,
    token_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(id, embedding): every token adds +1 or -1 to the slot its hash names; vectors have length 1.

    One row becomes one row and nothing is shuffled. A token's slot and sign are one small code, and the two codes of
    a slot are counted by how much shorter the codes get without them, which stays in generated code. A text
    without tokens becomes the zero vector.
    """
    def code(token: Column) -> Column:
        hashed = token_hash(token)
        sign = F.when(F.pmod(F.call_function("div", hashed, F.lit(dimensions)), F.lit(2)) == 0, 0).otherwise(dimensions)
        return (F.pmod(hashed, F.lit(dimensions)) + sign).cast("int")

    codes = df.select(F.col(id_col).alias("id"), F.transform(tokens(F.coalesce(text_col, F.lit(""))), code).alias("_codes"))
    slots = range(dimensions)
    counted = codes.selectExpr("id", *[
        f"CAST(size(array_remove(_codes, {i + dimensions})) - size(array_remove(_codes, {i})) AS DOUBLE) AS _{i}" for i in slots
    ]).selectExpr(
        "id",
        *[f"_{i}" for i in slots],
        # dividing a zero vector by 1 keeps it zero
        f"coalesce(nullif(sqrt({' + '.join(f'_{i} * _{i}' for i in slots)}), 0D), 1D) AS _length",
    )
    return counted.selectExpr("id", f"array({', '.join(f'_{i} / _length' for i in slots)}) AS embedding")


def embed_with(
    df: DataFrame,
    embed: Callable[[Sequence[str]], Sequence[Sequence[float]]],
    id_col: str = "id",
    text_col: str = "content",
) -> DataFrame:
    """(id, embedding) from a function over a batch of texts, such as a model loaded in the task."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    schema = T.StructType([source.schema["id"], T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = embed(batch["_text"].fillna("").tolist())
            yield pd.DataFrame({"id": batch["id"], "embedding": [list(v) for v in vectors]})

    return source.mapInPandas(run, schema)
