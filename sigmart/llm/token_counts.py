"""Token counts through a cache of content digests.

A text is known by the digest of its normalised content, a tokenizer by the digest of its file and library version. Texts
whose digest is in the cache for that tokenizer are not encoded; of the others every distinct content is encoded
once, and its count is appended to the cache. A cache is a folder on shared storage with one subfolder per tokenizer, so
several runs and several tokenizers use it side by side.

A tokenizer that drops white space and never looks across it counts a text as the sum over its words. For such a
tokenizer (``by_word``) a task encodes each distinct word once and remembers its count.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sigmart.llm.common import SPACE_CHARACTERS, prepare
from sigmart.session import shared_dir

CACHE = "digest binary, n_tokens long"


class TokenizerFile:
    """A tokenizer file's content, small enough for every task (checked), and how to count with it."""

    largest = 64 << 20

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.content = file.read()
        if len(self.content) > self.largest:
            raise ValueError(f"{path} is too large to be sent to every task")
        self.kind = "sentencepiece" if path.endswith(".model") else "tokenizers"
        version = __import__(self.kind).__version__
        self.digest = hashlib.sha256(f"{self.kind} {version} ".encode() + self.content).hexdigest()[:32]

    def counter(self):
        """A function from texts to token counts, without added special tokens, truncation or padding."""
        if self.kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return lambda texts: list(map(len, model.encode(texts, num_threads=1)))
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_buffer(self.content)
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(one.ids) for one in model.encode_batch_fast(texts, add_special_tokens=False)]


WORDS = 200_000  # word counts a task remembers; it starts anew beyond


def word_counter(count):
    """A function from texts to counts that encodes each distinct word once."""
    memo: dict[bytes, int] = {}

    def by_word(texts):
        split = [text.encode().split() for text in texts]  # bytes split at the six ASCII spaces alone
        if len(memo) > WORDS:
            memo.clear()
        fresh = list(set().union(*split) - memo.keys())
        memo.update(zip(fresh, count([word.decode() for word in fresh]), strict=True))
        return [sum(map(memo.__getitem__, found)) for found in split]

    return by_word


def normalised(text: Column, by_word: bool) -> Column:
    """Null as empty; with ``by_word``, white space at both ends cut, as it makes no token."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(text, F.lit(SPACE_CHARACTERS)) if by_word else text


def digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def encoded(contents: DataFrame, tokenizer: TokenizerFile, by_word: bool) -> DataFrame:
    """(digest, content) to (digest, n_tokens)."""
    shared = contents.sparkSession.sparkContext.broadcast((tokenizer.content, tokenizer.kind))

    def encode(batches):
        import pyarrow as pa

        one = TokenizerFile.__new__(TokenizerFile)
        one.content, one.kind = shared.value
        count = word_counter(one.counter()) if by_word else one.counter()
        for batch in batches:
            texts, counts = batch.column("content").to_pylist(), []
            at = 0
            while at < len(texts):  # a few megabytes of text are encoded at a time
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) < 2_000_000):
                    size += len(texts[stop])
                    stop += 1
                counts += count(texts[at:stop])
                at = stop
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, type=pa.int64())], ["digest", "n_tokens"])

    return contents.mapInArrow(encode, CACHE)


def read_cache(spark, cache: str, tokenizer: TokenizerFile) -> DataFrame:
    """The stored counts of one tokenizer; empty where there are none yet."""
    try:
        return spark.read.schema(CACHE).parquet(f"{cache}/tokenizer={tokenizer.digest}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], CACHE)


def token_counts(docs: DataFrame, tokenizer: TokenizerFile, cache: str | None = None, by_word: bool = False) -> DataFrame:
    """Columns of ``docs`` other than text, with n_bytes (UTF-8) and n_tokens of the whole text; one row per row.

    ``cache`` is a folder on shared storage; without one the run keeps a cache of its own in the checkpoint folder.
    A failed append leaves no part of it, and repeated digests in the cache count once. Null and empty texts have no
    bytes and no tokens; columns called digest, n_bytes or n_tokens are replaced.
    """
    spark = prepare(docs.sparkSession)
    cache = cache or shared_dir(spark, "token-cache")
    own = [F.col(f"`{name}`") for name in docs.columns
           if name.lower() not in ("text", "digest", "content", "n_bytes", "n_tokens")]
    content = docs.select(normalised(F.col("text"), by_word).alias("content")).select(digest(F.col("content")).alias("digest"), "content")
    # One row for each content and task survives the first step, so a much repeated text is not gathered anywhere.
    missing = content.join(read_cache(spark, cache, tokenizer), "digest", "left_anti").dropDuplicates(["digest"])
    encoded(missing, tokenizer, by_word).write.mode("append").parquet(f"{cache}/tokenizer={tokenizer.digest}")
    stored = read_cache(spark, cache, tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    known = docs.select(*own, F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                        digest(normalised(F.col("text"), by_word)).alias("digest"))
    return known.join(stored, "digest", "left").drop("digest")
