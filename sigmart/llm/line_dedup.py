"""Removal of repeated line chunks, cut where the content says so.

A text's lines are hashed, and a hash rolls over every two neighbouring line hashes. A chunk ends where the rolling hash
is smaller than its neighbours on both sides. That depends on four lines alone, so a passage that is shifted, or stands
in another document, is cut alike inside; and no two ends are adjacent, so chunks have two lines or more (save at the
ends of a text) and three on average. Chunks of two lines or more are compared across the whole corpus: first by hash,
then, where a hash occurs again, byte by byte. Of equal chunks the first one in the document with the smallest id stays,
the others are removed.

Ends near the edge of a passage depend on foreign lines, so chunks miss short passages and the edges of long ones. Every
run of whole lines of more than ``PASSAGE_WORDS`` words that stands twice is found exactly, one line included: each line
opens the shortest window of more words that begins with it, and closes the shortest one that ends with it. Windows
depend on their own lines alone, and those inside a passage cover it. Windows are compared by hash, then by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import BROADCAST_BYTES, SPACE, broadcast_ids, materialize

PASSAGE_WORDS = 50  # passages of more words are removed wherever they stand
DOCUMENT = ["doc_id", "version"]  # places in a text belong to the text, not to whatever else has its id


def version_of(text: Column) -> Column:
    return F.xxhash64(text)


def chunked(docs: DataFrame) -> DataFrame:
    """``docs`` with lines (array) and chunks (array of start, stop: first and last line, counted from 0).

    Only chunks of two lines or more, one of them with a word, are listed, each chunk text once: the first.
    """
    last = F.size("lines") - 1
    places = F.sequence(F.lit(0), last)
    at = lambda array, i: F.get(F.col(array), i)
    current = docs.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    current = current.withColumn("hashes", F.transform("lines", lambda line: F.xxhash64(line)))
    current = current.withColumn("rolled", F.transform(places, lambda i: F.xxhash64(at("hashes", i - 1), at("hashes", i))))
    low = lambda i: (at("rolled", i) < at("rolled", i - 1)) & (at("rolled", i) <= at("rolled", i + 1))
    current = current.withColumn("ends", F.filter(places, lambda i: (i == last) | low(i)))
    pieces = F.transform("ends", lambda end, k: F.struct(
        F.when(k > 0, F.get(F.col("ends"), k - 1) + 1).otherwise(F.lit(0)).alias("start"), end.alias("stop")))
    current = current.withColumn("chunks", F.filter(pieces, lambda piece: piece["stop"] > piece["start"]))
    return current.drop("hashes", "rolled", "ends")


def _text_of(lines: str, start, stop):
    return F.array_join(F.slice(F.col(lines), start + 1, stop - start + 1), "\n")


def windows(docs: DataFrame, digests: bool) -> DataFrame:
    """DOCUMENT, start, stop and hash (and digest) of the shortest windows of more than ``PASSAGE_WORDS`` words.

    Lines without words neither open nor close a window, but count for its content.
    """
    steps = [1 << power for power in range(PASSAGE_WORDS.bit_length())]
    current = docs.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    current = current.withColumn("weights", F.transform("lines", lambda line: F.size(F.array_remove(F.split(line, SPACE), ""))))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    current = current.withColumn("full", F.filter(places, lambda i: F.get("weights", i) > 0))
    # sums1, sums2, sums4 ...: words of so many lines from each on; null where the text ends before.
    current = current.withColumn("sums1", F.transform("full", lambda i: F.get("weights", i)))
    for step in steps[:-1]:
        double = lambda n, k: n + F.get(f"sums{step}", k + step)  # noqa: B023, E731
        current = current.withColumn(f"sums{2 * step}", F.transform(f"sums{step}", double))
    current = current.withColumn("levels", F.array(*(
        F.struct(F.lit(step).alias("step"), F.col(f"sums{step}").alias("sums")) for step in reversed(steps))))
    current = current.withColumn("hashes", F.transform("lines", lambda line: F.xxhash64(line)))

    def fitting(place):
        """The largest number of lines whose words are not above the limit; ``place(lines so far, step)``: the next ones."""
        def take(seen, level):
            more = seen["words"] + F.get(level["sums"], place(seen["n"], level["step"]))
            return F.when(more <= PASSAGE_WORDS, F.struct((seen["n"] + level["step"]).alias("n"), more.alias("words"))).otherwise(seen)

        return F.aggregate("levels", F.struct(F.lit(0).alias("n"), F.lit(0).alias("words")), take, lambda seen: seen["n"])

    current = current.withColumn("closes", F.transform("full", lambda i, k: k + fitting(lambda n, step: k + n)))
    current = current.withColumn("opens", F.transform("full", lambda i, k: k - fitting(lambda n, step: k - n - step + 1)))
    span = lambda start, stop: F.struct(start.alias("start"), stop.alias("stop"))
    forward = F.filter(F.transform("closes", lambda stop, k: span(k, stop)), lambda x: x["stop"] < F.size("full"))
    backward = F.filter(F.transform("opens", lambda start, k: span(start, k)),
                        lambda x: (x["start"] >= 0) & (F.get("closes", x["start"]) != x["stop"]))
    current = current.withColumn("spans", F.transform(F.concat(forward, backward), lambda x: span(
        F.get("full", x["start"]), F.get("full", x["stop"]))))
    cut = lambda array, x: F.slice(F.col(array), x["start"] + 1, x["stop"] - x["start"] + 1)
    digest = lambda x: [F.unhex(F.sha2(F.array_join(cut("lines", x), "\n"), 256)).alias("digest")] if digests else []
    found = F.transform("spans", lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), F.xxhash64(cut("hashes", x)).alias("hash"), *digest(x)))
    return current.select(*DOCUMENT, F.explode_outer(found).alias("w")).where("w IS NOT NULL").select(*DOCUMENT, "w.*")


def passages(docs: DataFrame) -> DataFrame:
    """DOCUMENT and chunk (start, stop) of every window that stands earlier, by document and place. May overlap."""
    again = materialize(windows(docs, False).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "window-hashes")
    suspects = materialize(windows(docs, True).join(broadcast_ids(again), "hash", "left_semi"), "windows")
    # Written first, so that a digest with many windows can be split when they are joined with it.
    known = materialize(suspects.groupBy("digest").agg(F.min(F.struct(*DOCUMENT, "start", "stop")).alias("first")), "first-windows")
    # A window that overlaps the first one of its kind in the same text is part of that occurrence.
    later = suspects.join(known, "digest").where(
        "doc_id != first.doc_id OR version != first.version OR start > first.stop")
    return later.select(*DOCUMENT, F.struct("start", "stop").alias("chunk"))


def repeated(docs: DataFrame) -> DataFrame:
    """(DOCUMENT, what to remove): arrays of (start, stop), for documents that have any. Materialised."""
    docs = docs.select("doc_id", "text", version_of(F.col("text")).alias("version"))
    # The outer form, because the optimiser would check the inner one's array beforehand and cut every text many times.
    pieces = chunked(docs).select(*DOCUMENT, "lines", F.explode_outer("chunks").alias("chunk")).where(
        "chunk IS NOT NULL").select(
        *DOCUMENT, "chunk", _text_of("lines", F.col("chunk.start"), F.col("chunk.stop")).alias("content")).where(
        F.col("content").rlike(r"[^\x20\x09-\x0D]")).withColumn("hash", F.xxhash64("content"))
    # Hashes first: most chunks occur once, and their text never leaves the scan.
    again = materialize(pieces.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hashes")
    suspects = materialize(pieces.join(broadcast_ids(again), "hash", "left_semi"), "suspects")
    # Bytes: the text itself is part of the key, so chunks that only share a hash stay apart.
    known = materialize(suspects.groupBy("hash", "content").agg(F.min(F.struct(*DOCUMENT)).alias("owner")), "owners")
    own = F.struct(*DOCUMENT) == F.col("owner")
    marked = suspects.join(known, ["hash", "content"]).select(
        *DOCUMENT, "chunk", "hash", own.alias("own"), F.xxhash64("content", F.lit(1)).alias("second"))
    # Within the owner the first of equal chunks stays; a chunk's place in its own document bounds this group.
    first = marked.where("own").groupBy(*DOCUMENT, "hash", "second").agg(F.min("chunk").alias("chunk")).select(
        *DOCUMENT, "chunk", F.lit(True).alias("stays"))
    removed = marked.select(*DOCUMENT, "chunk", "own").join(first, [*DOCUMENT, "chunk"], "left").where("stays IS NULL")
    removed = removed.select(*DOCUMENT, "chunk").unionByName(passages(docs))
    return materialize(removed.groupBy(*DOCUMENT).agg(F.collect_set("chunk").alias("removed")), "removed")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with text free of repeated chunks and passages, and n_lines, n_removed_lines, removed (their places).

    Null texts stay null, and a text may become empty. Rows with a null doc_id keep their text whole and are nobody's
    first. Rows that repeat a doc_id and its text count as one document and are cut alike; those that repeat the id alone are
    documents of their own, in the order of a hash of the text. An n_chars column is counted anew; columns called
    n_lines, n_removed_lines or removed are replaced.
    """
    keep = [name for name in docs.columns if name.lower() not in ("n_lines", "n_removed_lines", "removed")]
    # Columns of the caller travel as one, so that no name clashes.
    others = [F.col(f"`{name}`") for name in keep if name.lower() not in ("doc_id", "text")]
    plain = docs.select(F.struct(F.lit(0).alias("0"), *others).alias("row"), "doc_id", "text", version_of(F.col("text")).alias("version"))
    cuts = repeated(docs.select("doc_id", "text").where("doc_id IS NOT NULL"))
    size = cuts.agg(F.count("*").alias("rows"), F.sum(F.size("removed")).alias("chunks")).first()
    # Small lists go to the texts; large ones meet them by id, which moves every text once.
    cuts = F.broadcast(cuts) if 72 * size.rows + 24 * (size.chunks or 0) <= BROADCAST_BYTES else cuts
    joined = plain.join(cuts, DOCUMENT, "left")
    lines = F.split(F.col("text"), "\n")
    gone = F.array_distinct(F.flatten(F.transform("removed", lambda chunk: F.sequence(chunk["start"], chunk["stop"]))))
    joined = joined.withColumn("gone", F.when(F.col("removed").isNotNull(), gone))
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("gone", i)), "\n")
    joined = joined.withColumn("left", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left))
    fresh = {"doc_id": F.col("doc_id"), "text": F.col("left"), "n_chars": F.length("left").cast("long")}
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    return joined.select(
        *(fresh.get(name.lower(), F.col(f"row.`{name}`")).alias(name) for name in keep),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_removed_lines"),
        F.sort_array(F.coalesce("removed", nothing)).alias("removed"))
