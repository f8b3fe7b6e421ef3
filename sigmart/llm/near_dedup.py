"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. The sketch has ``bands * rows`` coordinates. In round
``i`` every element is thrown into one coordinate by a hash of its own, and a coordinate that is still empty takes the
smallest element it gets. After as many rounds as there are coordinates, the empty ones take the minimum over the whole
set, so each coordinate is filled. Two sets agree in a coordinate with a probability equal to their similarity, and
the number of agreements concentrates as for independent minima.

Documents with equal sets are one class from the start. Classes that share a band are candidates, and their pairs are
confirmed on the full sets. No pairs within a bucket are formed wholesale. The head of a bucket is its most central
member, and each class is compared with the one head it shares the most bands with. Classes of one head are then joined
exactly on the elements in which they differ from it. Last, members of one bucket with different heads that are not
yet connected are compared.

With 48 bands of 6 rows a pair at similarity 0.8 is missed with a probability of about 5e-7. Shingles are 64-bit hashes:
two different shingles of one pair of documents collide with a probability below 1e-12 at 3,000 shingles each.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import HashedWords, broadcast_ids, hashed_words, list_array, materialize, mix64

BANDS, ROWS, PERCENT = 48, 6, 80


def shingle_set(text: bytes | None, size: int, memo: HashedWords) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; the whole sequence where there are fewer words."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    ids = hashed_words(memo, found, len(found))
    width = min(size, len(ids))
    mixed = np.full(len(ids) - width + 1, width, dtype=np.uint64)
    for offset in range(width):
        mixed = mix64(mixed ^ ids[offset:len(ids) - width + 1 + offset])
    return np.unique(mixed)


def fast_sketch(elements: np.ndarray, coordinates: int) -> np.ndarray:
    """The sketch of a set that is not empty: the round in the upper bits, the element's hash below."""
    sketch = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = math.ceil(coordinates * math.log(coordinates + 1) / len(elements)) + 1
    step = max(1, min(step, coordinates, 65536 // len(elements)))
    done = 0
    while done < coordinates:
        rounds = np.arange(done, min(done + step, coordinates), dtype=np.uint64)
        thrown = mix64(elements[None, :] ^ mix64(rounds + np.uint64(1))[:, None])
        bins = ((thrown >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        keys = (mix64(thrown) >> np.uint64(16)) | (rounds << np.uint64(48))[:, None]
        np.minimum.at(sketch, bins.ravel().astype(np.intp), keys.ravel())
        done += len(rounds)
        if sketch.max() >> np.uint64(48) < done:
            return sketch
    for place in np.flatnonzero(sketch == np.iinfo(np.uint64).max):
        turn = np.array([coordinates + place], dtype=np.uint64)
        sketch[place] = (mix64(mix64(elements ^ mix64(turn + np.uint64(1)))) >> np.uint64(16)).min() | (turn << np.uint64(48))[0]
    return sketch


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band, the number of the band included."""
    parts = sketch.reshape(bands, -1)
    keys = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for column in range(parts.shape[1]):
        keys = mix64(keys ^ parts[:, column])
    return keys.view(np.int64)


def sketches(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys; digest and keys are null for an empty set."""

    def scan(batches):
        import pyarrow as pa

        memo, last = HashedWords(), OrderedDict()
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                elements = shingle_set(text, size, memo)
                counts.append(len(elements))
                if not len(elements):
                    digests.append(None)
                    keys.append(None)
                    continue
                digest = xxhash.xxh3_128_digest(elements.tobytes())
                if digest not in last:
                    last[digest] = band_keys(fast_sketch(elements, bands * rows), bands)
                    if len(last) > 256:
                        last.popitem(last=False)
                digests.append(digest)
                keys.append(last[digest])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, type=pa.int64()), pa.array(digests, type=pa.binary()),
                 list_array(keys, pa.int64())], ["doc_id", "n_shingles", "digest", "bands"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(scan, "doc_id long, n_shingles long, digest binary, bands array<long>")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), by large-star and small-star rounds.

    Each round is written to the shared folder, so a lost executor costs one round at most. Edges lead from a larger to a
    smaller node; once no node has two edges down, or edges on both sides, they are stars around the smallest nodes.
    """

    def star(directed: DataFrame) -> DataFrame:
        """(u, v) to (u, v, smallest of u and its v)."""
        least = directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        return directed.join(least, "u")

    def stars(current: DataFrame) -> bool:
        ends = current.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
            current.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        return not ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 AND down > 0").count()

    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct(), "edges")
    while not stars(current):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        small = down.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            down.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")
        current = materialize(small.distinct(), "edges")
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) with the sizes of their full sets, whether these reach the similarity, and the elements that
    only one of them has. ``texts``: doc_id, text."""

    def compare(batches):
        import pyarrow as pa

        memo, seen = HashedWords(), OrderedDict()

        def cached(text: bytes) -> np.ndarray:
            if text not in seen:
                seen[text] = shingle_set(text, size, memo)
                if len(seen) > 16:
                    seen.popitem(last=False)
            return seen[text]

        for batch in batches:
            sizes_a, sizes_b, linked, apart = [], [], [], []
            columns = [batch.column(name).to_pylist() for name in ("text_a", "text_b")]
            for text_a, text_b in zip(*columns, strict=True):
                one, other = shingle_set(text_a, size, memo), cached(text_b)
                apart.append(np.setxor1d(one, other, assume_unique=True).view(np.int64))
                union = (len(one) + len(other) + len(apart[-1])) // 2
                linked.append(100 * (union - len(apart[-1])) >= percent * union)
                sizes_a.append(len(one))
                sizes_b.append(len(other))
            counts = [pa.array(values, type=pa.int64()) for values in (sizes_a, sizes_b)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *counts, pa.array(linked, type=pa.bool_()), list_array(apart, pa.int64())],
                ["a", "b", "n_a", "n_b", "linked", "apart"])

    side = lambda name: texts.select(F.col("doc_id").alias(name), F.col("text").cast("binary").alias(f"text_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a long, b long, n_a long, n_b long, linked boolean, apart array<long>")


def links_around_heads(compared_: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All links (a, b) among texts compared with one head of which one at least is not linked to it.

    With D the elements in which a text differs from the head, two texts differ in |Da| + |Db| - 2 |Da and Db| elements.
    A text b that is not linked to the head has so large a Db that any link needs shared elements of Da and Db: more
    than ``percent`` / (100 + ``percent``) of Da, and a bound that follows from Db alone. So the rarest elements of
    either side, as many as the bounds leave, have one in common: an exact join on them finds every link without
    forming the pairs of a group.
    """
    whole, rest = 100 + percent, 100 - percent
    groups = compared_.groupBy("b").agg(F.count("*").alias("members"), F.count_if(~F.col("linked")).alias("loose")).where(
        "members > 1 AND loose > 0").select("b")
    near = compared_.join(groups, "b", "left_semi").withColumn("d", F.size("apart").cast("long"))
    elements = near.select("a", "b", "linked", F.explode("apart").alias("e"))
    common = elements.groupBy("b", "e").agg(F.count("*").alias("f"), F.count_if(~F.col("linked")).alias("loose")).where(
        "f > 1 AND loose > 0").select("b", "e", "f")
    ranked = elements.join(common, ["b", "e"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("ranked"))
    needed = F.when(F.col("linked"), F.expr(f"{percent} * d div {whole} + 1")).otherwise(
        F.expr(f"greatest(1, ({whole} * d - {rest} * (n_a + n_b) + 199) div 200)"))
    # Elements that no other text has stand before all others and match nothing.
    taken = F.col("d") - needed + 1 - (F.col("d") - F.size("ranked"))
    before = (F.col("d") - F.size("ranked")).alias("before")
    prefixes = ranked.join(near.select("a", "b", "linked", "n_a", "n_b", "d"), ["a", "b"]).select(
        "a", "b", "linked", "d", "n_a", before,
        F.posexplode(F.slice("ranked", 1, F.greatest(taken, F.lit(0)).cast("int"))).alias("place", "r")).select(
        "a", "b", "linked", "d", "n_a", (F.col("before") + F.col("place")).alias("place"), F.col("r.e").alias("e"))
    # From the first common element on, either side must still have as many elements as the two texts need to share.
    enough = " AND ".join(f"{2 * whole} * ({side}.d - {side}.place) >= {whole} * (x.d + y.d) - {rest} * (x.n_a + y.n_a)"
                          for side in "xy")
    candidates = prefixes.where("NOT linked").alias("x").join(prefixes.alias("y"), F.expr(
        f"x.b = y.b AND x.e = y.e AND x.a <> y.a AND (y.linked OR x.a < y.a) AND {enough}")).select(
        F.col("x.b").alias("b"), F.col("x.a").alias("a1"), F.col("y.a").alias("a2")).distinct()
    side = lambda name: near.select(F.col("a").alias(f"a{name}"), "b", F.col("n_a").alias(f"n{name}"),
                                    F.col("apart").alias(f"d{name}"))
    differing = F.expr("size(d1) + size(d2) - 2 * size(array_intersect(d1, d2))")
    return candidates.join(side(1), ["b", "a1"]).join(side(2), ["b", "a2"]).withColumn("s", differing).where(
        f"100 * (n1 + n2 - s) >= {percent} * (n1 + n2 + s)").select(F.col("a1").alias("a"), F.col("a2").alias("b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    Empty and null texts have no shingles and stand alone. Rows that repeat a doc_id are one document. A null doc_id
    never names a component: such a row gets the component of equal sets, or null, and is kept only where that is null.
    An empty table gives an empty result; other columns are ignored.
    """
    sketched = materialize(sketches(docs, size, bands, rows), "sketches")
    classes = materialize(
        sketched.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .where("rep IS NOT NULL"), "classes")
    entries = classes.select("rep", "n", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("mates")).where("mates > 1")
    shared = materialize(entries.join(sizes, "key"), "buckets")
    # The member with the most bucket mates heads its buckets: the text that many near copies were made from.
    central = shared.groupBy("rep").agg(F.sum("mates").alias("central"))
    headed = shared.join(central, "rep")
    heads = headed.groupBy("key").agg(F.max_by("rep", F.struct("central", -F.col("rep"))).alias("head"))
    needed = broadcast_ids(materialize(shared.select(F.col("rep").alias("doc_id")).distinct(), "candidates"))
    texts = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
                        .join(needed, "doc_id", "left_semi"), "texts")

    best = F.max_by("head", F.struct("bands", -F.col("head")))
    chosen = shared.join(heads, "key").where("rep <> head").groupBy("rep", "head").agg(F.count("*").alias("bands")).groupBy("rep").agg(
        best.alias("b")).select(F.col("rep").alias("a"), "b")
    stars = materialize(chosen, "stars")  # read three times
    # Many members may share one head, so the join by head comes last: adaptive execution splits it.
    around = materialize(compared(stars, texts, size, percent), "compared")
    links = materialize(around.where("linked").select("a", "b").unionAll(links_around_heads(around, percent)), "links")
    component = connected(links)

    # What is left: texts of one bucket that were compared with different heads and are not connected.
    located = shared.join(component, shared["rep"] == component["node"], "left").join(
        stars.select(F.col("a").alias("rep"), F.col("b").alias("chosen")), "rep", "left").select(
        "key", "rep", "n", F.coalesce("component", "rep").alias("component"), F.coalesce("chosen", "rep").alias("head"))
    mixed = located.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    apart = materialize(located.join(mixed.select("key"), "key", "left_semi"), "apart")
    groups = apart.groupBy("key", "head").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    crossing = groups.alias("x").join(groups.alias("y"), F.expr(
        "x.key = y.key AND x.head < y.head AND NOT (x.low = y.high AND x.high = y.low)")).select(
        F.col("x.key").alias("key"), F.col("x.head").alias("left"), F.col("y.head").alias("right"))
    member = lambda side, name: apart.select("key", F.col("head").alias(side), F.col("rep").alias(name),
                                             F.col("n").alias(f"n_{name}"), F.col("component").alias(f"c_{name}"))
    fitting = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) AND c_a <> c_b")
    left, right = crossing.join(member("left", "a"), ["key", "left"]), member("right", "b")
    pairs = left.join(right, (left["key"] == right["key"]) & (left["right"] == right["right"]) & fitting).select("a", "b").distinct()
    done = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = materialize(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    more = materialize(compared(pairs, texts, size, percent).where("linked").select("a", "b"), "links")
    # Often no more links are found; those that are join the components there are.
    known = component.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected(known.unionAll(more)) if more.count() else component

    named = classes.select("digest", "rep").join(final, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    return sketched.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.expr("component_id <=> doc_id"))
