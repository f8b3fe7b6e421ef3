"""Merkle manifest of a dataset: digests of documents, of sources and of the whole, and a proof for every document.

The leaves of a source are put in order by a range exchange, and numbered by running counts over its partitions, so no
task sorts a source. Every three consecutive nodes have one parent. The tree is climbed ``LEVELS`` levels at a time
inside blocks of ``FANOUT ** LEVELS`` nodes: a node of a level is the row of its first leaf, so its siblings stand at
fixed distances, and lag and lead columns, masked by the node's slot and the length of its run, supply them; rows of
first children hash the parents. One exchange by block serves all its levels, for blocks of any source, however large
the source is. The blocks' own digests are the nodes of the next climb, and the sources' digests those of the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigmart.llm.common import broadcast_ids, materialize

FANOUT = 3
LEVELS = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]  # what a leaf covers, in this order
KEY = ["known", "src"]  # a source: whether there is one, and its name; the missing one comes first
STEPS = "array<struct<left: string, right: string>>"


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """Byte count, colon and value; a dash for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """KEY, doc_id, leaf, changed (the leaf of the tampered row; null where nothing is tampered) and a number for the row.

    Rows whose crc32 of the decimal id is even are tampered with: their text loses its line feeds. A null id is left alone.
    """
    fields = [F.col(name) for name in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = [*fields[:-1], F.translate("text", "\n", "")]
    return docs.select(
        F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("src"), "doc_id",
        digest_of(*map(field, fields)).alias("leaf"), F.when(tampered, digest_of(*map(field, changed))).alias("changed"),
        F.monotonically_increasing_id().alias("row"))


def positioned(nodes: DataFrame, order: list[str], key: list[str] = KEY) -> tuple[DataFrame, int]:
    """``nodes`` with pos, the place within the source by ``order``, from 0, and n, the size of the source; the largest n.

    ``key`` names a source; its columns hold no nulls.
    """
    spread = nodes.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)
    # The partition's number is in the upper bits, the row's place in it below.
    placed = materialize(spread.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn(
        "part", F.shiftright("at", 33))
    counted = placed.groupBy(*key, "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(counted.select(
        *key, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(*key)).alias("n")), "runs")
    located = placed.join(broadcast_ids(runs, row_bytes=96), [*key, "part"]).withColumn("pos", F.col("at") + F.col("shift"))
    return located.drop("at", "part", "shift"), runs.agg(F.max("n")).first()[0] or 0


def climbed(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (KEY, pos, n, digest and others) with block, steps and top.

    steps lists, for every level inside the block, the digests left and right of the node's ancestor in its run, joined;
    top is the digest of the block, on its first row. Levels above a source's single node are passed through.
    """
    whole = FANOUT ** levels
    current = nodes.withColumn("block", F.expr(f"pos div {whole}")).withColumn("d0", F.col("digest"))
    window = Window.partitionBy(*KEY, "block").orderBy("pos")
    for level in range(levels):
        span = FANOUT ** level  # leaves of a whole node, and rows between neighbouring ones
        node, count = F.expr(f"pos div {span}"), F.expr(f"(n + {span - 1}) div {span}")
        slot, run = node % FANOUT, F.least(F.lit(FANOUT), count - F.expr(f"pos div {span * FANOUT}") * FANOUT)
        at = lambda mask, move, places, name=f"d{level}": F.when(mask, move(name, places).over(window)).otherwise("")
        left = F.concat(at(slot > 1, F.lag, 2 * span), at(slot > 0, F.lag, span))
        right = F.concat(at(slot + 1 < run, F.lead, span), at(slot + 2 < run, F.lead, 2 * span))
        current = current.withColumns({f"left{level}": left, f"right{level}": right})
        current = current.withColumn(f"step{level}", F.when((F.col("pos") % span == 0) & (count > 1), F.struct(
            F.col(f"left{level}").alias("left"), F.col(f"right{level}").alias("right"))))
        parent = F.when(count > 1, digest_of(F.col(f"d{level}"), F.col(f"right{level}"))).otherwise(F.col(f"d{level}"))
        current = current.withColumn(f"d{level + 1}", F.when(F.col("pos") % (span * FANOUT) == 0, parent))
    # The last node of a level that began at this row or before is this row's ancestor.
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = F.array(*(F.last(f"step{level}", ignorenulls=True).over(so_far) for level in range(levels)))
    return current.select(*nodes.columns, "block", F.filter(steps, lambda step: step.isNotNull()).alias("steps"),
                          F.col(f"d{levels}").alias("top"))


def ways(nodes: DataFrame, largest: int, levels: int = LEVELS) -> DataFrame:
    """KEY, pos, steps and root for every node: all steps from it up to the root of its source. Materialised."""
    up = climbed(nodes, levels)
    blocks = tops(up, levels)
    whole = FANOUT ** levels
    if largest <= whole:
        above = blocks.select(*KEY, "pos", F.array().cast(STEPS).alias("steps"), F.col("digest").alias("root"))
    else:
        above = ways(blocks, -(-largest // whole), levels)
    above = above.select(*KEY, F.col("pos").alias("block"), F.col("steps").alias("above"), "root")
    return materialize(up.join(above, [*KEY, "block"]).select(*KEY, "pos", F.concat("steps", "above").alias("steps"), "root"), "ways")


def tops(up: DataFrame, levels: int) -> DataFrame:
    """The blocks of a climb as nodes of the next one. Materialised."""
    whole = FANOUT ** levels
    return materialize(up.where(F.col("pos") % whole == 0).select(
        *KEY, F.col("block").alias("pos"), F.expr(f"(n + {whole - 1}) div {whole}").alias("n"), F.col("top").alias("digest")), "tops")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, leaf, lambda digest, step: digest_of(step["left"], digest, step["right"]))


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, steps (what a proof holds), proof_sha256, folded_root and verified, a row per document.

    A leaf covers ``FIELDS``; other columns are ignored. Null ids come first in their source, equal ids by leaf, equal
    rows in any order. A null source is a source of its own, apart from the empty name. An empty table has no rows.
    """
    rows = materialize(leaves(docs), "leaves")
    nodes, largest = positioned(rows, ["doc_id", "leaf", "row"])
    up = climbed(nodes.withColumn("digest", F.col("leaf")), levels)
    blocks = ways(tops(up, levels), -(-largest // FANOUT ** levels), levels).withColumnRenamed("root", "subroot")
    # Sources are the nodes of one more tree, all under one key.
    subroots = blocks.where("pos = 0").select(F.lit(True).alias("known"), F.lit("").alias("src"), F.col("known").alias("of"),
                                              F.col("src").alias("name"), F.col("subroot").alias("digest"))
    sources, count = positioned(subroots, ["of", "name"])
    sources = materialize(sources, "sources")
    joined = sources.join(ways(sources, count, levels), [*KEY, "pos"]).select(
        F.col("of").alias("known"), F.col("name").alias("src"), F.col("steps").alias("last"), "root")
    above = materialize(blocks.join(broadcast_ids(materialize(joined, "sources"), row_bytes=2048), KEY).select(
        *KEY, F.col("pos").alias("block"), "subroot", F.concat("steps", "last").alias("above"), "root"), "above")
    proofs = up.join(above, [*KEY, "block"]).select(
        "doc_id", "leaf", "changed", "subroot", "root", F.concat("steps", "above").alias("steps"))
    proof = F.array_join(F.transform("steps", lambda step: F.concat(step["left"], step["right"])), "")
    return proofs.withColumn("proof_sha256", F.sha2(proof, 256)).withColumn(
        "folded_root", folded(F.coalesce("changed", "leaf"), F.col("steps"))).select(
        "doc_id", "leaf", "subroot", "root", "steps", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
