"""Quality rules with a verdict on the host.

Facts of every text are counted in its own row. Rule failures are summed by host; an empirical beta prior, fitted by
moments over the hosts, shrinks a host's failure rates, so a host with few documents is judged mostly by what is
usual. Documents of a host that fails a rule too often are dropped with it. Only narrow facts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import materialize, words

WINDOW = 8
SHORTEST = 20  # words
MOST_REPEATED = 30  # percent of words in repeated windows
HOST_LIMIT = 0.5  # shrunk failure rate of a rule beyond which a host is rejected
RULES = ["short", "repetitive", "symbolic", "echoing"]
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(found: str, window: int) -> list[tuple[str, Column]]:
    """Steps (column, expression), each over the one before, to the number of words in windows found twice or more.

    Window hashes tell in linear time which texts repeat anything; only there the windows themselves are sorted, and
    equal neighbours give the positions.
    """
    n = F.size(found)
    at = lambda array, place: F.get(F.col(array), place)
    places = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(F.col("places"), lambda i: F.xxhash64(*(at("hashes", i + k) for k in range(window))))
    text = lambda i: F.concat_ws(" ", *(at(found, i + k) for k in range(window)))
    ordered = F.when(F.size(F.array_distinct("hashed")) < F.size("hashed"),
                     F.sort_array(F.transform(F.col("places"), lambda i: F.struct(text(i).alias("w"), i.alias("i")))))
    twice = F.filter(F.col("ordered"), lambda x, k: (at("ordered", k - 1)["w"] == x["w"]) | (at("ordered", k + 1)["w"] == x["w"]))
    start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate(
        F.sort_array(F.transform(F.col("twice"), lambda x: x["i"])), start,
        lambda seen, i: F.struct(i.alias("last"), (seen["total"] + F.least(F.lit(window), i - seen["last"])).alias("total")),
        lambda seen: seen["total"])
    return [("hashes", F.transform(found, lambda word: F.xxhash64(word))), ("places", places), ("hashed", hashed),
            ("ordered", ordered), ("twice", twice), ("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))]


def facts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, host (the source), FACTS, n_lines and symbol-free counts of each text; zeros for null and empty texts."""
    text = F.coalesce("text", F.lit(""))
    current = docs.select("doc_id", F.col("source").alias("host"), text.alias("text")).select(
        "doc_id", "host", words(F.col("text")).alias("found"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    current = current.withColumns({
        "n_words": F.size("found").cast("long"), "word_chars": F.length(F.array_join("found", "")).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}).drop("lines")
    for name, step in _repeat_words("found", window):
        current = current.withColumn(name, step)
    return current.select("doc_id", "host", *FACTS, "n_lines")


def failures() -> dict[str, Column]:
    return {
        "short": F.expr(f"n_words < {SHORTEST}"),
        "repetitive": F.expr(f"100 * n_repeat_words > {MOST_REPEATED} * n_words"),
        "symbolic": F.expr("10 * n_symbols > word_chars"),
        "echoing": F.expr("3 * n_dup_lines > n_lines"),
    }


def host_verdicts(judged: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, documents, failures and shrunk rate by rule, rejected; ``judged`` has host and a boolean for each rule."""
    hosts = materialize(judged.groupBy("host").agg(
        F.count("*").alias("documents"), *(F.count_if(F.col(rule)).alias(rule) for rule in RULES)), "hosts")
    moments = hosts.agg(
        F.sum("documents").alias("n"), F.count("*").alias("hosts"),
        *(F.sum(rule).alias(f"sum_{rule}") for rule in RULES),
        *(F.sum(F.col(rule) * F.col(rule) / F.col("documents")).alias(f"square_{rule}") for rule in RULES)).first()
    rates = {}
    for rule in RULES:
        alpha, beta = beta_prior(moments["n"] or 0, moments["hosts"], moments[f"sum_{rule}"] or 0, moments[f"square_{rule}"] or 0.0)
        rates[rule] = (F.col(rule) + alpha) / (F.col("documents") + (alpha + beta))
    rejected = F.greatest(*rates.values()) > limit
    return hosts.select("host", "documents", *RULES, *(rate.alias(f"rate_{rule}") for rule, rate in rates.items()),
                        rejected.alias("rejected"))


def beta_prior(documents: int, hosts: int, failed: int, squares: float) -> tuple[float, float]:
    """Moments over hosts, weighted by documents. ``squares``: the sum of failed^2 / documents over hosts.

    The prior weighs as 1 document at least, and as 1000 where hosts do not differ by more than chance.
    """
    mean = (failed + 0.5) / (documents + 1.0)
    if not documents:
        return 0.5, 0.5
    spread = squares / documents - (failed / documents) ** 2
    chance = mean * (1 - mean) * hosts / documents
    between = spread - chance
    weight = 1000.0 if between <= 0 else min(1000.0, max(1.0, mean * (1 - mean) / between - 1))
    return mean * weight, (1 - mean) * weight


def judged_documents(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, host, FACTS, n_lines, base_failed, host_rejected and kept, one row per row of ``docs``.

    Null and empty texts have no words, so they fail. Documents without a source form one host. Repeated rows count
    each. An empty table gives an empty result; other columns are ignored.
    """
    counted = materialize(facts(docs), "facts")
    failed = counted.withColumns(failures())
    verdicts = host_verdicts(failed, limit).select(F.col("host").alias("judged_host"), "rejected")
    joined = failed.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
    return joined.withColumn("base_failed", F.col("short") | F.col("repetitive")).select(
        "doc_id", "host", *FACTS, "n_lines", "base_failed", F.col("rejected").alias("host_rejected"),
        (~F.col("base_failed") & ~F.col("rejected")).alias("kept"))
