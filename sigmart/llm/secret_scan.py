"""Secrets in texts, with weak candidates reported only where complementary parts stand together.

Strong parts are found by their form alone: assigned secrets, access identifiers and long hexadecimal strings. Weak
parts (bare 40-character keys, endpoints, logins) mean little alone. A text is cut into scopes at blank lines. A weak
part is reported if a part of a kind that completes it, strong or weak, stands in its scope (or within ``reach`` code
points there, if the caller gives a number): one sorted pass, which looks at the nearest complement before and after
each candidate, so no pairs are formed. The scan reads each text once in its own task and shuffles nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REACH = 400
KINDS = ["assign", "access", "hex", "key", "endpoint", "login"]
BASE = KINDS[:3]
FINDINGS = "array<struct<kind: string, start: int, stop: int>>"

# The base patterns, their smallest lengths, and words without which a pattern cannot match.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Weak parts and the strong or weak kinds that complete them.
KEY = re.compile(r"(?<![A-Za-z0-9/+=])(?=[A-Za-z/+]*[0-9])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])")
KEY_LETTERS = re.compile("[A-Z]"), re.compile("[a-z]")  # one of each stands at the key's start or later
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'<>]{4,}")
LOGIN = re.compile(r"(?:user(?:name)?|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?([^\s\"',;]{2,})", re.I | re.A)
COMPLETED_BY = {"key": ("access", "endpoint", "login"), "endpoint": ("assign", "access", "hex", "key", "login"),
                "login": ("assign", "hex", "key", "endpoint")}
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")


def strong_parts(text: str) -> list[tuple[str, int, int]]:
    """The base matches, leftmost and without overlaps within a kind, short ones dropped after matching."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _keys(text: str) -> list[tuple[int, int]]:
    found, seen = [], [-1, -1]
    for match in KEY.finditer(text):
        for place, letter in enumerate(KEY_LETTERS):  # each search goes on where the last one ended: linear in all
            if seen[place] < match.start():
                after = letter.search(text, match.start())
                if not after:
                    return found
                seen[place] = after.start()
        found.append(match.span())
    return found


def linked_parts(text: str, strong: list[tuple[str, int, int]], reach: int | None) -> list[tuple[str, int, int]]:
    """The weak parts that a complementary part completes within their scope, as far as ``reach`` (None: all of it)."""
    walls = [0, *(m.start() for m in BLANK_LINE.finditer(text)), len(text)]
    parts: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    for kind, start, stop in strong:
        parts[kind].append((start, stop))
    taken = sorted((start, stop) for _, start, stop in strong)
    begins = [start for start, _ in taken]

    def free(start: int, stop: int) -> bool:
        at = bisect_left(begins, stop) - 1
        return at < 0 or taken[at][1] <= start

    def apart(kind: str, start: int, stop: int, other: tuple[int, int]) -> bool:
        # The value of a login, or the login in an address, is no second part.
        return kind in BASE or other[1] <= start or stop <= other[0]

    def near(start: int, stop: int, kind: str) -> bool:
        scope = bisect_right(walls, start) - 1
        low, high = walls[scope], walls[min(scope + 1, len(walls) - 1)]
        if reach is not None:
            low, high = max(low, start - reach), min(high, stop + reach)
        others = parts[kind]
        at = bisect_left(others, (start, stop))
        while at > 0 and others[at - 1][0] >= low and not apart(kind, start, stop, others[at - 1]):
            at -= 1
        if at > 0 and low <= others[at - 1][0] and others[at - 1][1] <= high:
            return True
        at = bisect_left(others, (start, stop))
        while at < len(others) and others[at][1] <= high and not apart(kind, start, stop, others[at]):
            at += 1
        return at < len(others) and low <= others[at][0] and others[at][1] <= high

    parts["key"] = [span for span in _keys(text) if free(*span)]
    parts["endpoint"] = [m.span() for m in ENDPOINT.finditer(text)]
    parts["login"] = [m.span() for m in LOGIN.finditer(text) if free(*m.span())]
    return [(kind, start, stop) for kind, complements in COMPLETED_BY.items() for start, stop in parts[kind]
            if any(near(start, stop, other) for other in complements)]


def findings(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """``docs`` with column findings: (kind, start, stop) in code points, by start, then in the order of ``KINDS``.

    Null and empty texts have no findings, repeated rows the same ones; all columns of ``docs`` but one called
    findings are kept.
    """
    docs = docs.select(*(F.col(f"`{name}`") for name in docs.columns if name.lower() not in ("findings", "scanned")))
    plain = docs.select("*", F.col("text").alias("scanned"))
    schema = docs.select("*", F.lit(None).cast(FINDINGS).alias("findings")).schema

    def scan(batches):
        import pyarrow as pa

        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        rank = {kind: place for place, kind in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                strong = strong_parts(text) if text else []
                parts = strong + linked_parts(text, strong, reach) if text else []
                parts.sort(key=lambda part: (part[1], rank[part[0]]))
                rows.append([{"kind": kind, "start": start, "stop": stop} for kind, start, stop in parts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, type=kind_type)], schema.names)

    return plain.mapInArrow(scan, schema)


def spans(found, kinds: list[str] | None = None):
    """kind:start:stop of the findings (of some kinds), joined by commas."""
    chosen = found if kinds is None else F.filter(found, lambda part: part["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda part: F.concat_ws(":", part["kind"], part["start"], part["stop"])), ",")


def count_of(found, kind: str):
    return F.size(F.filter(found, lambda part: part["kind"] == kind)).cast("long")
