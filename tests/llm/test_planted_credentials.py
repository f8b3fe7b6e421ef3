"""Linking of credentials in planted texts against a linker that looks at every pair of parts of a scope."""

from __future__ import annotations

import random
import re
import string

from sigmart.llm import secret_scan
from tests.llm import brute

WEAK = {
    "key": re.compile(r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"),
    "endpoint": re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'<>]{4,}"),
    "login": re.compile(r"(?:user(?:name)?|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?([^\s\"',;]{2,})", re.I | re.A),
}


def linked(text):
    """Every weak part with a part of a completing kind in its scope, by all pairs."""
    strong = brute.secrets(text)
    free = lambda a, b: all(b <= start or stop <= a for _, start, stop in strong)
    parts = list(strong)
    for kind, pattern in WEAK.items():
        for m in pattern.finditer(text):
            if kind == "key" and not all(any(c in letters for c in m[0]) for letters in (string.digits, string.ascii_uppercase, string.ascii_lowercase)):
                continue
            if kind == "endpoint" or free(*m.span()):
                parts.append((kind, *m.span()))
    walls = [0, *(m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)), len(text)]
    scope = lambda start: max(i for i, wall in enumerate(walls[:-1]) if wall <= start) if len(walls) > 1 else 0
    out = []
    for kind, start, stop in parts:
        if kind in WEAK and any(
                other in secret_scan.COMPLETED_BY[kind] and scope(a) == scope(start) and b <= walls[scope(start) + 1]
                and (kind in secret_scan.BASE or b <= start or stop <= a) for other, a, b in parts):
            out.append((kind, start, stop))
    return sorted(out)


def planted(seed):
    random.seed(seed)
    pick = lambda letters, n: "".join(random.choices(letters, k=n))
    key = lambda: "a1Z" + pick(string.ascii_letters + string.digits + "/+", 37)
    pieces = [
        lambda: f"id {'AKIA' + pick(string.ascii_uppercase + string.digits, 16)} ", lambda: f"{key()} ",
        lambda: f"https://{pick(string.ascii_lowercase, 8)}.example.com/{pick(string.digits, 3)} ", lambda: f"user={pick(string.ascii_lowercase, 6)} ",
        lambda: f"password = {pick(string.ascii_letters, 12)} ", lambda: pick("0123456789abcdef", 32) + " ", lambda: "\n\n", lambda: "\n \t\n",
        lambda: " ".join(pick(string.ascii_lowercase, 5) for _ in range(random.randint(1, 200))) + "\n", lambda: "user: ab, login: https://cd.ef/gh ",
    ]
    return "".join(random.choice(pieces)() for _ in range(random.randint(1, 14)))


def test_linking_against_all_pairs():
    some = none = 0
    for seed in range(3000):
        text = planted(seed)
        got = sorted(secret_scan.linked_parts(text, secret_scan.strong_parts(text), None))
        assert got == linked(text), text
        weak = sum(len(pattern.findall(text)) for pattern in WEAK.values())
        some, none = some + bool(got), none + (weak > 0 and not got)
    assert some > 500 and none > 200, "complements decide"


def test_planted_parts_reach_the_findings(spark):
    texts = [planted(seed) for seed in range(200)]
    found = secret_scan.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in found:
        got = sorted((part.kind, part.start, part.stop) for part in row.findings if part.kind not in secret_scan.BASE)
        assert got == linked(texts[row.doc_id])
