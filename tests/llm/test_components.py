"""Components of a graph: right against plain Python, and without rounds that change nothing."""

from __future__ import annotations

import random

import pytest

from sigmart.llm import near_dedup


def smallest_reachable(edges):
    parent = {node: node for edge in edges for node in edge}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {node: root(node) for node in parent}


def written(monkeypatch) -> list[str]:
    """The names of what is written to the shared folder from now on."""
    names = []
    plain = near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda df, name: names.append(name) or plain(df, name))
    return names


@pytest.mark.parametrize("kind", ["stars", "path", "random", "pairs", "none"])
def test_components(spark, monkeypatch, kind):
    rng = random.Random(3)
    edges = {
        "stars": [(n, n % 3) for n in range(3, 60)],
        "path": [(n, n + 1) for n in range(40)],
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(50)],
        "pairs": [(2 * n, 2 * n + 1) for n in range(10)] + [(1, 0), (0, 1)],
        "none": [],
    }[kind]
    names = written(monkeypatch)
    got = near_dedup.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({row.node for row in got})
    assert {row.node: row.component for row in got} == smallest_reachable([(a, b) for a, b in edges if a != b])
    if kind in ("stars", "pairs", "none"):
        assert names == ["edges"]


def test_no_rounds_without_further_links(spark, monkeypatch):
    """Copies with one word changed around one text: all links are found around the heads, and components once."""
    base = [f"word{n}" for n in range(200)]
    texts = [" ".join([*base[:20 * n], f"other{n}", *base[20 * n + 1:]]) for n in range(1, 9)] + [" ".join(base), "alone in here"]
    names = written(monkeypatch)
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), size=2).collect()
    assert {row.doc_id: row.component_id for row in rows} == {n: 0 if n < 9 else 9 for n in range(10)}
    assert names.count("edges") <= 3 and names.count("stars") == 1
