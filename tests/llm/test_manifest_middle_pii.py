"""Merkle trees of several climbs, wavelet ranks, and the random field against sums over all segmentations."""

from __future__ import annotations

import itertools
import random
import string

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigmart.llm import fill_in_middle, merkle, pii
from tests.llm import brute
from tests.llm.test_odd_rows import ROWS, docs, multiset, nothing  # noqa: F401

PROOF = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_odd_rows(spark, docs, nothing):  # noqa: F811
    rows = [tuple(row) for row in docs.select(*merkle.FIELDS).collect()]
    assert multiset(merkle.manifest(docs), *PROOF) == sorted(brute.merkle(rows), key=repr)
    assert merkle.manifest(nothing).collect() == []


@pytest.mark.parametrize("levels", [1, 2])
def test_merkle_climbs_several_times(spark, levels):
    """Blocks of 3 or 9 leaves, so that trees of 60 leaves and of 31 sources take several climbs."""
    rows = [(i, "big" if i < 60 else None if i < 65 else f"s{i % 30}", "en", i, f"text {i}\n") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert multiset(merkle.manifest(frame, levels), *PROOF) == sorted(brute.merkle(rows), key=repr)


def test_wavelet_ranks():
    symbols = np.random.RandomState(1).randint(0, 8, 1000).astype(np.uint8)
    matrix = fill_in_middle.WaveletMatrix(symbols, 3)
    places = np.array([0, 1, 63, 64, 65, 500, 999, 1000])
    for symbol in range(8):
        assert matrix.rank(symbol, places).tolist() == [int((symbols[:place] == symbol).sum()) for place in places]


def test_middle_odd_rows(spark, docs, nothing):  # noqa: F811
    random.seed(2)
    texts = ["".join(random.choice("ab \n\té世\u2028") for _ in range(random.randint(0, 60))) for _ in range(300)]
    texts += ["<P>", "a <S> b", "<M", "", " ", "a", "\x0b\x0c", "😀 😀"]
    for rows in ([(i, t) for i, t, _ in ROWS], list(enumerate(texts))):
        frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash"))
        made = fill_in_middle.transformed(frame)
        assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
        got = multiset(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
        assert got == sorted(((i, *brute.middle(i, t)) for i, t in rows), key=repr)
        rebuilt = made.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text"))
        assert multiset(rebuilt, "doc_id", "text") == sorted(((i, t or "") for i, t in rows), key=repr)
    assert fill_in_middle.transformed(docs).count() == len(ROWS) and fill_in_middle.transformed(nothing).collect() == []


def test_base_spans_against_plain_patterns():
    random.seed(4)
    alphabet = "0123456789" * 3 + "  .-+()@@a_%Z\né"
    pieces = ["4111 1111 1111 1111", "4111111111111112", "+1 (743) 555-3824", "10.0.0.255", "10.0.0.256", "a.b@c-d.e.f", "0" * 30 + ".1.2.3", "x@y@z.w_v@u.t"]
    for _ in range(4000):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        text = random.choice([text, text + random.choice(pieces) + text[::-1]])
        assert sorted(pii.base_spans(text)) == sorted(brute.personal(text)), text


def segmentations(lattice, place=0):
    """All ways to cut the tokens from a place on: lists of (first, last, type or None, candidate)."""
    if place == lattice.size:
        yield []
        return
    for rest in segmentations(lattice, place + 1):
        yield [(place, place + 1, None, None), *rest]
    for row, (first, last, _) in enumerate(lattice.spans):
        if first == place:
            for kind in np.flatnonzero(lattice.allowed[row]):
                for rest in segmentations(lattice, last):
                    yield [(first, last, int(kind), row), *rest]


def test_field_against_all_segmentations():
    random_weights = np.random.RandomState(5).normal(scale=0.7, size=len(pii.Field().flat))
    field = pii.Field(random_weights)
    for text in ("+1 743 555-3824", "ab@c.de 1234567", "10.0.0.1.2", "a [at] b [dot] cd"):
        lattice = pii.Lattice(text, 0, len(text), [])
        scores = field.scores(lattice, False)
        table = []
        for cut in segmentations(lattice):
            kinds = [0] + [0 if kind is None else kind + 1 for _, _, kind, _ in cut]
            value = sum(scores[row, kind] for _, _, kind, row in cut if kind is not None)
            table.append((value + sum(field.moves[a, b] for a, b in itertools.pairwise(kinds)), cut))
        total = np.logaddexp.reduce([value for value, _ in table])
        chances, _, reached = field.chances(lattice, scores)
        assert reached == pytest.approx(total)
        want = np.zeros_like(chances)
        for value, cut in table:
            for _, _, kind, row in cut:
                if kind is not None:
                    want[row, kind] += np.exp(value - total)
        assert np.allclose(chances, want)
        best = max(table, key=lambda pair: pair[0])[1]
        assert field.best(lattice, scores) == [(row, kind) for _, _, kind, row in best if kind is not None]
        gold = [(first, last, kind) for first, last, kind, _ in best if kind is not None]
        slope, value = field.gradient(lattice, gold)
        for place in np.argsort(-np.abs(slope))[:5]:
            moved = random_weights.copy()
            moved[place] += 1e-6
            assert (pii.Field(moved).gradient(lattice, gold)[1] - value) / 1e-6 == pytest.approx(slope[place], abs=1e-4)


def planted(n):
    """Prose with matches of the fixed patterns, lookalikes, and forms that only the field can find: text, those spans."""
    random.seed(n)
    word = lambda: "".join(random.choices(string.ascii_lowercase, k=random.randint(2, 9)))
    number = lambda k: "".join(random.choices("0123456789", k=k))

    def card():
        digits = "4" + number(14)
        return next(digits + d for d in "0123456789" if pii._luhn(digits + d))

    address = ".".join(str(random.randint(1, 254)) for _ in range(4))
    mail = f"{word()}.{number(2)}@{word()}.example.com"
    phone = f"+1 ({number(3)}) 555-{number(4)}"
    plain = [mail, address, card(), phone, "2024-01-31 12:30:00", number(16)[:13] + "x", f"{number(3)}.{number(3)}", f"order {number(8)}", "1.2.3.900"]
    hidden = [mail.replace("@", " [at] "), address.replace(".", "[.]"), f"({number(3)}) 555-{number(4)}"]
    chosen, body, spans = random.choice(plain), " ".join(word() for _ in range(12)) + " ", []
    if n % 4 == 0:
        chosen = random.choice(hidden)
        spans = [(len(body), len(body) + len(chosen))]
    return body + chosen + " " + " ".join(word() for _ in range(12)), spans


def test_field_finds_what_patterns_miss(spark):
    train = spark.createDataFrame([(planted(n)[0],) for n in range(1, 1200) if n % 4], "text string")
    fresh = [planted(n) for n in range(5000, 5400)]
    field = pii.fit(train)
    hidden = found = wrong = 0
    for text, spans in fresh:
        added = [(start, stop) for _, start, stop, base, _ in pii.entities(text, field) if not base]
        hidden += len(spans)
        found += len(set(added) & set(spans))
        wrong += len(set(added) - set(spans))
    assert hidden == 100 and found >= 90 and wrong <= 2, (hidden, found, wrong)


def test_long_islands_lose_nothing():
    field = pii.Field(np.random.RandomState(5).normal(size=len(pii.Field().flat)))
    assert all(stop - start >= pii.OVERLAP for start, stop, _, _ in pii.windows(0, 50_000)[:-1])
    taken = [(low, high) for _, _, low, high in pii.windows(0, 50_000)]
    assert taken[0][0] == 0 and taken[-1][1] == 50_000 and all(a[1] == b[0] for a, b in itertools.pairwise(taken))
    text = "12 34 " * 3000 + "+1 (743) 555-3824"
    assert {span[:3] for span in pii.entities(text, field) if span[3]} == set(pii.base_spans(text))


def test_personal_data_odd_rows(spark, docs, nothing):  # noqa: F811
    got = pii.findings(docs)
    assert got.columns == [*docs.columns, "findings"] and got.count() == len(ROWS)
    assert pii.findings(nothing).collect() == []
    rows = [(1, "mail bob@mail.example.com or 10.0.0.1"), (1, "mail bob@mail.example.com or 10.0.0.1"), (None, None), (2, ""), (3, "@")]
    found = pii.findings(spark.createDataFrame(rows, "findings long, text string"))
    pairs = [(r.text, pii_spans) for r, pii_spans in ((r, [(x.kind, x.start, x.stop) for x in r.findings if x.base]) for r in found.collect())]
    assert sorted(pairs, key=repr) == sorted(((t, brute.personal(t)) for _, t in rows), key=repr)
    assert isinstance(found.toPandas(), pd.DataFrame)
