"""The registered corpus queries against plain Python, over whole supplied tables."""

from __future__ import annotations

import hashlib
import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from sigmart.llm.queries import QUERIES
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).toPandas()


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_quality_rules(spark, docs):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in result(spark, "op1_quality_rules").itertuples()}
    assert got == {i: brute.facts(t) for i, t in zip(docs.doc_id, docs.text)}


def test_line_dedup(spark, docs):
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in result(spark, "op4_line_dedup").itertuples()}
    pairs = {pair for t in docs.text for pair in zip([None, *t.split("\n")], t.split("\n"))}
    frame = spark.createDataFrame(sorted(pairs, key=repr), "a string, b string")
    rolled = frame.selectExpr("a", "b", "xxhash64(if(a IS NULL, NULL, xxhash64(a)), xxhash64(b)) AS h").collect()
    hashes = {(r.a, r.b): r.h for r in rolled}
    assert got == brute.without_repeats(zip(docs.doc_id, docs.text), lambda a, b: hashes[a, b])
    assert sum(removed for _, removed in got.values()) > 0


def test_token_counts(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in result(spark, "op5_token_counts").itertuples()}
    counts = {i: len(model.encode(t, add_special_tokens=False).ids) for i, t in zip(docs.doc_id, docs.text)}
    assert got == {i: (len(t.encode()), counts[i], counts[i] > 2048) for i, t in zip(docs.doc_id, docs.text)}


def test_source_mixture(spark, docs):
    got = result(spark, "op6_source_mixture")
    sizes = {i: len(brute.words(t)) for i, t in zip(docs.doc_id, docs.text)}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    totals = docs.assign(size=docs.doc_id.map(sizes)).groupby("source")["size"].sum().to_dict()
    wanted = brute.targets(totals)
    source = dict(zip(docs.doc_id, docs.source))
    for row in got.itertuples():
        assert row.source_size == totals[source[row.doc_id]]
        assert row.target == pytest.approx(wanted[source[row.doc_id]])
        assert 0 <= row.taken <= 2 * row.size and (row.size == 0 or row.taken % row.size == 0)
    got["source"] = got.doc_id.map(source)
    for name, part in got.groupby("source"):
        assert abs(part.taken.sum() - wanted[name]) <= part["size"].max()


def test_secret_scan(spark, docs):
    for row in result(spark, "op7_secret_scan").itertuples():
        text = docs.text[docs.doc_id == row.doc_id].iloc[0]
        base = brute.secrets(text)
        joined = ",".join(f"{kind}:{start}:{stop}" for kind, start, stop in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex"))
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


def test_benchmark_decontamination(spark, docs):
    bench = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    items = list(zip(bench.item_id, bench.text))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in result(spark, "op8_benchmark_decontamination").itertuples()}
    assert got == {i: brute.contamination(t, items) for i, t in zip(docs.doc_id, docs.text)}
    assert any(row[4] for row in got.values())


def test_near_duplicates(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, "op9_near_duplicates").itertuples()}
    assert got == brute.near_duplicates(zip(docs.doc_id, docs.text), 2)


@pytest.mark.parametrize(("name", "label", "limit"), [("op2_quality_classifier", "quality", 0.97), ("op10_toxicity", "toxic", 0.88)])
def test_held_out_accuracy(spark, name, label, limit):
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    scores = QUERIES[name](spark, "/root/testdata/sf0.01").toPandas().merge(labels, on="doc_id")
    assert scores.score.between(0, 1).all() and (scores.predicted == (scores.score >= (0.7 if label == "quality" else 0.3))).all()
    held = scores[scores.held_out]
    assert (held.predicted == held[label]).mean() >= limit


def test_chat_formatting(spark):
    turns = pd.read_parquet(f"{SF_DIR}/conversations.parquet")
    got = result(spark, "op3_chat_formatting")
    want = {}
    for conv, part in turns.groupby("conv_id"):
        for speaker in set(part.role) - {"system"}:
            text, mask = "", []
            for row in part.sort_values(["turn", "role", "text"]).itertuples():
                name = "system" if row.role == "system" else "assistant" if row.role == speaker else f"user name={row.role}"
                text += f"<|{name}|>\n"
                if row.role == speaker:
                    mask.append(f"{len(text)}:{len(text) + len(row.text)}")
                text += row.text + "\n<|end|>\n"
            want[conv, speaker] = (text, ",".join(mask), len(part))
    assert {(r.conv_id, r.perspective): (r.text, r.mask, r.n_turns) for r in got.itertuples()} == want


def test_merkle_manifest(spark, docs):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = result(spark, "op11_merkle_manifest")
    rows = zip(docs.doc_id, docs.source, docs.lang, docs.n_chars, docs.text)
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(brute.merkle(rows))
    assert 0 < got.verified.sum() < len(got)


def test_fill_in_middle(spark, docs):
    forms = set()
    for row in result(spark, "op12_fill_in_middle").itertuples():
        text = docs.text[docs.doc_id == row.doc_id].iloc[0]
        n, form, prefix, inner, output = brute.middle(row.doc_id, text)
        assert (row.n, row.form, row.output_sha256, row.restored_sha256) == (n, form, brute.sha(output), brute.sha(text))
        assert (prefix is None and pd.isna(row.prefix_chars)) or (row.prefix_chars, row.middle_chars) == (prefix, inner)
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_personal_data(spark, docs):
    some = 0
    for row in result(spark, "op13_personal_data").itertuples():
        base = brute.personal(docs.text[docs.doc_id == row.doc_id].iloc[0])
        joined = [f"{kind}:{start}:{stop}" for kind, start, stop in base]
        assert row.base_sha256 == brute.sha(",".join(joined))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in ("email", "ip", "card", "phone")]
        assert set(joined) <= set(row.spans.split(","))
        some += bool(base)
    assert some > 5


def test_pipeline(spark, docs):
    import corpus_pipeline

    bench = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    items = list(zip(bench.item_id, bench.text))
    current = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = current.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        current = corpus_pipeline.materialize(stage(spark, current, SF_DIR), "test-stage")
        kept[name] = current.toPandas()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == columns
    scores = result(spark, "op2_quality_classifier")
    assert set(kept["quality"].doc_id) == set(scores[scores.predicted == 1].doc_id)
    before = kept["repeated_lines"]
    components = brute.near_duplicates(zip(before.doc_id, before.text), 5)
    assert set(kept["near_duplicates"].doc_id) == {i for i, (_, component) in components.items() if i == component}
    before = kept["near_duplicates"]
    clean = {i for i, t in zip(before.doc_id, before.text) if not brute.contamination(t, items)[4]}
    assert set(kept["benchmark_passages"].doc_id) == clean
    mixed, before = kept["mixture"], kept["benchmark_passages"]
    assert set(mixed.doc_id) <= clean and mixed.groupby("doc_id").size().max() <= 2
    sizes = before.assign(size=[len(brute.words(t)) for t in before.text]).groupby("source")["size"]
    wanted = brute.targets(sizes.sum().to_dict())
    for source, part in mixed.groupby("source"):
        assert abs(part["size"].sum() - wanted[source]) <= sizes.max()[source]
    assert entry.queries()["pipeline"](spark, SF_DIR).count() == len(mixed)
