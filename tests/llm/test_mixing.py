"""Mixing: exact targets, whole copies, words near the target, reruns alike."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sieveline.llm import mixing
from sieveline.llm.queries import op1_pareto_mix
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def by_source(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    return groups


def check(rows, texts_by_row):
    sizes = {s: sum(r["size"] for r in g) for s, g in by_source(rows).items()}
    expected = brute.targets(sizes)
    assert Counter(r["size"] for r in rows) == Counter(len(brute.words(t)) for t in texts_by_row)
    for source, group in by_source(rows).items():
        assert {r["source_size"] for r in group} == {sizes[source]}
        assert {r["target"] for r in group} == {expected[source]}
        assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in group)
        # repeated rows are taken alike, so the cut may miss by half of all rows that tie
        ties = Counter((r["doc_id"], r["size"]) for r in group)
        most = max(r["size"] * ties[r["doc_id"], r["size"]] for r in group)
        assert abs(sum(r["taken"] for r in group) - expected[source]) <= most / 2 + 1e-6


def test_documents(spark, sf_dir, texts):
    rows = op1_pareto_mix(spark, sf_dir).collect()
    named = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    check(named, list(texts.values()))
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in named)


def test_awkward_rows(awkward):
    check(mixing.mix(awkward).collect(), [r[1] for r in AWKWARD])


def test_stopped_targets_and_whole_copies(spark):
    docs = spark.createDataFrame(
        [(k, "w " * (1 + k % 7), "big" if k < 400 else f"s{k % 3}") for k in range(460)], "doc_id long, text string, source string"
    )
    rows = mixing.mix(docs).collect()
    check(rows, ["w " * (1 + k % 7) for k in range(460)])
    sizes = {s: sum(r["size"] for r in g) for s, g in by_source(rows).items()}
    stopped = [g for s, g in by_source(rows).items() if g[0]["target"] == 3 * sizes[s]]
    assert stopped and all(r["copies"] == 3 for g in stopped for r in g)


def test_long_documents_are_likelier(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.repeat(F.lit("w "), 1000)).otherwise("w").alias("text"), (F.col("id") % 10 < 5).cast("string").alias("source")
    )
    rows = [r for r in mixing.mix(docs).collect() if r["target"] < r["source_size"]]
    share = {n: sum(r["copies"] for r in rows if r["size"] == n) / sum(r["size"] == n for r in rows) for n in (1, 1000)}
    assert share[1000] > share[1]


def test_bins_do_not_decide(documents, monkeypatch):
    fine = {(r["doc_id"], r["copies"]) for r in mixing.mix(documents).collect()}
    monkeypatch.setattr(mixing, "BINS", 4)
    assert {(r["doc_id"], r["copies"]) for r in mixing.mix(documents.repartition(5)).collect()} == fine


def test_copies_of_rows(awkward):
    copies = Counter()
    for r in mixing.mix(awkward).collect():
        copies[r["doc_id"]] += r["copies"]
    rows = mixing.mixed_documents(awkward)
    assert rows.columns == awkward.columns
    assert Counter(r["doc_id"] for r in rows.collect()) == Counter({k: n for k, n in copies.items() if n})
    clashing = awkward.withColumns({"target": F.lit("t"), "_size": F.lit("s"), "copies": F.lit("c")})
    assert {(r["target"], r["_size"], r["copies"]) for r in mixing.mixed_documents(clashing).collect()} == {("t", "s", "c")}


def test_empty(no_docs):
    assert mixing.mix(no_docs).collect() == []
    assert mixing.mixed_documents(no_docs).collect() == []


def test_only_built_ins(documents, plan_of):
    assert "Python" not in plan_of(mixing.mix(documents)) and "Arrow" not in plan_of(mixing.mix(documents))


def test_bad_tilt(no_docs):
    with pytest.raises(ValueError, match="tilt"):
        mixing.mix(no_docs, tilt=2)
