"""The pipeline against its stages done by brute force, on the whole small table."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from sieveline.sources.scratch import recorded, written
from tests.llm import brute
from tests.llm.test_sharding import check


@pytest.fixture(scope="module")
def outputs(spark, sf_dir, documents):
    docs, made = documents, []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        made.append(docs)
    return made


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_stages_keep_the_columns(outputs, documents):
    assert all(df.columns == documents.columns for df in outputs[:-1])


def test_language_stage_keeps_documents_in_a_language(outputs, documents, texts):
    kept = set(ids(outputs[0]))
    assert kept <= set(texts)
    assert len(kept) >= 0.99 * sum(any(c.isalpha() for c in t or "") for t in texts.values())


def test_similarity_stage_keeps_one_of_each_group(outputs, texts):
    before = ids(outputs[0])
    components = brute.components((d, texts[d]) for d in before)
    assert sorted(ids(outputs[1])) == sorted({c for _, c in components.values()})


def test_benchmark_stage_drops_contaminated_documents(spark, sf_dir, outputs, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contamination(((d, texts[d]) for d in ids(outputs[1])), items)
    assert sorted(ids(outputs[2])) == sorted(d for d, r in found.items() if not r[-1])


def test_mixture_stage_meets_the_targets(outputs):
    rows = outputs[2].select("doc_id", "text", "source").collect()
    sizes, largest = Counter(), Counter()
    for r in rows:
        n = len(brute.words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    taken = Counter()
    for r in outputs[3].select("text", "source").collect():
        taken[r["source"]] += len(brute.words(r["text"]))
    for source, target in brute.targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6
    assert max(Counter(ids(outputs[3])).values()) <= 3


def test_shards_of_the_mix(outputs):
    rows = outputs[4].collect()
    check(rows, 16)
    assert Counter(r["doc_id"] for r in rows) == Counter(ids(outputs[3]))


def test_run_is_the_registered_query(spark, sf_dir, outputs):
    assert queries()["pipeline"] is corpus_pipeline.run
    run = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, run.collect())) == Counter(map(tuple, outputs[-1].collect()))


def test_run_leaves_nothing_of_its_first_stages(spark, sf_dir):
    with recorded() as made:
        corpus_pipeline.run(spark, sf_dir)
    left = [p for p in made if os.path.exists(p)]
    assert made and all(any(f"/{name}-" in p for name in ("source_mixture", "ranges")) for p in left), left
