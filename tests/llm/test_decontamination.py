"""Benchmark windows in documents against a scan of all windows."""

import pytest
from pyspark.sql import functions as F

from sieveline.llm import decontamination as d
from sieveline.llm.queries import op10_decontamination
from tests.llm import brute
from tests.llm.conftest import AWKWARD, PASSAGE


def test_documents(spark, sf_dir, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.contamination(texts.items(), items)
    rows = op10_decontamination(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected


@pytest.mark.parametrize("block_chars", [d.BLOCK_CHARS, 150])
def test_awkward_rows(spark, awkward, block_chars):
    items = [
        (1, " ".join(PASSAGE.split()[3:15])),
        (2, "One, two!"),
        (3, None),
        (4, ""),
        (5, "..."),
        (None, "no id here but words enough to be a document"),
        (6, PASSAGE),
        (6, PASSAGE),
        (7, "ünï"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.find_benchmark(awkward.withColumn("items", F.lit("clash")), benchmark, block_chars=block_chars).collect()
    assert len(found) == len(AWKWARD)
    known = [(i, t) for i, t in items if i is not None]
    for row in found:
        n, _, _, _, _ = brute.contamination([(0, row["text"])], items)[0]
        _, _, _, digest, _ = brute.contamination([(0, row["text"])], known)[0]
        hit = brute.contamination([(0, row["text"])], [(0, t) for _, t in items])[0][1]
        assert (row["n_words"], row["n_hit"], brute.sha(row["items"])) == (n, hit, digest)
        marked = [w for s in row["spans"] for w in brute.ITEM_WORDS.findall(brute.lower_ascii(row["text"][s["start"] : s["end"]]))]
        assert len(marked) == hit


def test_offsets_are_those_of_the_original():
    text = "É \U0001f600 Foo-BAR, baz"
    assert [text[a:b] for a, b in d.word_offsets(text)] == ["É", "\U0001f600", "Foo", "BAR", "baz"]


def test_empty(spark, no_docs, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find_benchmark(no_docs, none).collect() == []
    assert {r["n_hit"] for r in d.find_benchmark(awkward, none).collect()} == {0}


def test_no_shuffle(spark, documents, plan_of):
    assert "Exchange" not in plan_of(d.find_benchmark(documents, spark.createDataFrame([(1, "a b")], "item_id long, text string")))
