"""Every pipeline stage on awkward rows, on an empty table, and beside columns with the names that operators use."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from sieveline.sources.scratch import recorded, written
from tests.llm.conftest import AWKWARD, row

CLASHING = [
    *("score", "lang_pred", "n_words", "n_hit", "items", "spans", "key", "root", "place", "stays", "sketch", "leader"),
    *("size", "target", "copies", "taken", "_size", "_key", "_source", "plan_source", "_row", "_own", "shard", "slot"),
]
FILTERS = STAGES[:-1]


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


@pytest.mark.parametrize("name,stage", FILTERS, ids=[n for n, _ in FILTERS])
def test_columns_keep_their_names_and_values(spark, sf_dir, awkward, documents, name, stage):
    # documents are there so that a language can be learned
    docs = written(awkward.unionByName(documents.limit(60)), "docs")
    clashing = written(docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING}), "docs")
    plain, found = stage(spark, docs, sf_dir), stage(spark, clashing, sf_dir)
    assert plain.columns == docs.columns and found.columns == clashing.columns
    rows = found.collect()
    given = {(r["doc_id"], r["text"], r["source"]): r.asDict() for r in clashing.collect()}
    assert rows and all(r.asDict() == given[r["doc_id"], r["text"], r["source"]] for r in rows)
    assert Counter(r["doc_id"] for r in rows) == ids(plain)


@pytest.mark.parametrize("name,stage", STAGES, ids=[n for n, _ in STAGES])
def test_empty_table(spark, sf_dir, no_docs, name, stage):
    assert stage(spark, written(no_docs, "docs"), sf_dir).collect() == []


def test_language_stage_rejects_texts_in_no_language(spark, sf_dir, awkward, documents):
    others = documents.withColumn("doc_id", F.col("doc_id") + 1_000)
    found = ids(STAGES[0][1](spark, written(awkward.unionByName(others), "docs"), sf_dir))
    assert not {3, 4, 5} & set(found)  # null, empty, blank
    assert found[2] in (0, 2) and found[None] == 2  # repeated rows stay or go together


def test_similarity_stage_keeps_documents_without_words(spark, sf_dir, awkward):
    found = ids(STAGES[1][1](spark, awkward, sf_dir))
    assert found[3] == found[4] == found[5] == found[1] == 1
    assert found[2] == 0 and found[None] == 1 and found[7] == found[8] == 1


def test_benchmark_stage_keeps_what_has_no_window(spark, sf_dir, awkward):
    found = ids(STAGES[2][1](spark, awkward, sf_dir))
    assert found == Counter(r[0] for r in AWKWARD)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 80").first()["text"]
    extra = spark.createDataFrame([row(77, f"before {item} after"), row(77, f"before {item} after")], awkward.schema)
    assert ids(STAGES[2][1](spark, awkward.unionByName(extra), sf_dir))[77] == 0


def test_mixture_stage_takes_up_to_three_copies(spark, sf_dir, awkward):
    found = ids(STAGES[3][1](spark, awkward, sf_dir))
    rows = Counter(r[0] for r in AWKWARD)
    assert found and all(n <= 3 * rows[d] for d, n in found.items())


def test_shards_of_awkward_rows(spark, sf_dir, awkward):
    rows = STAGES[4][1](spark, awkward, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in AWKWARD)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}


def test_scratch_paths_are_recorded(spark):
    with recorded() as outer:
        first = written(spark.range(3), "a")
        with recorded() as inner:
            second = written(spark.range(3), "b")
    written(spark.range(3), "c")
    assert outer == [first.scratch_path, second.scratch_path] and inner == [second.scratch_path]
