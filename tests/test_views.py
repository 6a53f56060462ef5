"""The document counts that the training queries read."""

import re

import pytest

from sieveline.catalog import views

TEXTS = {1: "one two two 3.", 2: "", 3: None, 4: "a\tb\n\n a1!", 5: "no label", None: "no id"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("docs"))
    docs = [*TEXTS.items(), (4, "a second text of 4?")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 1), (9, 1), (None, 0)], "doc_id long, quality int").write.parquet(f"{place}/labels.parquet")
    return place


def test_counts_of_labelled_documents(spark, folder):
    rows = views.docfeat(spark, folder).collect()
    found = sorted((r["id"], r["n_chars"], r["n_words"], r["n_distinct_words"], r["n_digits"], r["n_punct"], r["target"]) for r in rows if r["id"] != 3)

    def counts(text):
        words = text.split()
        return len(text), len(words), len(set(words)), len(re.findall("[0-9]", text)), len(re.findall("[.,;:!?]", text))

    pairs = [(1, TEXTS[1], 1), (2, "", 0)] + [(4, t, q) for t in (TEXTS[4], "a second text of 4?") for q in (0, 1)]
    assert found == sorted((i, *counts(t), q) for i, t, q in pairs)
    assert [r["target"] for r in rows if r["id"] == 3] == [1]
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)


def test_texts_of_one_row_group_are_dealt_over_the_tasks(spark, folder, monkeypatch, plan_of):
    plans = []
    original = views.written
    monkeypatch.setattr(views, "written", lambda df, name: plans.append(plan_of(df)) or original(df, name))
    views.docfeat(spark, folder)
    count = plans[0].index("regexp_extract_all")
    dealt = plans[0].index("REPARTITION_BY_COL", count)
    # labelled documents alone are dealt: the semi join is below
    assert plans[0].index("LeftSemi", dealt) > dealt
