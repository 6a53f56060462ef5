"""Quality rules against plain Python, and the plan they compile to."""

import hashlib

from pyspark.sql import functions as F

from sieveline.llm import quality_rules
from sieveline.llm.queries import op9_quality_rules
from tests.llm import brute
from tests.llm.conftest import AWKWARD

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_documents(spark, sf_dir, texts):
    rows = op9_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[c] for c in BASE) == brute.quality(texts[row["doc_id"]])
        assert not (row["base_failed"] and row["kept"])


def test_awkward_rows(awkward):
    keyed = awkward.withColumn("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn("n_words", F.lit("clash"))
    texts = {hashlib.sha256((r[1] or "").encode()).hexdigest(): r[1] for r in AWKWARD}
    rows = quality_rules.judge(keyed).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        assert tuple(row[c] for c in BASE) == brute.quality(texts[row["doc_id"]])


def test_verdict_follows_labels(spark, sf_dir):
    judged = op9_quality_rules(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("not base_failed")
    rows = judged.select("kept", "quality").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def test_thresholds_are_inclusive(spark):
    docs = spark.createDataFrame([(1, "the " * 1 + " ".join(f"w{k}x" for k in range(9)))], "doc_id long, text string")
    kept = lambda *rules: quality_rules.judge(docs, rules).first()["kept"]
    assert kept(quality_rules.Rule("n_words", 10, 10))
    assert not kept(quality_rules.Rule("n_words", 11))
    assert not kept(quality_rules.Rule("stop_word_ratio", None, 0.05))
    assert kept()


def test_one_projection_of_built_ins(documents, plan_of):
    plan = plan_of(quality_rules.judge(documents))
    assert not any(word in plan for word in ("Exchange", "Python", "Arrow", "Generate"))


def test_empty(no_docs):
    assert quality_rules.judge(no_docs).collect() == []
