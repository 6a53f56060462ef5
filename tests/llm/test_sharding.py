"""Shards: contiguous in the order, near-equal bytes, gapless slots."""

from pyspark.sql import functions as F

from sieveline.llm import sharding
from sieveline.llm.queries import op3_byte_shards
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def check(rows, shards):
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"])
    placed = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [key(r) for r in placed] == sorted(map(key, rows))  # shards and slots follow the order
    for k in range(shards):
        own = [r for r in placed if r["shard"] == k]
        assert [r["slot"] for r in own] == list(range(len(own)))
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for k in range(shards):
        assert abs(sum(r["size"] for r in rows if r["shard"] == k) - total / shards) <= largest


def test_documents(spark, sf_dir, texts):
    rows = op3_byte_shards(spark, sf_dir).collect()
    check(rows, 16)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (d, len(t.encode()) + 1, brute.crc(t)) for d, t in texts.items()
    }
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_awkward_rows(awkward):
    rows = sharding.shard_documents(awkward, 5).collect()
    check(rows, 5)
    expected = sorted((len((r[1] or "").encode()) + 1, brute.crc(r[1])) for r in AWKWARD)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == expected


def test_one_key_for_most_rows(spark):
    docs = spark.range(3000).select(F.when(F.col("id") > 900, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    check(sharding.shard_documents(docs.repartition(6), 16).collect(), 16)


def test_fewer_rows_than_shards_and_none(spark, no_docs):
    assert len(sharding.shard_documents(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")).collect()) == 2
    assert sharding.shard_documents(no_docs).collect() == []


def test_running_totals(spark):
    rows = spark.range(2000).select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("k"), (F.col("id") % 9 + 1).alias("n")).withColumn("start", F.lit("kept away"))
    run = sharding.running_totals(rows.drop("start"), ["k"], "n").collect()
    ordered = sorted(run, key=lambda r: r["position"])
    assert [r["position"] for r in ordered] == list(range(2000))
    assert [r["k"] for r in ordered] == sorted(r["k"] for r in run)
    total = 0
    for r in ordered:
        assert r["start"] == total
        total += r["n"]
