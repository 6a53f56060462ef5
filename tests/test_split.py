import hashlib

import pytest

from sieveline.operators.split import assign_folds, hash_split, random_split, three_way_split


def bucket(key, seed, n=10_000):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:8], 16) % n


def test_hash_split_is_a_function_of_the_key(spark):
    df = hash_split(spark.range(500), "id", seed=7)
    expected = {i: "train" if bucket(i, 7) < 8000 else "test" for i in range(500)}
    assert {r["id"]: r["split"] for r in df.collect()} == expected
    again = hash_split(spark.range(500).repartition(7), "id", seed=7)
    assert {r["id"]: r["split"] for r in again.collect()} == expected


def test_hash_split_of_several_sets(spark):
    df = hash_split(spark.range(4000), "id", (0.5, 0.3, 0.2), ("a", "b", "c"))
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(counts.values()) == 4000
    assert abs(counts["a"] - 2000) < 150 and abs(counts["b"] - 1200) < 150


def test_three_way_split(spark):
    df = three_way_split(spark.range(1000), "id")
    for row in df.collect():
        i = row["id"]
        expected = "test" if bucket(i, 42) < 1000 else "val" if bucket(i, 666) < 1000 else "train"
        assert row["split"] == expected


def test_folds(spark):
    rows = assign_folds(spark.range(300), ["id"], 4, seed=1).collect()
    assert {r["id"]: r["fold"] for r in rows} == {i: bucket(i, 1, 4) for i in range(300)}


def test_random_split_keeps_all_rows(spark):
    parts = random_split(spark.range(100), [0.8, 0.2], 1)
    assert sum(p.count() for p in parts) == 100


def test_splits_shuffle_nothing(spark, plan_of):
    assert "Exchange" not in plan_of(three_way_split(spark.range(10), "id"))


def test_bad_arguments(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        hash_split(df, "id", (0.5, 0.6))
    with pytest.raises(ValueError):
        hash_split(df, "id", (0.5, 0.5), ("one",))
    with pytest.raises(ValueError):
        three_way_split(df, "id", test=1.0)
    with pytest.raises(ValueError):
        assign_folds(df, "id", 1)
