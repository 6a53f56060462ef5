"""Seeded splits and folds.

The default splits are pure functions of a row key: the same row lands in the same set after a
repartition, a retry or an append, and no shuffle is needed to compute them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.expressions import HASH_SPACE, hash_bucket


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _cut_points(fractions: list[float]) -> list[int]:
    if not fractions or min(fractions) <= 0 or abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must be positive and sum to 1")
    total, cuts = 0.0, []
    for fraction in fractions:
        total += fraction
        cuts.append(round(total * HASH_SPACE))
    return cuts


def hash_split(
    df: DataFrame,
    key: str | list[str],
    fractions: tuple[float, ...] = (0.8, 0.2),
    names: tuple[str, ...] = ("train", "test"),
    seed: int = 0,
    output: str = "split",
) -> DataFrame:
    """Label each row with the set it belongs to."""
    if len(names) != len(fractions):
        raise ValueError("one name per fraction")
    bucket = hash_bucket(_keys(key), seed)
    label: Column = F.lit(names[-1])
    for name, cut in reversed(list(zip(names[:-1], _cut_points(list(fractions))))):
        label = F.when(bucket < cut, F.lit(name)).otherwise(label)
    return df.withColumn(output, label)


def three_way_split(
    df: DataFrame,
    key: str | list[str],
    test: float = 0.1,
    validation: float = 0.1,
    test_seed: int = 42,
    validation_seed: int = 666,
    output: str = "split",
) -> DataFrame:
    """Hold out ``test`` of all rows, then ``validation`` of the rest: 0.81 / 0.09 / 0.10 by default."""
    keys = _keys(key)
    for share in (test, validation):
        _cut_points([share, 1.0 - share])
    label = (
        F.when(hash_bucket(keys, test_seed) < round(test * HASH_SPACE), F.lit("test"))
        .when(hash_bucket(keys, validation_seed) < round(validation * HASH_SPACE), F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return df.withColumn(output, label)


def assign_folds(
    df: DataFrame, key: str | list[str], k: int = 5, seed: int = 0, output: str = "fold"
) -> DataFrame:
    """Fold number 0 .. k-1 for cross-validation."""
    if k < 2:
        raise ValueError("cross-validation needs at least two folds")
    return df.withColumn(output, hash_bucket(_keys(key), seed, k).cast("int"))


def random_split(df: DataFrame, fractions: list[float], seed: int) -> list[DataFrame]:
    """Spark's own row-wise random split.

    Its sets depend on the partition layout as well as on the seed; use :func:`hash_split` where a
    row must stay in its set.
    """
    return df.randomSplit(fractions, seed=seed)
