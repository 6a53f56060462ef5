"""Column expressions: hashing, safe casts, ratios and labels. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

HASH_SPACE = 10_000


def hash_bucket(keys: list[str], seed: int, buckets: int = HASH_SPACE) -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key and the seed alone.

    The first 32 bits of an MD5 digest are used, so a row keeps its bucket whatever the partition
    layout, engine or retry, which ``rand`` and ``randomSplit`` do not promise.
    """
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)


def to_int(column: Column) -> Column:
    """Text or number to INT, null where it cannot be read; a fraction is cut off (``12.5`` is 12)."""
    return F.coalesce(column.try_cast("int"), column.try_cast("double").try_cast("int"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives null, not an error, for an empty denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def binary_label(column: Column, negative_value) -> Column:
    """0 where the column equals ``negative_value``, 1 everywhere else (nulls included)."""
    return F.when(column == F.lit(negative_value), F.lit(0)).otherwise(F.lit(1))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_observed(column: Column, numeric: bool = True) -> Column:
    """Neither null nor NaN."""
    seen = column.isNotNull()
    return seen & ~F.isnan(column.cast("double")) if numeric else seen


def tie_key(df: DataFrame, id: str) -> Column:
    """What orders rows of equal score: a numeric id itself, a 64-bit hash of any other id.

    Decimals of up to 18 digits are ordered exactly as their unscaled integers; wider ones, like text, by the hash, where
    ids that collide share a place and are not split.
    """
    kind = df.schema[id].dataType
    if isinstance(kind, DecimalType):
        if kind.precision > 18:
            return F.xxhash64(F.col(id))
        return (F.col(id) * F.lit(10**kind.scale)).cast("bigint") if kind.scale else F.col(id).cast("bigint")
    return F.col(id) if isinstance(kind, NumericType) else F.xxhash64(F.col(id))
