"""Assigning values to ordered buckets by split points."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_buckets(df: DataFrame, splits: dict[str, tuple[str, list[float]]]) -> DataFrame:
    """Add one bucket column per entry ``{output: (double column, ascending split points)}``.

    The bucket is the number of split points at or below the value: a pure function of the value,
    found by binary search inside the JVM, so ties share a bucket and a recomputed task agrees with
    the first run. Null stays null.
    """
    cut = {out: spec for out, spec in splits.items() if spec[1]}
    whole = {out: F.when(F.col(splits[out][0]).isNotNull(), F.lit(0)) for out in splits if out not in cut}
    if whole:
        df = df.withColumns(whole)
    if not cut:
        return df
    return Bucketizer(
        inputCols=[source for source, _ in cut.values()],
        outputCols=list(cut),
        splitsArray=[[-math.inf, *points, math.inf] for _, points in cut.values()],
        handleInvalid="keep",
    ).transform(df)
