"""Running totals over a globally ordered column, spread over many tasks.

A window with an order but no partition key runs in one task. Here the ordered axis is cut at sampled
points: each piece runs its own window, and the totals of the pieces before it are joined on.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.buckets import with_buckets
from sieveline.functions.expressions import is_observed

PIECE_ROWS = 1_000_000
DRAWS_PER_PIECE = 20


def split_points(df: DataFrame, column: str, piece_rows: int = PIECE_ROWS, seed: int = 0) -> list[float]:
    """Points that cut the column into pieces of about ``piece_rows`` rows, ties kept together.

    The sample holds :data:`DRAWS_PER_PIECE` values per piece, so a piece stays small whatever the number of rows;
    at 10^12 rows and the default size there are 10^6 pieces. Raise ``piece_rows`` for fewer.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(is_observed(F.col("v")))
    rows = values.count()
    pieces = rows // piece_rows
    if pieces < 2:
        return []
    fraction = min(1.0, DRAWS_PER_PIECE * pieces / rows)
    drawn = sorted(r["v"] for r in values.sample(fraction=fraction, seed=seed).collect())
    points = {drawn[i * len(drawn) // pieces] for i in range(1, pieces)} if drawn else set()
    return sorted(p for p in points if abs(p) != float("inf"))


def running_totals(
    df: DataFrame,
    order: str,
    values: list[str],
    by: list[str],
    points: list[float],
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum along ``order`` within ``by``) and ``total_<v>``.

    ``order`` must be unique within ``by``: aggregate ties first, which also removes their skew. The
    offsets are joined by the keys of the window, so that the rows already lie where they are needed.
    Null-safe keys keep a set without name, and keep Spark from adding null filters to one side only,
    after which the two sides could no longer share the shuffle of ``df``.
    """
    pieces = with_buckets(
        df.withColumn("_axis", F.col(order).cast("double") + F.lit(0.0)), {"_piece": ("_axis", points)}
    ).drop("_axis").withColumn("_piece", F.col("_piece").cast("int"))
    direction = F.desc if descending else F.asc
    sums = pieces.groupBy(*by, "_piece").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    # one row per piece and group: small enough to order in one task
    before = Window.partitionBy(*by).orderBy(direction("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    keys = [*by, "_piece"]
    offsets = sums.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_offset_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(everything).alias(f"total_{v}") for v in values],
    )
    inside = (
        Window.partitionBy(*by, "_piece").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = pieces.withColumns({f"_local_{v}": F.sum(v).over(inside) for v in values})
    joined = local.join(offsets, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys]))
    return joined.select(
        *df.columns,
        *[(F.col(f"_offset_{v}") + F.col(f"_local_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"total_{v}") for v in values],
    )
