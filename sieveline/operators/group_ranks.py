"""Exact order statistics of any number of groups side by side; brackets and answers are tables keyed by group.

The driver sees no group. Rows are touched a fixed number of times whatever the number of groups: a row finds the bracket it falls
into by binary search in the sampled points of its group, which a join puts beside it.

1. groups with more than ``bracket_rows`` rows are cut at points drawn from them, each point a bracket of its own;
2. rows and weight are counted per bracket (map-side combine), and the targets of a group fall into brackets by running weight;
3. a bracket with one value is an answer; rows of the other brackets that a target fell into are kept and cut again, if there
   are still many;
4. what is left holds few rows per group or bracket: its values are counted and ordered, one window per group.

A hot group is cut like any other: its rows are not gathered before they are narrowed down, and a value that most of its rows share is
counted, not ordered. The draw only steers the search; counts decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.operators.ranks import BRACKET_ROWS, MAX_POINTS, SAMPLED_POINTS
from sieveline.sources.scratch import discard, written

POSITION = ["t", "value", "below", "at", "rows"]


def leading(items: Column, holds, most: int) -> Column:
    """How many items at the start of an array meet a condition that no later one meets again: binary search, null items end it.

    ``most`` bounds the length of the array.
    """
    steps = [1 << k for k in reversed(range(max(1, most).bit_length()))]
    found = lambda place: F.coalesce(holds(F.get(items, place)), F.lit(False))
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: at + F.when(found(at + step - 1), step).otherwise(F.lit(0))
    )


def _slot(value: Column, points: Column, most: int) -> Column:
    """2 i strictly between points i - 1 and i, 2 i - 1 at point i - 1; 0 where there are no points."""
    reached = leading(points, lambda p: p.isNotNull() & (p <= value), most)
    at_point = F.coalesce(F.get(points, reached - 1) == value, F.lit(False))
    return F.when(points.isNull(), F.lit(0)).otherwise(2 * reached - at_point.cast("int"))


def _answers(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Per target the first row of ``values`` (keys, v, rows, weight), in order of v, whose running weight reaches it.

    The ends are open, so that rounding of fractional weights loses no target.
    """
    order = Window.partitionBy(*keys).orderBy("v")
    running = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
    before = running - F.col("weight")
    ranked = values.select(
        "*",
        before.alias("_before"),
        F.when(F.row_number().over(order) == 1, F.lit(float("-inf"))).otherwise(before).alias("_after"),
        F.when(F.lead("v").over(order).isNull(), F.lit(float("inf"))).otherwise(running).alias("_until"),
    )
    asked = targets.groupBy(*keys).agg(F.collect_list(F.struct("t", "rest", "offset")).alias("_asked"))
    here = F.filter("_asked", lambda x: (x["rest"] > F.col("_after")) & (x["rest"] <= F.col("_until")))
    return ranked.join(asked, keys).withColumn("_hit", F.explode(here))


def locate_in_groups(
    rows: DataFrame, targets: DataFrame, keys: list[str], sizes: DataFrame, bracket_rows: int = BRACKET_ROWS, seed: int = 0
) -> DataFrame:
    """(keys, t, value, below, at, rows): per group and target ``t``, the first value whose cumulative weight reaches ``t``.

    ``rows`` has the keys, ``v`` and ``w``, none of them null; ``targets`` the keys and ``t``, each once; ``sizes`` the keys and ``n``, the
    rows of a group. ``below`` is the weight of all lower values, ``at`` and ``rows`` what lies at the value. Groups without
    rows have no answers. The result is a stored table. ``rows`` is read once where all groups are small, else several times.
    """
    place = [*keys, "_at"]
    rows = rows.select(*keys, F.lit("").alias("_at"), "v", "w")
    targets = targets.select(*keys, F.lit("").alias("_at"), "t", F.col("t").cast("double").alias("rest"), F.lit(0.0).alias("offset"))
    wide = sizes.where(F.col("n") > bracket_rows).select(*keys, F.lit("").alias("_at"), "n")
    answers, stages = [], []
    while groups := wide.count():
        wanted = max(16, min(SAMPLED_POINTS, MAX_POINTS // groups))
        # groups with few rows are ordered as they are
        answers.append(_finish(rows.join(wide, place, "left_anti"), targets.join(wide, place, "left_anti"), place, keys))
        drawn = rows.join(wide, place).where(F.rand(seed) * F.col("n") < wanted)
        points = written(drawn.groupBy(*place).agg(F.array_sort(F.collect_set("v")).alias("_points")), "points")
        most = points.agg(F.max(F.size("_points")).alias("n")).first()["n"] or 1
        inside = rows.join(wide.drop("n"), place, "left_semi").join(points, place, "left")
        slotted = inside.withColumn("_slot", _slot(F.col("v"), F.col("_points"), most)).drop("_points")
        counted = slotted.groupBy(*place, "_slot").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("w").alias("weight"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        hits = written(_answers(counted.withColumnRenamed("_slot", "v"), targets.join(wide.drop("n"), place, "left_semi"), place), "hits")
        single = hits.where(F.col("low") == F.col("high"))
        answers.append(_positions(single, keys, F.col("low")))
        further = F.concat_ws(".", "_at", F.col("v").cast("string"))
        left = hits.where(F.col("low") < F.col("high"))
        targets = left.select(
            *keys,
            further.alias("_at"),
            F.col("_hit.t").alias("t"),
            (F.col("_hit.rest") - F.col("_before")).alias("rest"),
            (F.col("_hit.offset") + F.col("_before")).alias("offset"),
        )
        brackets = left.select(*place, F.col("v").alias("_slot"), "rows").distinct()
        kept = slotted.join(brackets.drop("rows"), [*place, "_slot"], "left_semi")
        rows = written(kept.select(*keys, F.concat_ws(".", "_at", F.col("_slot").cast("string")).alias("_at"), "v", "w"), "narrowed")
        found = brackets.select(*keys, F.concat_ws(".", "_at", F.col("_slot").cast("string")).alias("_at"), F.col("rows").alias("n"))
        wide = written(found.where(F.col("n") > bracket_rows), "wide")
        stages += [points, wide, hits, rows]
        seed += 1
    answers.append(_finish(rows, targets, place, keys))
    out = answers[0]
    for a in answers[1:]:
        out = out.unionByName(a)
    out = written(out, "positions")
    discard(*stages)
    return out


def _positions(hits: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return hits.select(
        *keys,
        F.col("_hit.t").alias("t"),
        value.alias("value"),
        (F.col("_hit.offset") + F.col("_before")).alias("below"),
        F.col("weight").cast("double").alias("at"),
        "rows",
    )


def _finish(rows: DataFrame, targets: DataFrame, place: list[str], keys: list[str]) -> DataFrame:
    """Count the values of groups or brackets with few rows, order them, and read the answers off."""
    values = rows.groupBy(*place, "v").agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("weight"))
    return _positions(_answers(values, targets, place), keys, F.col("v"))
