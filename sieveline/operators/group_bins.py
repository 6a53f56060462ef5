"""Equal-frequency score bins fitted per set, for any number of sets: the edges are a table keyed by set.

Applying joins the edges of its set to a row and counts those it has passed by binary search. Sets without a name are one set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sieveline.functions.expressions import is_observed, tie_key
from sieveline.operators.group_ranks import leading, locate_in_groups
from sieveline.sources.scratch import discard, written

SET, SCORE = "_set", "_score"
#: Sets with up to so many rows have their quantiles read off their values as one sorted array, from a single aggregate.
ARRAY_ROWS = 10_000


def set_key(by: str) -> Column:
    """The name of the set as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))


@dataclass(frozen=True)
class GroupedBins:
    """``edges`` has one row per set: its key, the rows that start a bin (score, and id where others share that score), whether such a row
    itself is in the upper bin, whether the first edge is the lowest value, and the number of filled bins."""

    score: str
    id: str | None
    by: str
    bins: int
    edges: DataFrame

    def apply(self, df: DataFrame, output: str = "bin") -> DataFrame:
        """Add the bin, 0 for the lowest scores; null for a row without score, or of a set without bins."""
        kept = [c for c in df.columns if c != output]
        key = F.lit(None) if self.id is None else tie_key(df, self.id)
        # the row as one column, so that its names cannot clash with those of the edges
        row = df.select(F.struct(*kept).alias("_row"), set_key(self.by).alias(SET), F.col(self.score).alias(SCORE), key.alias("_tie"))
        score, tie, closed = F.col(SCORE), F.col("_tie"), F.col("_closed")

        def passed(edge: Column) -> Column:
            same = F.when(edge["id"].isNull(), closed).when(closed, tie >= edge["id"]).otherwise(tie > edge["id"])
            return (score > edge["score"]) | ((score == edge["score"]) & same)

        total = leading(F.col("_edges"), passed, self.bins + 1)
        chosen = F.when(F.col("_from_values"), F.greatest(F.lit(0), total - 1)).otherwise(total)
        found = F.when(is_observed(score) & F.col("_edges").isNotNull(), chosen)
        return row.join(self.edges, SET, "left").select("_row.*", found.alias(output))


def _rows(df: DataFrame, score: str, by: str, weight: str | None = None, id: str | None = None) -> DataFrame:
    """(set, v, w) of the rows with a score, and what orders them where scores tie; whole numbers stay such, -0.0 is 0.0."""
    whole = isinstance(df.schema[score].dataType, IntegralType)
    value = F.col(score).cast("bigint") if whole else F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
    w = F.lit(1) if weight is None else F.col(weight)
    tie = [] if id is None else [tie_key(df, id).alias("tie")]
    return df.select(set_key(by).alias(SET), value.alias("v"), w.alias("w"), *tie).where("v is not null and w is not null")


def _quantile_ranks(totals: DataFrame, bins: int) -> DataFrame:
    """(set, k, low, high, share): the neighbour ranks of each quantile and the share of the way between them, in whole numbers."""
    at = f"(k * (n - 1) div {bins})"
    rest = f"(k * (n - 1) % {bins})"
    return totals.select(SET, "n", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("k")).selectExpr(
        SET, "k", f"double({at} + 1) as low", f"double({at} + 1 + int({rest} > 0)) as high", f"{rest} / {bins} as share"
    )


def _between(below: Column, above: Column, share: Column) -> Column:
    """The value that lies the share of the way between two neighbours."""
    gap = above - below
    return F.when(below == above, below).when(share < 0.5, below + gap * share).otherwise(above - gap * (1 - share))


def _located_quantiles(ranks: DataFrame, positions: DataFrame) -> DataFrame:
    """(set, quantiles): the quantiles and the last value at or below each, in order, from located ranks."""
    below = positions.select(SET, F.col("t").alias("low"), F.col("value").cast("double").alias("below"))
    above = positions.select(SET, F.col("t").alias("high"), F.col("value").cast("double").alias("above"))
    edge = _between(F.col("below"), F.col("above"), F.col("share"))
    return (
        ranks.join(below, [SET, "low"])
        .join(above, [SET, "high"])
        .groupBy(SET)
        .agg(F.array_sort(F.collect_list(F.struct("k", edge.alias("edge"), "below"))).alias("quantiles"))
    )


def _array_quantiles(rows: DataFrame, bins: int) -> DataFrame:
    """(set, quantiles) like those of :func:`_located_quantiles`, of sets with few rows, in one shuffle."""
    values = rows.groupBy(SET).agg(F.sort_array(F.collect_list(F.col("v").cast("double"))).alias("_values"))
    last = (F.size("_values") - 1).cast("bigint")

    def quantile(k: Column) -> Column:
        at = k.cast("bigint") * last
        place = F.floor((at - at % bins) / bins).cast("int")
        below = F.get("_values", place)
        above = F.get("_values", place + (at % bins > 0).cast("int"))
        return F.struct(k.alias("k"), _between(below, above, (at % bins) / bins).alias("edge"), below.alias("below"))

    return values.select(SET, F.transform(F.sequence(F.lit(0), F.lit(bins)), quantile).alias("quantiles"))


def _quantile_edges(listed: DataFrame) -> DataFrame:
    """Edges between interpolated quantiles, equal ones once, and how many of the bins hold rows."""

    def add(state: Column, q: Column) -> Column:
        size, last = F.size(state["edges"]), F.try_element_at(state["edges"], F.lit(-1))
        new = (size == 0) | (q["edge"] > last)
        # a bin holds rows if the last value at or below its upper edge lies above its lower edge
        fills = (size > 0) & (q["edge"] > last) & ((size == 1) | (q["below"] > last))
        return F.struct(
            F.when(new, F.concat(state["edges"], F.array(q["edge"]))).otherwise(state["edges"]).alias("edges"),
            (state["filled"] + F.coalesce(fills, F.lit(False)).cast("int")).alias("filled"),
        )

    start = F.struct(F.array().cast("array<double>").alias("edges"), F.lit(0).alias("filled"))
    return listed.select(SET, F.aggregate("quantiles", start, add).alias("found")).select(
        SET, F.col("found.edges").alias("edges"), F.greatest(F.lit(1), "found.filled").alias("filled")
    )


def _quantiles_by_set(rows: DataFrame, bins: int, bracket_rows: int, totals: DataFrame | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(edges, stored tables they read): those of sets with few rows from one aggregate, those of others from located ranks."""
    most = min(bracket_rows, ARRAY_ROWS)
    sizes = rows.groupBy(SET).agg(F.count(F.lit(1)).alias("n")) if totals is None else totals.select(SET, "n")
    large = written(sizes.where(F.col("n") > most), "large")
    if large.isEmpty():
        return _quantile_edges(_array_quantiles(rows.select(SET, "v"), bins)), [large]
    ranks = _quantile_ranks(large, bins)
    wanted = ranks.select(SET, F.explode(F.array("low", "high")).alias("t")).distinct()
    of_large = rows.select(SET, "v", "w").join(large.select(SET), SET, "left_semi")
    positions = locate_in_groups(of_large, wanted, [SET], large, bracket_rows)
    few = _array_quantiles(rows.select(SET, "v").join(large.select(SET), SET, "left_anti"), bins)
    listed = _located_quantiles(ranks, positions).unionByName(few)
    return _quantile_edges(listed), [large, positions]


def _value_table(edges: DataFrame, id_type: str) -> DataFrame:
    """Value edges in the form that :class:`GroupedBins` applies."""
    listed = F.transform("edges", lambda e: F.struct(e.alias("score"), F.lit(None).cast(id_type).alias("id")))
    return edges.select(
        SET, listed.alias("_edges"), F.lit(False).alias("_closed"), F.lit(True).alias("_from_values"), F.col("filled").alias("_filled")
    )


def _row_table(
    rows: DataFrame, sets: DataFrame, targets: DataFrame, positions: DataFrame, closed: bool, bracket_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(table, stored table it reads): the positions of the targets (set, k, t) as edges, also where several k have one; where rows share the score, the tie key that
    the target falls on is found among them the same way."""
    shared = positions.where(F.col("rows") > 1)
    ties = shared.select(SET, F.col("value").alias(SCORE), (F.col("t") - F.col("below")).alias("t")).distinct()
    sizes = shared.select(SET, F.col("value").alias(SCORE), F.col("rows").alias("n")).distinct()
    tied = (
        rows.withColumnRenamed("v", SCORE)
        .where(F.col("tie").isNotNull())
        .join(sizes.drop("n"), [SET, SCORE], "left_semi")
        .select(SET, SCORE, F.col("tie").alias("v"), "w")
    )
    located = locate_in_groups(tied, ties, [SET, SCORE], sizes, bracket_rows)
    ids = located.select(SET, F.col(SCORE).alias("value"), F.col("t").alias("rest"), F.col("value").alias("id"))
    edge = F.struct("k", F.col("value").cast("double").alias("score"), "id")
    listed = (
        targets.join(positions, [SET, "t"])
        .withColumn("rest", F.col("t") - F.col("below"))
        .join(ids, [SET, "value", "rest"], "left")
        .groupBy(SET)
        .agg(F.array_sort(F.collect_list(edge)).alias("listed"))
    )
    edges = F.transform("listed", lambda e: F.struct(e["score"].alias("score"), e["id"].alias("id")))
    id_type = tied.schema["v"].dataType.simpleString()
    none = F.array().cast(f"array<struct<score:double,id:{id_type}>>")
    table = sets.select(SET).join(listed, SET, "left").select(
        SET, F.coalesce(edges, none).alias("_edges"), F.lit(closed).alias("_closed"), F.lit(False).alias("_from_values"), F.lit(None).cast("int").alias("_filled")
    )
    return table, located


def fit_by_set(
    df: DataFrame, score: str, id: str | None, bins: int, by: str, bracket_rows: int, weight: str | None = None, kind: str = "score"
) -> GroupedBins:
    """Bins per set of ``by``: between ``quantile``\\ s of the values, between those of the ``rank``, of equal ``weight``, or by ``score``:
    between quantiles of the values unless ties leave fewer than ``bins`` of them filled, then by rank."""
    rows = _rows(df, score, by, weight, id)
    id_type = "bigint" if id is None else rows.schema["tie"].dataType.simpleString()
    if kind == "quantile":
        edges, made = _quantiles_by_set(rows, bins, bracket_rows)
        table = written(_value_table(edges, id_type), "bins")
        discard(*made)
        return GroupedBins(score, id, by, bins, table)
    totals = written(rows.groupBy(SET).agg(F.count(F.lit(1)).alias("n"), F.sum("w").cast("double").alias("weight")), "sets")
    made = [totals]
    if kind == "weight":
        sets = totals.where("weight > 0")
        targets = sets.select(SET, "weight", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("k")).where(f"k between 1 and {bins - 1}")
        targets = targets.select(SET, "k", (F.col("k") * F.col("weight") / bins).alias("t"))
        positions = locate_in_groups(rows.select(SET, "v", "w"), targets.select(SET, "t").distinct(), [SET], totals, bracket_rows)
        table, stored = _row_table(rows, sets, targets, positions, True, bracket_rows)
    else:
        inner = _quantile_ranks(totals, bins).where(f"k between 1 and {bins - 1}").select(SET, "k", F.col("low").alias("t"))
        sets, chosen, by_value = totals, rows, None
        if kind == "score":
            edges, read = _quantiles_by_set(rows, bins, bracket_rows, totals)
            edges = written(edges, "quantiles")
            made += [*read, edges]
            tied = edges.where(F.col("filled") < bins).select(SET)
            by_value = _value_table(edges, id_type).join(tied, SET, "left_anti")
            sets, chosen, inner = (x.join(tied, SET, "left_semi") for x in (totals, rows, inner))
        positions = locate_in_groups(chosen.select(SET, "v", "w"), inner.select(SET, "t").distinct(), [SET], sets, bracket_rows)
        table, stored = _row_table(chosen, sets, inner, positions, False, bracket_rows)
        table = table if by_value is None else by_value.unionByName(table)
    table = written(table, "bins")
    discard(*made, stored, positions)
    return GroupedBins(score, id, by, bins, table)
