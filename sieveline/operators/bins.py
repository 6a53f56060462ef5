"""Equal-frequency score bins, plain or weighted, per set.

Bins are fitted and then applied. Fitting finds the few rows at the bin edges with
:mod:`sieveline.operators.ranks`; applying compares each row with at most ``bins`` edges inside code
generation. No row is shuffled or sorted, and a score shared by many rows is split by ``id`` exactly.

Fitting reads the table several times, a few columns only. Hand in a stored table rather than one
whose scores a model would compute again each time. Bins can be fitted per set, for any number of sets:
see :mod:`sieveline.operators.group_bins` for more than :data:`FEW_SETS`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.expressions import is_observed, tie_key
from sieveline.operators.group_bins import GroupedBins, fit_by_set
from sieveline.operators.ranks import (
    BRACKET_ROWS,
    Position,
    Series,
    Total,
    interpolate,
    locate,
    quantile_ranks,
    series_totals,
)

#: Up to so many sets have their edges as literals in the plan, so that applying them takes no join; those of more are a table.
FEW_SETS = 16
ALL = "all"


def _in_set(by: str, name: str | None) -> Column:
    """The row belongs to the set; rows without a set name are a set of their own."""
    return F.col(by).cast("string").eqNullSafe(F.lit(name))


@dataclass(frozen=True)
class Edge:
    """A row that starts a new bin: its score and, where others share that score, its tie key."""

    score: float
    id: float | None = None


@dataclass(frozen=True)
class SetBins:
    """Bins of one set. ``closed`` says whether the edge row itself belongs to the upper bin."""

    edges: tuple[Edge, ...]
    closed: bool
    from_values: bool = False
    filled: int | None = None


@dataclass(frozen=True)
class FittedBins:
    score: str
    id: str | None
    by: str | None
    bins: int
    sets: dict[str | None, SetBins]

    def _passed(self, df: DataFrame, edge: Edge, closed: bool) -> Column:
        score = F.col(self.score)
        if edge.id is None:
            return score >= F.lit(edge.score) if closed else score > F.lit(edge.score)
        key = tie_key(df, self.id)
        tie = key >= F.lit(edge.id) if closed else key > F.lit(edge.id)
        return (score > F.lit(edge.score)) | ((score == F.lit(edge.score)) & tie)

    def _bin(self, df: DataFrame, fitted: SetBins) -> Column:
        if not fitted.edges:
            return F.lit(0)
        passed = [self._passed(df, e, fitted.closed).cast("int") for e in fitted.edges]
        total = passed[0]
        for p in passed[1:]:
            total = total + p
        return F.greatest(F.lit(0), total - 1) if fitted.from_values else total

    def apply(self, df: DataFrame, output: str = "bin") -> DataFrame:
        """Add the bin, 0 for the lowest scores; null for a row without score."""
        if not self.sets:
            return df.withColumn(output, F.lit(None).cast("int"))
        if self.by is None:
            chosen = self._bin(df, self.sets[ALL])
        else:
            cases = [(_in_set(self.by, name), self._bin(df, s)) for name, s in self.sets.items()]
            chosen = F.when(*cases[0])
            for condition, value in cases[1:]:
                chosen = chosen.when(condition, value)
        return df.withColumn(output, F.when(is_observed(F.col(self.score)), chosen))


def _check(bins: int) -> None:
    if bins < 1:
        raise ValueError("at least one bin")


def _has_many_sets(df: DataFrame, by: str | None) -> bool:
    if by is None:
        return False
    name = F.col(by).cast("string")
    # a sketch of a few names never comes near this estimate, so a large one spares the exact count its shuffle of all names
    if df.agg(F.approx_count_distinct(name)).first()[0] > 8 * FEW_SETS:
        return True
    return df.select(name).distinct().limit(FEW_SETS + 1).count() > FEW_SETS


def _score_series(
    df: DataFrame, score: str, by: str | None, weight: str | None = None
) -> tuple[list[Series], dict[str, Total]]:
    """The scores of each of a few sets with their row counts and weights, from one aggregate.

    Rows whose set has no name are a set of their own.
    """
    value = F.col(score)
    w = None if weight is None else F.col(weight)
    if by is None:
        series = [Series(ALL, value, w)]
        return series, series_totals(df, series)
    seen = is_observed(value)
    counts = df.groupBy(F.col(by).cast("string").alias("name")).agg(
        F.count_if(seen).alias("rows"), F.sum(F.when(seen, F.lit(1) if w is None else w)).alias("weight")
    )
    totals = {r["name"]: Total(r["rows"], r["weight"] or 0) for r in counts.collect()}
    ordered = sorted(totals, key=lambda name: (name is None, name or ""))
    series = [Series(name, F.when(_in_set(by, name), value), w) for name in ordered]
    return series, totals


def _value_bins(edges: list[float], filled: int) -> SetBins:
    return SetBins(tuple(Edge(e) for e in edges), closed=False, from_values=True, filled=filled)


def fit_quantile_bins(
    df: DataFrame, score: str, bins: int = 10, by: str | None = None, bracket_rows: int = BRACKET_ROWS
) -> FittedBins | GroupedBins:
    """Bins between interpolated quantiles of the values, right-closed; equal edges collapse."""
    _check(bins)
    if _has_many_sets(df, by):
        return fit_by_set(df, score, None, bins, by, bracket_rows, kind="quantile")
    series, totals = _score_series(df, score, by)
    found = _quantile_positions(df, series, totals, bins, bracket_rows)
    return FittedBins(score, None, by, bins, _quantile_sets(found, totals, bins))


def _quantile_positions(df, series, totals: dict[str, Total], bins: int, bracket_rows: int):
    wanted = {
        s.name: [r for k in range(bins + 1) for r in quantile_ranks(totals[s.name].rows, k, bins)[:2]]
        for s in series
        if totals[s.name].rows
    }
    return locate(df, series, wanted, totals, bracket_rows)


def _quantile_sets(found: dict[str, dict[float, Position]], totals: dict[str, Total], bins: int) -> dict[str, SetBins]:
    sets = {}
    for name in found:
        edges, filled = [], 0
        for k in range(bins + 1):
            low, high, share = quantile_ranks(totals[name].rows, k, bins)
            below, above = found[name][low].value, found[name][high].value
            edge = interpolate(below, above, share)
            # a bin holds rows if the last value at or below its upper edge lies above its lower edge
            if edges and edge > edges[-1] and (len(edges) == 1 or below > edges[-1]):
                filled += 1
            if not edges or edge > edges[-1]:
                edges.append(edge)
        sets[name] = _value_bins(edges, max(filled, 1))
    return sets


def _tie_edges(
    df: DataFrame,
    by: str | None,
    score: str,
    id: str,
    weight: str | None,
    found: dict[str, dict[float, Position]],
    bracket_rows: int,
) -> dict[str, dict[float, Edge]]:
    """Turn positions into edges; where rows share the score, find the id the threshold falls on."""
    edges: dict[str, dict[float, Edge]] = {name: {} for name in found}
    shared = {}
    for name, positions in found.items():
        for t, p in positions.items():
            edges[name][t] = Edge(p.value)
            if p.rows > 1:
                shared.setdefault((name, p.value), []).append((t, t - p.below))
    if not shared:
        return edges
    ties = df.where(F.col(score).isin(sorted({value for _, value in shared})))
    series, thresholds, totals = [], {}, {}
    for i, ((name, value), targets) in enumerate(shared.items()):
        here = F.col(score) == F.lit(value)
        if by is not None:
            here = here & _in_set(by, name)
        series.append(Series(str(i), F.when(here, tie_key(df, id)), None if weight is None else F.col(weight)))
        thresholds[str(i)] = [rest for _, rest in targets]
        at = found[name][targets[0][0]]
        totals[str(i)] = Total(at.rows, at.at)
    located = locate(ties, series, thresholds, totals, bracket_rows)
    for i, ((name, value), targets) in enumerate(shared.items()):
        for t, rest in targets:
            edges[name][t] = Edge(value, located[str(i)][rest].value)
    return edges


def _edge_ranks(rows: int, bins: int) -> list[int]:
    """Ranks of the last rows of all bins but the highest; the quantile positions include them."""
    return [quantile_ranks(rows, k, bins)[0] for k in range(1, bins)]


def _rank_sets(df, found, totals, score, id, bins, by, bracket_rows) -> dict[str, SetBins]:
    ranks = {name: _edge_ranks(totals[name].rows, bins) for name in found}
    at_edges = {name: {r: found[name][r] for r in ranks[name]} for name in found}
    edges = _tie_edges(df, by, score, id, None, at_edges, bracket_rows)
    return {name: SetBins(tuple(edges[name][r] for r in ranks[name]), closed=False) for name in found}


def fit_rank_bins(
    df: DataFrame, score: str, id: str, bins: int = 10, by: str | None = None, bracket_rows: int = BRACKET_ROWS
) -> FittedBins | GroupedBins:
    """Bins between quantiles of the rank by (score, id): ties are broken, so all bins fill up."""
    _check(bins)
    if _has_many_sets(df, by):
        return fit_by_set(df, score, id, bins, by, bracket_rows, kind="rank")
    series, totals = _score_series(df, score, by)
    wanted = {s.name: _edge_ranks(totals[s.name].rows, bins) for s in series if totals[s.name].rows}
    found = locate(df, series, wanted, totals, bracket_rows)
    # a single bin has no edges, so nothing was looked for
    found = {name: found.get(name, {}) for name in wanted}
    return FittedBins(score, id, by, bins, _rank_sets(df, found, totals, score, id, bins, by, bracket_rows))


def fit_weighted_bins(
    df: DataFrame,
    score: str,
    id: str,
    weight: str,
    bins: int = 10,
    by: str | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> FittedBins | GroupedBins:
    """Bins of equal weight along (score, id): a row's bin is its running weight in units of
    total / bins, rounded down, and at most ``bins - 1``. Weights must not be negative."""
    _check(bins)
    if _has_many_sets(df, by):
        return fit_by_set(df, score, id, bins, by, bracket_rows, weight, kind="weight")
    series, totals = _score_series(df, score, by, weight)
    totals = {name: t for name, t in totals.items() if t.weight > 0}
    series = [s for s in series if s.name in totals]
    wanted = {name: [k * t.weight / bins for k in range(1, bins)] for name, t in totals.items()}
    found = locate(df, series, wanted, totals, bracket_rows)
    edges = _tie_edges(df, by, score, id, weight, found, bracket_rows)
    sets = {
        name: SetBins(tuple(edges[name][t] for t in targets), closed=True) for name, targets in wanted.items()
    }
    return FittedBins(score, id, by, bins, sets)


def fit_score_bins(
    df: DataFrame,
    score: str,
    id: str,
    bins: int = 10,
    weight: str | None = None,
    by: str | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> FittedBins | GroupedBins:
    """Weighted bins if a weight column is given. Otherwise quantile bins, or rank bins for a set
    whose ties leave fewer than ``bins`` quantile bins filled."""
    if weight is not None:
        return fit_weighted_bins(df, score, id, weight, bins, by, bracket_rows)
    _check(bins)
    if _has_many_sets(df, by):
        return fit_by_set(df, score, id, bins, by, bracket_rows)
    series, totals = _score_series(df, score, by)
    found = _quantile_positions(df, series, totals, bins, bracket_rows)
    sets = _quantile_sets(found, totals, bins)
    tied = {name: found[name] for name, s in sets.items() if s.filled < bins}
    if tied:
        sets |= _rank_sets(df, tied, totals, score, id, bins, by, bracket_rows)
    return FittedBins(score, id, by, bins, sets)


def reversed_bin(bins: int, column: str = "bin") -> Column:
    """Number bins from 1 for the highest scores to ``bins`` for the lowest."""
    return F.lit(bins) - F.col(column)
