"""Exact order statistics, weighted or not, of any number of series without sorting the rows.

A global sort or a window without partition key would pull every row through one task, and the
exact percentile aggregates keep all distinct values of a column in one. Instead a target rank is
narrowed down:

1. draw a bounded sample inside the brackets that still hold too many rows;
2. count rows and weight between the sampled points (one aggregate with map-side combine);
3. keep the one bracket per target that its rank falls into, and repeat until it is small;
4. order the few rows of that bracket.

Every sampled value also gets a bracket of its own. A value shared by a third of all rows is sampled
almost surely, and then is an answer at once instead of a bracket that never shrinks. The sample only
steers the search; counts decide, so the result is exact whatever was drawn.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.buckets import with_buckets

BRACKET_ROWS = 250_000
SAMPLED_POINTS = 4_000
MAX_POINTS = 400_000


@dataclass(frozen=True)
class Series:
    """Numbers to rank. ``value`` is null in rows that do not belong to the series."""

    name: str
    value: Column
    weight: Column | None = None


@dataclass(frozen=True)
class Total:
    rows: int
    weight: float


@dataclass(frozen=True)
class Position:
    """The value a threshold falls on, the weight of all lower values, and what lies at the value."""

    value: float
    below: float
    at: float
    rows: int


@dataclass
class _Bracket:
    low: float
    high: float
    rows: int
    offset: float
    thresholds: list[float] = field(default_factory=list)

    def splittable(self) -> bool:
        return math.nextafter(self.low, math.inf) < self.high


def _columns(df: DataFrame, series: list[Series]) -> DataFrame:
    """Per series i its values ``v<i>``, null for NaN, as one common type, and its weights ``w<i>``.

    From here on the expressions are SQL text: with hundreds of series, composing them call by call
    would take longer than running them.
    """
    raw = df.select(
        *[s.value.alias(f"v{i}") for i, s in enumerate(series)],
        *[s.weight.alias(f"w{i}") for i, s in enumerate(series) if s.weight is not None],
    )
    types = {t for name, t in raw.dtypes if name.startswith("v")}
    if types <= {"tinyint", "smallint", "int", "bigint"}:
        values = [f"cast(v{i} as bigint) as v{i}" for i in range(len(series))]
    else:
        # adding zero turns -0.0 into 0.0, which the bucket search would tell apart
        values = [f"nanvl(cast(v{i} as double), cast(null as double)) + 0.0D as v{i}" for i in range(len(series))]
    weights = [f"1 as w{i}" if s.weight is None else f"w{i}" for i, s in enumerate(series)]
    return raw.selectExpr(*values, *weights)


def series_totals(df: DataFrame, series: list[Series]) -> dict[str, Total]:
    """Row count and weight of every series in one aggregate."""
    counts = [f"count(v{i}) as n{i}" for i in range(len(series))]
    weighted = [i for i, s in enumerate(series) if s.weight is not None]
    weights = [f"sum(if(v{i} is null, null, w{i})) as w{i}" for i in weighted]
    row = _columns(df, series).selectExpr(*counts, *weights).first()
    return {
        s.name: Total(row[f"n{i}"], (row[f"w{i}"] or 0) if i in weighted else row[f"n{i}"])
        for i, s in enumerate(series)
    }


def _long_form(
    columns: DataFrame, points: dict[int, list[float]], slots: dict[int, dict[int, int]] | None = None
) -> DataFrame:
    """One row (series, slot, value, weight) per observed value of the series in ``points``.

    The slot is the bucket between the points, or what ``slots`` makes of it per series; rows of
    buckets not named there are left out.
    """
    searched = {i: p for i, p in points.items() if p}
    cut = columns.selectExpr("*", *[f"cast(v{i} as double) as d{i}" for i in searched])
    cut = with_buckets(cut, {f"b{i}": (f"d{i}", p) for i, p in searched.items()})
    entries = []
    for i in points:
        slot = f"cast(b{i} as int)" if i in searched else "0"
        if slots is not None:
            cases = " ".join(f"when {b} then {k}" for b, k in slots[i].items())
            slot = f"case {slot} {cases} end"
        entries.append(f"named_struct('series', {i}, 'slot', {slot}, 'value', v{i}, 'weight', w{i})")
    if len(entries) == 1:
        rows = cut.selectExpr(f"{entries[0]} as e").select("e.*")
    else:
        rows = cut.selectExpr(f"inline(array({', '.join(entries)}))")
    return rows.where("value is not null and slot is not null")


def _draw(
    columns: DataFrame, points: dict[int, list[float]], wide: dict[int, dict[int, _Bracket]], seed: int
) -> dict[int, set[float]]:
    """A bounded sample of the values inside the brackets that are still too wide."""
    rows = sum(b.rows for brackets in wide.values() for b in brackets.values())
    budget = min(MAX_POINTS, SAMPLED_POINTS * sum(len(brackets) for brackets in wide.values()))
    inside = _long_form(columns, {i: points[i] for i in wide}, {i: dict.fromkeys(b, 0) for i, b in wide.items()})
    sample = inside.select("series", F.col("value").cast("double").alias("value"))
    drawn: dict[int, set[float]] = {i: set() for i in wide}
    for row in sample.sample(fraction=min(1.0, budget / rows), seed=seed).collect():
        drawn[row["series"]].add(row["value"])
    return drawn


def _bounds(points: list[float], bucket: int) -> tuple[float, float]:
    low = points[bucket - 1] if bucket > 0 else -math.inf
    high = points[bucket] if bucket < len(points) else math.inf
    return low, high


def locate(
    df: DataFrame,
    series: list[Series],
    thresholds: dict[str, list[float]],
    totals: dict[str, Total],
    bracket_rows: int = BRACKET_ROWS,
    seed: int = 0,
) -> dict[str, dict[float, Position]]:
    """For each series and threshold ``t``, the first value whose cumulative weight reaches ``t``.

    Without weights a threshold is a 1-based rank. ``totals`` come from :func:`series_totals`.
    The driver holds only sampled points and counts between them, whose number is bounded; the rows
    stay where they are. Each round shrinks a bracket about as many times as it has points, so 10^12
    rows take two rounds, each two scans of the columns involved.
    """
    series = [s for s in series if totals[s.name].rows > 0 and thresholds.get(s.name)]
    found: dict[str, dict[float, Position]] = {s.name: {} for s in series}
    if not series:
        return found
    columns = _columns(df, series)
    points: dict[int, list[float]] = {i: [] for i in range(len(series))}
    pending = {}
    for i, s in enumerate(series):
        targets = sorted(map(float, set(thresholds[s.name])))
        pending[i] = {0: _Bracket(-math.inf, math.inf, totals[s.name].rows, 0.0, targets)}
    while True:
        wide = {
            i: {b: br for b, br in brackets.items() if br.rows > bracket_rows and br.splittable()}
            for i, brackets in pending.items()
        }
        wide = {i: brackets for i, brackets in wide.items() if brackets}
        if not wide:
            break
        drawn = _draw(columns, points, wide, seed)
        seed += 1
        for i, values in drawn.items():
            edges = {e for br in pending[i].values() for e in (br.low, br.high)}
            # each drawn value gets a bucket of its own, infinite ones the buckets at the ends
            own = values | {math.nextafter(v, math.inf) for v in values}
            if math.inf in values:
                own.add(sys.float_info.max)
            points[i] = sorted(e for e in edges | own if math.isfinite(e))
        counted = (
            _long_form(columns, {i: points[i] for i in wide})
            .groupBy("series", "slot")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("weight").alias("weight"),
                F.min("value").alias("low"),
                F.max("value").alias("high"),
            )
            .collect()
        )
        for i in wide:
            buckets = sorted((r for r in counted if r["series"] == i), key=lambda r: r["slot"])
            reached = list(accumulate(float(r["weight"]) for r in buckets))
            targets = [t for br in pending[i].values() for t in br.thresholds]
            pending[i] = {}
            for t in targets:
                at = min(bisect_left(reached, t), len(buckets) - 1)
                row = buckets[at]
                offset = reached[at - 1] if at else 0.0
                if row["low"] == row["high"]:
                    found[series[i].name][t] = Position(row["low"], offset, row["weight"], row["rows"])
                    continue
                low, high = _bounds(points[i], row["slot"])
                bracket = _Bracket(low, high, row["rows"], offset)
                pending[i].setdefault(row["slot"], bracket).thresholds.append(t)
    for i, t, position in _finish(columns, points, {i: b for i, b in pending.items() if b}):
        found[series[i].name][t] = position
    return found


def _finish(columns: DataFrame, points: dict[int, list[float]], pending: dict[int, dict[int, _Bracket]]):
    """Order the rows of the remaining small brackets and read the answers off."""
    if not pending:
        return
    brackets = [(i, bucket, br) for i, by_bucket in pending.items() for bucket, br in by_bucket.items()]
    slots: dict[int, dict[int, int]] = {i: {} for i in pending}
    for slot, (i, bucket, _) in enumerate(brackets):
        slots[i][bucket] = slot
    inside = _long_form(columns, {i: points[i] for i in pending}, slots)
    values = inside.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight"))
    within = Window.partitionBy("slot").orderBy("value")
    running = F.sum("weight").over(within.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
    before = running - F.col("weight")
    ranked = values.select(
        "slot",
        "value",
        "rows",
        "weight",
        before.alias("before"),
        # the ends of a bracket are open, so that rounding of fractional weights loses no target
        F.when(F.row_number().over(within) == 1, F.lit(-math.inf)).otherwise(before).alias("after"),
        F.when(F.lead("value").over(within).isNull(), F.lit(math.inf)).otherwise(running).alias("until"),
    )
    # thresholds counted from the start of their bracket: as many literals as were asked for
    targets = F.lit([[t - br.offset for t in br.thresholds] for _, _, br in brackets])
    hits = ranked.withColumn(
        "reached",
        F.filter(targets[F.col("slot")], lambda t: (t > F.col("after")) & (t <= F.col("until"))),
    ).where(F.size("reached") > 0)
    for row in hits.collect():
        i, _, bracket = brackets[row["slot"]]
        position = Position(row["value"], bracket.offset + row["before"], row["weight"], row["rows"])
        for t in bracket.thresholds:
            if t - bracket.offset in row["reached"]:
                yield i, t, position


def interpolate(low: float, high: float, share: float) -> float:
    if low == high:  # also if both are infinite
        return low
    return low + (high - low) * share if share < 0.5 else high - (high - low) * (1.0 - share)


def quantile_ranks(rows: int, k: int, n: int) -> tuple[int, int, float]:
    """1-based neighbour ranks of the ``k/n`` quantile and the share of the way between them."""
    whole, rest = divmod(k * (rows - 1), n)
    return whole + 1, whole + (2 if rest else 1), rest / n


@dataclass
class _Middle:
    """What is known of the middle ranks of one column: the open interval that holds those not found yet."""

    ranks: list[int]
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    rows: int = 0
    found: dict[int, float] = field(default_factory=dict)

    def inside(self, v: str) -> str:
        """SQL of whether a value may still be one of those looked for."""
        sides = [f"{v} > {_literal(self.low)}"] * (self.low > -math.inf) + [f"{v} < {_literal(self.high)}"] * (self.high < math.inf)
        return " and ".join([f"{v} is not null", *sides])

    def narrow(self, low: float, high: float, counts: tuple[int, int, int, int]) -> None:
        """Take in the numbers of values below and up to ``low``, below and up to ``high``."""
        under_low, to_low, under_high, to_high = counts
        left = []
        for r in self.ranks:
            if under_low < r <= to_low:
                self.found[r] = low
            elif under_high < r <= to_high:
                self.found[r] = high
            else:
                left.append(r)
        self.ranks = left
        if left:
            # the bracket of the sketch is only a proposal: the counts say on which side of it the rank is
            ends = [(self.low, low, self.below, under_low), (low, high, to_low, under_high), (high, self.high, to_high, self.below + self.rows)]
            self.low, self.high, self.below, until = next(e for e in ends if e[2] < left[0] <= e[3])
            outside = [r for r in left if r > until]
            if outside:  # two middle ranks on both sides of a gap: look again over the wider interval
                self.high, until = ends[2][1], ends[2][3]
            self.rows = until - self.below


def _literal(x: float) -> str:
    return f"cast('{x!r}' as double)"


def exact_medians(
    df: DataFrame, columns: list[str], interpolated: bool = True, bracket_rows: int = BRACKET_ROWS, error: float = 0.002
) -> dict[str, float | None]:
    """Median of every column; the lower middle value if not ``interpolated``. None if all null.

    Made for wide tables. Each round takes one sketch job, which proposes an interval around the middle of each column, and
    one aggregate with four counters per column, which decides; no row is multiplied. A round leaves about ``2 * error`` of
    the rows of a column inside its interval. Once those are at most ``bracket_rows``, they alone are laid out
    and counted per value. Values are compared as doubles.
    """
    if not columns:
        return {}
    table = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).selectExpr(
        *[f"nanvl(c{i}, cast(null as double)) + 0.0D as v{i}" for i in range(len(columns))]
    )
    totals = table.selectExpr(*[f"count(v{i}) as n{i}" for i in range(len(columns))]).first()
    ranks = {i: quantile_ranks(totals[f"n{i}"], 1, 2) for i in range(len(columns)) if totals[f"n{i}"]}
    middles = {
        i: _Middle(sorted({low, high} if interpolated else {low}), rows=totals[f"n{i}"]) for i, (low, high, _) in ranks.items()
    }
    while wide := [i for i, m in middles.items() if m.ranks and m.rows > bracket_rows]:
        names = [f"v{i}" for i in wide]
        inside = table.selectExpr(*[f"if({middles[i].inside(f'v{i}')}, v{i}, null) as v{i}" for i in wide])
        at = {i: (middles[i].ranks[0] - middles[i].below) / middles[i].rows for i in wide}
        # columns whose target lies at about the same share of their interval are sketched together
        shares = sorted({round(p, 3) for p in at.values()})
        probes = sorted({min(1.0, max(0.0, p + d)) for p in shares for d in (-error, error)})
        sketch = inside.approxQuantile(names, probes, error / 2)
        proposed = {}
        for i, quantiles in zip(wide, sketch, strict=True):
            p = round(at[i], 3)
            pick = [quantiles[probes.index(min(1.0, max(0.0, p + d)))] for d in (-error, error)]
            proposed[i] = (pick[0], pick[1])
        counters = []
        for i, (low, high) in proposed.items():
            for name, test in (("a", f"v{i} < {_literal(low)}"), ("b", f"v{i} <= {_literal(low)}"), ("c", f"v{i} < {_literal(high)}"), ("d", f"v{i} <= {_literal(high)}")):
                counters.append(f"count_if({test}) as {name}{i}")
        counted = table.selectExpr(*counters).first()
        for i, (low, high) in proposed.items():
            middles[i].narrow(low, high, tuple(counted[f"{k}{i}"] for k in "abcd"))
    _read_off(table, {i: m for i, m in middles.items() if m.ranks})
    medians: dict[str, float | None] = dict.fromkeys(columns)
    for i, (low, high, share) in ranks.items():
        value = middles[i].found[low]
        medians[columns[i]] = interpolate(value, middles[i].found[high], share) if interpolated else value
    return medians


def _read_off(table: DataFrame, middles: dict[int, _Middle]) -> None:
    """Lay out the values inside the small intervals, one row each, and find the ranks among them."""
    if not middles:
        return
    cells = ", ".join(f"if({m.inside(f'v{i}')}, named_struct('series', {i}, 'value', v{i}), null)" for i, m in middles.items())
    rows = table.selectExpr(f"inline(filter(array({cells}), x -> x is not null))")
    values = rows.groupBy("series", "value").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("series").orderBy("value")
    until = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.create_map(*[x for i, m in middles.items() for x in (F.lit(i), F.array(*[F.lit(r - m.below) for r in m.ranks]))])
    ranked = values.select("series", "value", until.alias("until"), (until - F.col("n")).alias("before"))
    hits = ranked.withColumn("hit", F.filter(wanted[F.col("series")], lambda r: (r > F.col("before")) & (r <= F.col("until"))))
    for row in hits.where(F.size("hit") > 0).collect():
        m = middles[row["series"]]
        for r in row["hit"]:
            m.found[r + m.below] = row["value"]
