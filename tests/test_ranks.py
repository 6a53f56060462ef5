import math
import random

import pytest
from pyspark.sql import functions as F

from sieveline.operators import ranks
from sieveline.operators.ranks import Series, exact_medians, locate, series_totals


def brute(rows, threshold):
    """First value in order whose running weight reaches the threshold."""
    rows = sorted(rows)
    below = 0.0
    for value in sorted({v for v, _ in rows}):
        at = sum(w for v, w in rows if v == value)
        if below + at >= threshold:
            return value, below, at
        below += at
    raise AssertionError("threshold beyond the total")


def hot_values(n, seed):
    """A third of the rows share one value, a few more values repeat, the rest are distinct."""
    rng = random.Random(seed)
    return [
        42.5 if i % 3 == 0 else float(rng.randrange(5)) if i % 3 == 1 else rng.gauss(40, 30) for i in range(n)
    ]


@pytest.mark.parametrize("bracket_rows", [10, 10**6])
@pytest.mark.parametrize("weighted", [False, True])
def test_locate_equals_brute_force(spark, monkeypatch, bracket_rows, weighted):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 7)
    values = hot_values(900, seed=1)
    rows = [(v, (i % 4) if weighted else 1, i % 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, w int, g int").repartition(5).cache()
    weight = F.col("w") if weighted else None
    series = [
        Series("all", F.col("v"), weight),
        Series("odd", F.when(F.col("g") == 1, F.col("v")), weight),
        Series("none", F.when(F.col("g") == 9, F.col("v")), weight),
    ]
    totals = series_totals(df, series)
    assert totals["none"].rows == 0
    parts = {"all": [(v, w) for v, w, _ in rows], "odd": [(v, w) for v, w, g in rows if g == 1]}
    thresholds = {n: [k * totals[n].weight / 7 for k in range(1, 7)] + [1.0, totals[n].weight] for n in parts}
    found = locate(df, series, thresholds, totals, bracket_rows)
    for name, part in parts.items():
        for t in thresholds[name]:
            position = found[name][t]
            assert (position.value, position.below, position.at) == brute(part, t)


def test_large_integers_keep_their_precision(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 5)
    base = 2**60
    df = spark.createDataFrame([(base + i,) for i in range(400)], "v long")
    series = [Series("v", F.col("v"))]
    found = locate(df, series, {"v": [1.0, 200.0, 400.0]}, series_totals(df, series), bracket_rows=10)
    assert [found["v"][t].value for t in (1.0, 200.0, 400.0)] == [base, base + 199, base + 399]


def test_zero_signs_infinities_and_missing_values(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 4)
    values = [0.0, -0.0] * 20 + [math.inf, -math.inf] * 3 + [math.nan, None] * 5 + [1.0, -1.0] * 10
    df = spark.createDataFrame([(v,) for v in values], "v double")
    series = [Series("v", F.col("v"))]
    totals = series_totals(df, series)
    assert totals["v"].rows == 66
    found = locate(df, series, {"v": [3.0, 4.0, 14.0, 53.0, 54.0, 66.0]}, totals, bracket_rows=5)["v"]
    assert [found[t].value for t in (3.0, 4.0, 14.0, 53.0, 54.0, 66.0)] == [-math.inf, -1.0, 0.0, 0.0, 1.0, math.inf]
    assert found[14.0].rows == 40


@pytest.mark.parametrize("hot", [math.inf, -math.inf])
def test_many_infinite_values(spark, monkeypatch, hot):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 5)
    values = [hot if i % 3 == 0 else float(i) for i in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    series = [Series("v", F.col("v"))]
    wanted = [1.0, 100.0, 201.0, 400.0, 401.0, 600.0]
    found = locate(df, series, {"v": wanted}, series_totals(df, series), bracket_rows=20)["v"]
    assert [found[t].value for t in wanted] == [sorted(values)[int(t) - 1] for t in wanted]


def test_fractional_weights_always_find_a_row(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 5)
    rng = random.Random(3)
    rows = [(float(i), rng.random() / 3) for i in range(300)]
    df = spark.createDataFrame(rows, "v double, w double").repartition(7)
    series = [Series("v", F.col("v"), F.col("w"))]
    totals = series_totals(df, series)
    wanted = [k * totals["v"].weight / 10 for k in range(1, 11)]
    found = locate(df, series, {"v": wanted}, totals, bracket_rows=4)["v"]
    assert set(found) == set(wanted)
    assert [p.value for _, p in sorted(found.items())] == sorted(p.value for p in found.values())


def test_exact_medians(spark):
    rows = [(i, None if i % 5 == 0 else float(i * i % 17), None) for i in range(51)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    pdf = df.toPandas()
    found = exact_medians(df, ["a", "b", "c"], bracket_rows=5)
    assert found == {"a": pdf.a.median(), "b": pdf.b.median(), "c": None}
    assert exact_medians(df, [], interpolated=False) == {}
    even = spark.createDataFrame([(1,), (2,), (5,), (9,)], "a int")
    assert exact_medians(even, ["a"]) == {"a": 3.5}
    assert exact_medians(even, ["a"], interpolated=False) == {"a": 2}
