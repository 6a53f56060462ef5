import random

import numpy as np
import pandas as pd
import pytest

from sieveline.operators import bins, group_bins, group_ranks, ranks
from sieveline.operators.bins import (
    fit_quantile_bins,
    fit_rank_bins,
    fit_score_bins,
    fit_weighted_bins,
    reversed_bin,
)


@pytest.fixture
def few_points(monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLED_POINTS", 6)
    monkeypatch.setattr(group_ranks, "SAMPLED_POINTS", 16)


def frame(spark, pdf):
    return spark.createDataFrame(pdf).repartition(5)


def bins_of(fitted, df, key=("id",)):
    pdf = fitted.apply(df).toPandas().sort_values(list(key))
    return pdf["bin"].tolist()


def rank_bin(ranks_, total, n):
    return [max(0, -((-(r - 1) * n) // (total - 1)) - 1) for r in ranks_]


def weighted_bin(pdf, n):
    run = pdf.sort_values(["score", "id"])
    cum = run["w"].cumsum()
    total = run["w"].sum()
    return (cum * n // total).clip(upper=n - 1).astype(int).sort_index().tolist()


def sample(n, seed, tied):
    rng = random.Random(seed)
    score = [rng.choice([0.1, 0.5, 0.9]) if tied and i % 3 else rng.random() for i in range(n)]
    return pd.DataFrame({"id": range(n), "score": score, "w": [rng.randrange(4) for _ in range(n)]})


@pytest.mark.parametrize("tied", [False, True])
@pytest.mark.parametrize("n,bins,bracket_rows", [(8, 3, 10**6), (452, 10, 10**6), (452, 10, 20)])
def test_quantile_bins_equal_qcut(spark, few_points, tied, n, bins, bracket_rows):
    # no k * (n - 1) / bins is whole here, so no edge is a value that rounding could move past
    pdf = sample(n, n, tied)
    df = frame(spark, pdf)
    expected = pd.qcut(pdf["score"], bins, labels=False, duplicates="drop")
    assert bins_of(fit_quantile_bins(df, "score", bins, bracket_rows=bracket_rows), df) == expected.tolist()


def test_value_on_an_edge_belongs_to_the_lower_bin(spark):
    df = frame(spark, pd.DataFrame({"id": range(7), "score": [float(i) for i in range(7)]}))
    assert bins_of(fit_quantile_bins(df, "score", 3), df) == [0, 0, 0, 1, 1, 2, 2]


@pytest.mark.parametrize("tied", [False, True])
@pytest.mark.parametrize("n,bins,bracket_rows", [(3, 10, 10**6), (452, 10, 10**6), (452, 10, 20)])
def test_rank_bins_break_ties_by_id(spark, few_points, tied, n, bins, bracket_rows):
    pdf = sample(n, n, tied)
    df = frame(spark, pdf)
    expected = rank_bin(pdf["score"].rank(method="first").astype(int), n, bins)
    assert bins_of(fit_rank_bins(df, "score", "id", bins, bracket_rows=bracket_rows), df) == expected


@pytest.mark.parametrize("tied", [False, True])
@pytest.mark.parametrize("bracket_rows", [20, 10**6])
def test_weighted_bins(spark, few_points, tied, bracket_rows):
    pdf = sample(300, 5, tied)
    df = frame(spark, pdf)
    fitted = fit_weighted_bins(df, "score", "id", "w", 7, bracket_rows=bracket_rows)
    assert bins_of(fitted, df) == weighted_bin(pdf, 7)


def test_last_weighted_row_stays_in_the_last_bin(spark):
    pdf = pd.DataFrame({"id": range(4), "score": [1.0, 2.0, 3.0, 4.0], "w": [2, 2, 2, 2]})
    df = frame(spark, pdf)
    assert bins_of(fit_weighted_bins(df, "score", "id", "w", 2), df) == [0, 1, 1, 1]


def test_score_bins_fall_back_per_set(spark, few_points):
    rng = random.Random(2)
    pdf = pd.DataFrame({"id": range(600), "split": [("a", "b", "c")[i % 3] for i in range(600)]})
    pdf["score"] = [float(rng.random() > 0.6) if s == "b" else rng.random() for s in pdf["split"]]
    df = frame(spark, pdf)
    fitted = fit_score_bins(df, "score", "id", 10, by="split", bracket_rows=20)
    found = fitted.apply(df).toPandas().sort_values("id")
    for name, part in found.groupby("split"):
        plain = pd.qcut(part["score"], 10, labels=False, duplicates="drop")
        expected = plain.tolist() if name != "b" else rank_bin(part["score"].rank(method="first"), len(part), 10)
        assert part["bin"].tolist() == expected


def test_filled_bins_are_counted_right(spark):
    rng = random.Random(8)
    for n in (2, 5, 10, 25):
        for _ in range(2):
            pdf = pd.DataFrame({"id": range(n), "score": [float(rng.randrange(12)) for _ in range(n)]})
            plain = pd.qcut(pdf["score"], 5, labels=False, duplicates="drop")
            if plain.isna().all():
                continue
            fitted = fit_quantile_bins(frame(spark, pdf), "score", 5)
            assert fitted.sets["all"].filled == plain.nunique()


def test_text_ids_break_ties_too(spark):
    pdf = pd.DataFrame({"id": [f"row-{i}" for i in range(60)], "score": [float(i % 2) for i in range(60)]})
    df = frame(spark, pdf)
    found = fit_rank_bins(df, "score", "id", 10).apply(df).toPandas()
    assert np.bincount(found["bin"]).tolist() == [6] * 10
    assert set(found[found["score"] == 0.0]["bin"]) == set(range(5))


def test_all_scores_tied(spark):
    pdf = pd.DataFrame({"id": range(40), "score": [0.5] * 40})
    df = frame(spark, pdf)
    assert set(bins_of(fit_quantile_bins(df, "score", 10), df)) == {0}
    assert np.bincount(bins_of(fit_score_bins(df, "score", "id", 10), df)).tolist() == [4] * 10


def test_missing_scores_get_no_bin(spark):
    df = spark.createDataFrame([(1, 0.1), (2, None), (3, float("nan")), (4, 0.9)], "id int, score double")
    assert fit_score_bins(df, "score", "id", 2).apply(df).orderBy("id").toPandas()["bin"].isna().tolist() == [
        False,
        True,
        True,
        False,
    ]
    empty = df.where("id > 10")
    assert fit_score_bins(empty, "score", "id", 2).apply(empty).count() == 0


def test_zero_weights(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (2, 0.2, 0)], "id int, score double, w int")
    assert {r["bin"] for r in fit_weighted_bins(df, "score", "id", "w", 3).apply(df).collect()} == {None}


def test_reversed_bin(spark):
    df = spark.createDataFrame([(0,), (9,)], "bin int")
    assert [r[0] for r in df.select(reversed_bin(10)).collect()] == [10, 1]


def test_a_single_bin(spark):
    df = frame(spark, sample(20, 1, True))
    for fitted in (
        fit_quantile_bins(df, "score", 1),
        fit_rank_bins(df, "score", "id", 1),
        fit_score_bins(df, "score", "id", 1),
        fit_weighted_bins(df, "score", "id", "w", 1),
    ):
        assert set(bins_of(fitted, df)) == {0}


def test_rows_without_set_name_are_a_set(spark):
    df = spark.range(60).selectExpr("id", "double(id) as score", "if(id % 3 = 0, null, string(id % 3)) as split")
    for fit in (lambda: fit_quantile_bins(df, "score", 4, by="split"), lambda: fit_rank_bins(df, "score", "id", 4, by="split")):
        rows = fit().apply(df).groupBy("split", "bin").count().collect()
        assert {(r["split"], r["bin"]) for r in rows} == {(s, b) for s in (None, "1", "2") for b in range(4)}


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,0)", "decimal(18,2)", "decimal(38,0)"])
def test_large_ids_split_ties(spark, kind):
    start = 10**15 if kind == "decimal(18,2)" else 2**59
    df = spark.range(100).selectExpr(f"cast(id + {start} as {kind}) as id", "1.0D as score")
    counts = fit_rank_bins(df, "score", "id", 4).apply(df).groupBy("bin").count().collect()
    assert sorted((r["bin"], r["count"]) for r in counts) == [(b, 25) for b in range(4)]


def test_bad_arguments(spark):
    df = spark.range(200).selectExpr("id", "double(id) as score", "id as split")
    for by in (None, "split"):
        with pytest.raises(ValueError):
            fit_quantile_bins(df, "score", 0, by=by)


def many_sets(seed=4, sets=1_500):
    """Sets of 1 to 9 rows, one of them without name and one with a third of all rows."""
    rng = random.Random(seed)
    names = [None if s == 0 else f"s{s}" for s in range(sets) for _ in range(1 + s % 9)]
    names += ["hot"] * (len(names) // 2)
    rng.shuffle(names)
    n = len(names)
    score = [rng.choice([0.25, 0.5, rng.random()]) for _ in range(n)]
    return pd.DataFrame({"id": range(n), "split": names, "score": score, "w": [rng.randrange(4) for _ in range(n)]})


@pytest.fixture(scope="module")
def sets_table(spark, tmp_path_factory):
    pdf = many_sets()
    path = str(tmp_path_factory.mktemp("sets") / "t")
    spark.createDataFrame(pdf).repartition(5).write.parquet(path)
    return pdf, spark.read.parquet(path)


@pytest.mark.parametrize("bracket_rows", [4, 10**6])
def test_bins_of_many_sets(sets_table, few_points, bracket_rows):
    """More sets than fit a plan, against the bins of each set by pandas."""
    pdf, df = sets_table
    assert pdf["split"].nunique(dropna=False) > 1_000
    fits = {
        "quantile": fit_quantile_bins(df, "score", 4, by="split", bracket_rows=bracket_rows),
        "rank": fit_rank_bins(df, "score", "id", 4, by="split", bracket_rows=bracket_rows),
        "weight": fit_weighted_bins(df, "score", "id", "w", 4, by="split", bracket_rows=bracket_rows),
    }
    found = {kind: fitted.apply(df).toPandas().sort_values("id").set_index("id") for kind, fitted in fits.items()}
    assert all(len(f) == len(pdf) for f in found.values())
    for name, part in pdf.groupby("split", dropna=False):
        part = part.set_index("id")
        n = len(part)
        expected = {
            "quantile": pd.qcut(part["score"], 4, labels=False, duplicates="drop").fillna(0).astype(int).tolist(),
            "rank": [0] if n == 1 else rank_bin(part["score"].rank(method="first").astype(int), n, 4),
            "weight": weighted_bin(part.reset_index(), 4) if part["w"].sum() else [None] * n,
        }
        for kind, want in expected.items():
            got = found[kind].loc[part.index, "bin"]
            assert [None if pd.isna(b) else int(b) for b in got] == want, (name, kind)


def test_score_bins_of_many_sets_fall_back(sets_table, few_points):
    pdf, df = sets_table
    fitted = fit_score_bins(df, "score", "id", 2, by="split", bracket_rows=50)
    found = fitted.apply(df).toPandas().set_index("id")
    for _, part in pdf.groupby("split", dropna=False):
        part = part.set_index("id")
        plain = pd.qcut(part["score"], 2, labels=False, duplicates="drop")
        want = plain if plain.nunique() == 2 else pd.Series(rank_bin(part["score"].rank(method="first"), len(part), 2) if len(part) > 1 else [0], part.index)
        assert found.loc[part.index, "bin"].tolist() == want.tolist()


def test_set_bins_of_rows_without_score_or_weight(spark, monkeypatch):
    monkeypatch.setattr(bins, "FEW_SETS", 0)
    rows = [(1, "a", None, 1), (2, "a", float("nan"), 1), (3, "b", 0.5, 0), (4, "b", 0.7, 0), (5, "c", -0.0, 1), (6, "c", 0.0, 1), (7, "c", float("inf"), 2)]
    df = spark.createDataFrame(rows, "id int, split string, score double, w int")
    bins_by = lambda fitted: {r["id"]: r["bin"] for r in fitted.apply(df).collect()}
    assert bins_by(fit_quantile_bins(df, "score", 2, by="split")) == {1: None, 2: None, 3: 0, 4: 1, 5: 0, 6: 0, 7: 0}
    assert bins_by(fit_weighted_bins(df, "score", "id", "w", 2, by="split")) == {1: None, 2: None, 3: None, 4: None, 5: 0, 6: 1, 7: 1}
    empty = df.where("id > 10")
    for fit in (lambda d: fit_quantile_bins(d, "score", 3, by="split"), lambda d: fit_rank_bins(d, "score", "id", 3, by="split")):
        assert fit(empty).apply(empty).count() == 0
        assert {r["bin"] for r in fit(empty).apply(df).collect()} == {None}


def test_columns_are_kept_when_bins_are_applied_by_set(spark, monkeypatch):
    monkeypatch.setattr(bins, "FEW_SETS", 0)
    df = spark.range(20).selectExpr("id", "double(id) as score", "string(id % 3) as split", "'x' as _set", "'y' as _edges", "7 as bin")
    out = fit_rank_bins(df, "score", "id", 2, by="split").apply(df)
    assert out.columns == ["id", "score", "split", "_set", "_edges", "bin"]
    assert {(r["_set"], r["_edges"]) for r in out.collect()} == {("x", "y")}


def test_few_sets_have_the_same_bins_in_both_forms(spark, few_points, monkeypatch):
    df = frame(spark, sample(300, 6, True).assign(split=[None if k % 5 == 0 else k % 3 for k in range(300)]))
    fits = [
        lambda: fit_quantile_bins(df, "score", 7, by="split", bracket_rows=20),
        lambda: fit_score_bins(df, "score", "id", 7, by="split", bracket_rows=20),
        lambda: fit_weighted_bins(df, "score", "id", "w", 7, by="split", bracket_rows=20),
    ]
    few = [bins_of(fit(), df) for fit in fits]
    monkeypatch.setattr(bins, "FEW_SETS", 1)
    assert [bins_of(fit(), df) for fit in fits] == few


def test_quantiles_of_small_sets_come_from_one_aggregate(sets_table, monkeypatch):
    """No ranks are exploded, located and joined back unless a set is large; both ways give the same edges."""
    _, df = sets_table
    original, located = group_bins.locate_in_groups, []

    def locate(rows, targets, keys, sizes, *rest):
        located.append(sizes.count())
        return original(rows, targets, keys, sizes, *rest)

    monkeypatch.setattr(group_bins, "locate_in_groups", locate)

    def edges(most):
        monkeypatch.setattr(group_bins, "ARRAY_ROWS", most)
        return {r[0]: r[1:] for r in fit_quantile_bins(df, "score", 7, by="split").edges.collect()}

    arrays = edges(10**6)
    assert located == []
    assert edges(9) == arrays
    assert edges(0) == arrays
    assert located == [1, len(arrays)]


def test_few_names_are_counted_exactly(spark):
    for sets in (bins.FEW_SETS, bins.FEW_SETS + 1, 20 * bins.FEW_SETS):
        df = spark.range(2_000).selectExpr(f"if(id % {sets} = 0, null, id % {sets}) as split")
        assert bins._has_many_sets(df, "split") == (sets > bins.FEW_SETS)


def test_plan_does_not_grow_with_the_sets(spark, plan_of):
    sizes = []
    for n in (20, 300):
        df = spark.range(900).selectExpr("id", "double(id) as score", f"id % {n} as split")
        sizes.append(len(plan_of(fit_rank_bins(df, "score", "id", 4, by="split").apply(df))))
    assert sizes[1] < 1.5 * sizes[0]


def test_applying_bins_needs_no_shuffle(spark, plan_of):
    df = frame(spark, sample(100, 1, True))
    for fitted in (fit_quantile_bins(df, "score", 5), fit_weighted_bins(df, "score", "id", "w", 5)):
        text = plan_of(fitted.apply(spark.range(10).selectExpr("id", "double(id) as score", "1 as w")))
        assert "Window" not in text and "Exchange" not in text and "Sort" not in text
