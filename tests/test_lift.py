import random

import numpy as np
import pandas as pd
import pytest

from sieveline.operators.lift import bin_summary, gain_table, lift_gain_table, lift_table


def expected_table(part, bins, weighted):
    """Padded lift and gain columns straight from binned rows."""
    part = part.assign(w=part["w"] if weighted else 1)
    base = (part["y"] * part["w"]).sum() / part["w"].sum()
    groups = part.groupby("bin")
    lift = groups.apply(lambda g: (g["y"] * g["w"]).sum() / g["w"].sum(), include_groups=False).to_numpy()
    gain = (groups["y"].sum() / part["y"].sum()).cumsum().to_numpy()
    return base, np.append(lift, 0), np.append(lift / base, 0), np.insert(gain, 0, 0)


def rows(seed, n=604):
    # no set has an inner bin edge on a row, where floating-point quantiles would decide by rounding
    rng = random.Random(seed)
    pdf = pd.DataFrame({"id": range(n), "s": [("a", "b", "c")[i % 7 % 3] for i in range(n)]})
    pdf["score"] = [rng.random() for _ in range(n)]
    pdf["y"] = [int(rng.random() < v) for v in pdf["score"]]
    pdf["w"] = [rng.randrange(1, 4) for _ in range(n)]
    return pdf


@pytest.mark.parametrize("weighted", [False, True])
def test_padded_table_per_set(spark, weighted):
    pdf = rows(1)
    df = spark.createDataFrame(pdf)
    summary = bin_summary(df, "y", "score", "id", 10, "w" if weighted else None, "s")
    found = lift_gain_table(summary, "s").toPandas()
    for name, part in pdf.groupby("s"):
        if weighted:
            run = part.sort_values(["score", "id"])
            part = run.assign(bin=10 - (run["w"].cumsum() * 10 // run["w"].sum()).clip(upper=9))
        else:
            part = part.assign(bin=10 - pd.qcut(part["score"], 10, labels=False))
        base, lift, index, gain = expected_table(part, 10, weighted)
        ours = found[found["s"] == name].sort_values("deciles")
        assert ours["deciles"].tolist() == list(range(11))
        assert ours["baseline_percentage"].tolist() == pytest.approx([base] * 11)
        assert ours["lift_percentage"].tolist() == pytest.approx(lift.tolist())
        assert ours["lift_index"].tolist() == pytest.approx(index.tolist())
        assert ours["gain"].tolist() == pytest.approx(gain.tolist())
        assert set(ours["random"]) == {1} and set(ours["baseline_index"]) == {1}


def test_tables_by_bin(spark):
    df = spark.createDataFrame([(i, int(i >= 6), float(i)) for i in range(10)], "id int, y int, score double")
    summary = bin_summary(df, "y", "score", "id", 5)
    lift = {r["bin"]: (r["lift_percentage"], r["lift_index"]) for r in lift_table(summary).collect()}
    assert lift == {1: (1.0, 2.5), 2: (1.0, 2.5), 3: (0.0, 0.0), 4: (0.0, 0.0), 5: (0.0, 0.0)}
    gain = {r["bin"]: r["gain"] for r in gain_table(summary).collect()}
    assert gain == {1: 0.5, 2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0}


def test_fewer_rows_than_bins(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.5)], "id int, y int, score double")
    table = lift_gain_table(bin_summary(df, "y", "score", "id", 10)).orderBy("deciles").collect()
    assert [r["deciles"] for r in table] == [0, 1, 2, 3]
    assert [r["gain"] for r in table] == [0.0, 0.5, 1.0, 1.0]
    assert [r["lift_percentage"] for r in table] == [1.0, 1.0, 0.0, 0.0]


def test_no_positives_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(1, 0, 0.9), (2, 0, 0.1)], "id int, y int, score double")
    table = lift_gain_table(bin_summary(df, "y", "score", "id", 2)).orderBy("deciles").collect()
    assert [r["lift_percentage"] for r in table] == [0.0, 0.0, 0.0]
    assert table[1]["gain"] is None and table[0]["lift_index"] is None
