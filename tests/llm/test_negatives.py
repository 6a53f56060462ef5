"""Hard negatives against all scores, and the guarantee of the index."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import negatives
from sieveline.llm.queries import op11_hard_negatives

ROWS = "vec_id long, embedding array<float>, label int"


def expected(rows, is_anchor, positives=5, wanted=10, low=30, high=90):
    """All result rows by scoring every pair. Rows are (id, vector, label)."""
    taken = []
    for i, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        x = np.array(x, np.float32).astype(float)
        q = [max(-negatives.LARGEST, min(negatives.LARGEST, math.floor(256 * v))) for v in x.tolist()]
        taken.append((i, q, label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for k, (a, q, label) in enumerate(taken):
        if not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(q, p)), b, other == label) for j, (b, p, other) in enumerate(taken) if j != k]
        for ps, b, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            inside = [s for s in scored if not s[2] and low * ps <= 100 * s[0] <= high * ps]
            for rank, (ns, c, _) in enumerate(sorted(inside, key=order)[:wanted], 1):
                out.append((a, b, rank, c, ps, ns))
    return out


def key(r):
    return tuple((v is None, v or 0) for v in r)


def check(df, want):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


def tens(i):
    return i is not None and i % 10 == 0


def test_embeddings(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    shifted = [(i, x, (label + 1) % 10 if i % 7 == 0 else label) for i, x, label in rows]
    want = expected(shifted, lambda i: i % 100 == 0)
    assert want
    check(op11_hard_negatives(spark, sf_dir), want)


def near_rows(seed=2, n=600, dims=20):
    """Vectors around a few centres, many of them equal, so that windows fill in different passes and ties abound."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        noise = rng.choice([0.0, 0.2, 1.0])
        rows.append((i, [v * rng.choice([1.0, 1.0, 0.5]) + rng.gauss(0, noise) for v in c], rng.randrange(4)))
    return rows


@pytest.mark.parametrize("block", [negatives.BLOCK_BYTES, 2_000])
@pytest.mark.parametrize("tile", [negatives.TILE_CELLS, 700])
def test_near_vectors_in_blocks_and_tiles(spark, monkeypatch, block, tile):
    monkeypatch.setattr(negatives, "TILE_CELLS", tile)
    rows = near_rows()
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    check(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_bytes=block), expected(rows, tens))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 2), (10, [], 1), (20, [1.0], 2), (30, [0.5, 0.5, 0.5, 0.5], 1),
        (1, [1.0, 1.0], 1), (2, [1.0, nan], 1), (3, [inf, 1.0], 1), (4, [None, 1.0], 1), (5, None, 1), (6, [1.0, 1.0], None),
        (None, [0.9, 1.1], 2), (None, [0.9, 1.1], 1), (None, [0.9, 1.1], 2), (40, [-1.0, -2.0], 1), (7, [0.3, 0.6], 2), (8, [0.3, 0.6], 3),
        (9, [0.3, 0.6], 2), (11, [1e30, -1e30], 4), (12, [1e30, 1.0], 4), (50, [3e38, 2.0], 4), (13, [0.0, 0.0], 2), (60, [0.0, 0.0], 5),
        (61, [0.0], 5), (70, [1.0, 2.0], 9),
    ]
    df = spark.createDataFrame(rows, ROWS).repartition(2).withColumns({c: F.lit("x") for c in ("row", "q", "score", "window", "block")})
    want = expected(rows, tens)
    assert want
    check(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0), want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    some = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], ROWS)
    assert negatives.hard_negatives(some, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0], 1), (2, [1.0], 2)], ROWS)
    assert negatives.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("threshold", [0.9, 0.6, 0.3, 0.0, -1.0])
def test_index_finds_all_pairs_at_the_threshold(threshold):
    rng = np.random.default_rng(4)
    scale = np.exp(-np.arange(32) / 6) * 200
    anchors, rows = (np.floor(rng.normal(size=(n, 32)) * scale) for n in (50, 300))
    rows[:40] = np.floor(anchors[:40] * 0.9)
    longest = np.sqrt((rows**2).sum(axis=1)).max()
    limits = np.ceil(np.sqrt((anchors**2).sum(axis=1)) * longest * threshold)
    found = set(zip(*(x.tolist() for x in negatives.Index(anchors, limits, longest).candidates(rows))))
    scores = rows @ anchors.T
    must = set(zip(*(x.tolist() for x in np.nonzero(scores >= limits))))
    assert must <= found
    if threshold >= 0.6:
        index = negatives.Index(anchors, limits, longest)
        assert index.groups.min() < negatives.GROUPS  # some dimensions are left out
        assert len(found) < scores.size / 2


def test_scores_are_exact_beyond_doubles():
    big = np.array([[float(negatives.LARGEST), 3.0], [float(negatives.LARGEST) - 1, 5.0]])
    pair = np.array([0, 1])
    got = negatives.exact_scores(big, big, pair, pair[::-1].copy())
    assert got.tolist() == [int(a[0]) * int(b[0]) + 15 for a, b in ((big[0], big[1]), (big[1], big[0]))]


def test_vectors_are_not_shuffled(spark, plan_of):
    df = spark.createDataFrame(near_rows(n=60), ROWS)
    rows = negatives.scaled_rows(df, "vec_id", "label", "embedding")
    shape = negatives.shape_of(rows)
    block = {"q": np.ones((1, 20)), "label": np.array([1]), "row": np.array([0])}
    windows = negatives.Windows(np.array([0]), np.array([negatives.NONE]), np.array([10**9]), 5, True)
    text = plan_of(negatives.search(rows, block, windows, np.array([1]), shape))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(window" in text
