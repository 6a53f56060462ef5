"""The similarity join against all pairs, and the guarantee of its signatures."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sieveline.llm import partenum
from sieveline.llm.components import connected
from sieveline.llm.queries import op7_jaccard
from sieveline.llm.stages import by_similarity
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def test_documents(spark, sf_dir, texts):
    rows = op7_jaccard(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.components(texts.items())


def near_copies(seed=11, families=12, copies=14):
    """Families of texts of many sizes with few edits, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    docs = []
    for f in range(families):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([4, 8, 10, 12, 30, 60, 150, 400]))]
        shared = [f"passage{k}" for k in range(25)]
        for _ in range(copies):
            words = list(base) + (shared if rng.random() < 0.4 else [])
            for _ in range(rng.randrange(0, 1 + len(words) // 25 + 2)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [f"x{rng.randrange(10**6)}"] * rng.randrange(2)
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [partenum.GROUP_SHINGLES, 300])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(partenum, "GROUP_SHINGLES", block)
    monkeypatch.setattr(partenum, "GROUP_SETS", partenum.GROUP_SETS if block > 300 else 3)
    monkeypatch.setattr(partenum, "BROADCAST_BYTES", partenum.BROADCAST_BYTES if block > 300 else 0)
    docs = near_copies()
    expected = brute.components(docs)
    assert 20 < len({c for _, c in expected.values()}) < len(docs) - 20
    found = partenum.similarity_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [*range(6, 40), 60, 83, 84, 117, 250, 999, 4000]:
        base = rng.integers(0, 1 << 63, size).astype(np.uint64)
        for other in {size, size + 1, size * 100 // 85, max(6, size - 1)}:
            most = partenum.most_different(size + other)
            gone = (most + size - other) // 2
            if gone < 0 or gone > size or other - (size - gone) < 0:
                continue
            kept = rng.permutation(base)[: size - gone]
            near = np.concatenate([kept, rng.integers(0, 1 << 63, other - len(kept)).astype(np.uint64)])
            if 100 * len(kept) < 85 * (size + other - len(kept)):
                continue
            found, owner = partenum.signatures(np.concatenate([base, near]), np.array([size, other]))
            assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist()), (size, other)


def pairs_linked(spark, pairs, **how):
    """Whether the two texts of each pair are in one component."""
    docs = [(2 * k + side, text) for k, pair in enumerate(pairs) for side, text in enumerate(pair)]
    rows = partenum.similarity_classes(spark.createDataFrame(docs, "doc_id long, text string"), **how).collect()
    component = {r["doc_id"]: r["component_id"] for r in rows}
    return [component[2 * k] == component[2 * k + 1] for k in range(len(pairs))]


def test_small_sets_at_the_threshold(spark):
    text = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    pairs = [(text(name, n), text(name, n + 1)) for name, n in (("a", 7), ("b", 8), ("c", 9), ("d", 10))]  # 3/4, 4/5, 5/6, 6/7 shingles
    assert pairs_linked(spark, pairs, words=5, percent=80) == [False, True, True, True]
    assert [partenum.smallest_band(p) for p in (50, 80, 85, 90, 100)] == [1, 4, 6, 9, 100]


def test_words_of_a_shingle_have_an_order():
    texts = pa.array(["a b c d e", "e b c d a", "a e c d b"])
    elements, _ = partenum.shingle_sets(texts, 5)
    assert len(set(elements.tolist())) == 3


def test_near_copies_by_five_words(spark):
    docs = near_copies(seed=12)
    cut = [t.split() for _, t in docs]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in cut]
    root = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    rows = partenum.similarity_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), words=5, percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(root))


def test_stage_drops_copies_with_scattered_edits(spark):
    docs = []
    for k, (n, edits) in enumerate([(1000, 22), (500, 11), (1000, 23)]):
        words = [f"t{k}w{i}" for i in range(n)]
        changed = list(words)
        for e in range(edits):
            changed[(2 * e + 1) * n // (2 * edits)] = f"x{k}e{e}"
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
    kept = by_similarity(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 5]


def test_distant_sets_share_none():
    rng = np.random.default_rng(4)
    sizes = np.full(60, 500)
    found, owner = partenum.signatures(rng.integers(0, 1 << 63, sizes.sum()).astype(np.uint64), sizes)
    shared = len(found) - len(np.unique(found))
    assert shared < 60 and len(found) / sizes.sum() < 0.6


def test_shingle_sets_of_short_and_null_texts():
    texts = pa.array(["A b c", "a B\tc ", "c b a", None, "", " \n", "a b c d a b c d a b c d", "é É"])
    elements, sizes = partenum.shingle_sets(texts)
    assert sizes.tolist() == [1, 1, 1, 0, 0, 0, 4, 1]
    one, two = partenum.set_keys(elements, sizes)
    assert one[0] == one[1] and two[0] == two[1] and one[0] != one[2]


def test_awkward_rows(awkward):
    rows = partenum.similarity_classes(awkward.withColumn("key", F.lit("clash"))).collect()
    assert len(rows) == len(AWKWARD)
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert found[2, 17] == 1 and found[1, 17] == 1
    assert found[3, 0] == 3 and found[4, 0] == 4 and found[5, 0] == 5
    assert all(c is None for (d, _), c in found.items() if d is None)


def test_one_of_each_group_stays(awkward):
    clashing = awkward.withColumns({"place": F.lit("p"), "_hash": F.lit("h"), "stays": F.lit("s")})
    rows = partenum.without_similar(clashing)
    assert rows.columns == clashing.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in rows.collect())
    assert ids == [-1, 1, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, 16]  # 2 and 10 are near copies of 1


def test_empty(no_docs):
    assert partenum.similarity_classes(no_docs).collect() == []
    assert partenum.without_similar(no_docs).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 101 + k) for k in range(50)] + [(200, 200), (None, 5), (300, 301), (301, 300)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 151)} | {300: 300, 301: 300}
    assert found == expected


def test_sketches_differ_at_most_as_much_as_sets():
    rng = np.random.default_rng(5)
    for size in (5, 30, 64, 65, 250, 3000, 60_000):
        base = rng.integers(0, 1 << 63, size).astype(np.uint64)
        near = np.concatenate([rng.permutation(base)[: size - size // 9], rng.integers(0, 1 << 63, size // 7).astype(np.uint64)])
        sizes = np.array([size, len(near)])
        one, two = (np.frombuffer(x, np.uint8).astype(np.int64) for x in partenum.sketches(np.concatenate([base, near]), sizes).to_pylist())
        buckets = min(len(one), len(two))
        differ = np.abs(partenum.folded(one, buckets) - partenum.folded(two, buckets)).sum()
        assert differ <= len(np.setxor1d(base, near))
        assert size < 30 or differ > 0
    # a folded sketch is the sketch of fewer buckets, counts beyond a byte included
    many = rng.integers(0, 1 << 63, 400_000).astype(np.uint64)
    wide = np.frombuffer(partenum.sketches(many, np.array([len(many)]))[0].as_py(), np.uint8).astype(np.int64)
    assert wide.max() == 255 and (partenum.folded(wide, 16) == 255).all()


def test_similar_sketches_leave_out_no_link():
    rng = random.Random(9)
    docs = [t for _, t in near_copies(seed=13)]
    elements, sizes = partenum.shingle_sets(pa.array(docs), 4)
    keys = partenum.binary_keys(*partenum.set_keys(elements, sizes)).to_pylist()
    found = partenum.sketches(elements, sizes).to_pylist()
    order = [k for k in range(len(docs)) if sizes[k]]
    rng.shuffle(order)
    pairs = partenum.similar_sketches([keys[k] for k in order], [int(sizes[k]) for k in order], [found[k] for k in order], 85)
    root = {k: k for k in keys}

    def top(k):
        return k if root[k] == k else top(root[k])

    for a, b in pairs:
        root[top(a)] = top(b)
    starts = np.cumsum(sizes) - sizes
    sets = [set(elements[s : s + n].tolist()) for s, n in zip(starts, sizes)]
    links = 0
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                links += 1
                assert top(keys[a]) == top(keys[b])
    assert links > 100 and len({top(k) for k in keys}) > 20


def test_links_among_a_cluster_and_others_equal_all_pairs():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 100 - k % 12], rng.integers(0, 1 << 63, k % 5).astype(np.uint64)])) for k in range(60)]
    keys = [bytes([k]) for k in range(60)]
    root = list(range(60))
    for a in range(60):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    forest = partenum.Forest(60)
    for a, b in partenum.links_among(keys, sets, 85):
        forest.link(a[0], b[0])
    assert {(a, b) for a in range(60) for b in range(60) if forest.top(a) == forest.top(b)} == {(a, b) for a in range(60) for b in range(60) if root[a] == root[b]}
