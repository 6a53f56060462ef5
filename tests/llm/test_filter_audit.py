"""The audit against applying the filters one after another, document by document."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import filter_audit
from sieveline.llm.queries import op13_filter_audit
from tests.llm import brute
from tests.llm.conftest import AWKWARD, DOCS, row

LABELS = "doc_id long, quality int, toxic int"


def failed(docs):
    """Per row the set of filters its text fails."""
    smallest = {}
    for d, t in docs:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    out = []
    for d, t in docs:
        t, w = t or "", brute.words(t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if d is not None and d > smallest[t]:
            fails.add("E")
        out.append(fails)
    return out


def expected(docs, parts, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = failed(docs)
    rows = {}
    for part in {p or "" for p in parts}:
        own = [(d, f) for (d, _), f, p in zip(docs, fails, parts) if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                kept = [x for x in left if name not in x[1]]
                shapley[name] += len(gone)
                redundant = sum(name in f for _, f in own) - len(gone)
                alone = sum(f == {name} for _, f in own)
                lost = [sum(d in marked for d, _ in gone) for marked in (good, toxic)]
                rows[part, order, step] = [len(kept), len(gone), redundant, alone, *lost]
                left = kept
        for (p, order, step), values in rows.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def found(df):
    rows = df.collect()
    out = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_documents(spark, sf_dir, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    want = expected([d[:2] for d in docs], [d[2] for d in docs], labels)
    assert found(op13_filter_audit(spark, sf_dir)) == want


def test_awkward_rows(spark, awkward):
    extra = [row(k, "copy", "en") for k in range(40, 60)] + [row(30, "copy", "zz"), row(30, "copy", "zz"), row(None, "copy", "zz")]
    labels = [(1, 1, 0), (2, None, 1), (2, 1, None), (40, 1, 1), (40, 0, 0), (30, 1, None), (None, 1, 1), (99, 1, 1), (9, None, None)]
    rows = AWKWARD + extra
    docs = awkward.unionByName(spark.createDataFrame(extra, DOCS)).withColumns({c: F.lit("x") for c in ("part", "mask", "digest", "n", "good", "first")})
    marks = spark.createDataFrame(labels, LABELS).withColumn("_id", F.lit(1)).withColumn("text", F.lit(1))
    want = expected([(r[0], r[1]) for r in rows], [r[2] for r in rows], labels)
    assert found(filter_audit.audit_filters(docs, marks)) == want


def test_empty_tables(spark, no_docs, awkward):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(no_docs, none).count() == 0
    rows = filter_audit.audit_filters(awkward, none).collect()
    assert rows and all(r["good_lost"] == 0 and r["toxic_lost"] == 0 for r in rows)


def test_counts_of_each_order_add_up(spark, sf_dir):
    """All orders keep the same documents, and what the steps remove adds up to what is not kept."""
    per_order = {}
    for (part, order, step), values in found(op13_filter_audit(spark, sf_dir)).items():
        per_order.setdefault((part, order), {})[step] = values
    for steps in per_order.values():
        total = steps[1][0] + steps[1][1]
        assert sum(v[1] for v in steps.values()) == total - steps[5][0]
    for part in {p for p, _ in per_order}:
        assert len({steps[5][0] for (p, _), steps in per_order.items() if p == part}) == 1


@pytest.mark.parametrize("axes", [2, 3, 5])
def test_contraction_is_a_filtered_sum(axes):
    rng = np.random.default_rng(axes)
    tensor = rng.integers(0, 1 << 40, (3, *[2] * axes))
    places, asked = filter_audit.selections("ABCDE"[:axes])
    for vectors in asked.values():
        got = filter_audit.contracted(tensor, vectors)
        for n in rng.integers(0, len(places), 10):
            weight = np.ones([2] * axes, np.int64)
            for axis in range(axes):
                weight = weight * vectors[n, axis].reshape([2 if k == axis else 1 for k in range(axes)])
            assert (got[:, n] == (tensor * weight).reshape(3, -1).sum(axis=1)).all()


def test_a_hot_text_is_few_rows(spark):
    """A text that most rows repeat comes to one cell per part, with all but the smallest id failing."""
    docs = spark.range(5_000).selectExpr("id as doc_id", "'same text' as text", "if(id % 2 = 0, 'a', null) as lang")
    cells = filter_audit.contingency(docs, spark.createDataFrame([], LABELS)).collect()
    assert {(r["part"], r["n_pass"], r["n_fail"]) for r in cells} == {("a", 1, 2_499), ("", 0, 2_500)}
