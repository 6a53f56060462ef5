"""Language identification and the quality ensemble: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import langid, rule_ensemble
from sieveline.llm.queries import op5_language, op8_quality
from tests.llm.conftest import AWKWARD


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# language identification


def test_languages_of_held_out_documents(spark, sf_dir, documents):
    labels = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = op5_language(spark, sf_dir).collect()
    assert len(rows) == len(labels)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    right = sum(labels[r["doc_id"]] == r["lang_pred"] for r in tested)
    assert right >= 0.95 * len(tested)


def every_segmentation(word, pieces, p):
    """Summed probability of all ways to cut the marked word, and the expected uses of each piece."""
    marked = langid.START + word
    total, uses = 0.0, np.zeros(len(p))
    for cuts in itertools.product([False, True], repeat=len(marked) - 1):
        ends = [k + 1 for k, c in enumerate(cuts) if c] + [len(marked)]
        parts = [marked[a:b] for a, b in zip([0, *ends], ends)]
        numbers = [pieces.get(x, -2 if len(x) == 1 else None) for x in parts]
        if None in numbers:
            continue
        chance = math.prod(langid.UNKNOWN if k == -2 else p[k] for k in numbers)
        total += chance
        for k in numbers:
            if k >= 0:
                uses[k] += chance
    return total, uses / total


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    names = ["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "c"]
    pieces = langid.Pieces({n: k for k, n in enumerate(sorted(names))})
    p = np.array([rng.random() for _ in pieces])
    p /= p.sum()
    words = ["a", "abab", "babba", "cab", "dab", "abacabad"]
    logs = langid.word_logs(words, pieces, langid.padded(p[:, None]))[:, 0]
    counts = np.array([1.0, 2, 1, 3, 1, 1])
    expected = np.zeros(len(p))
    for word, log, n in zip(words, logs, counts, strict=True):
        total, uses = every_segmentation(word, pieces, p)
        assert log == pytest.approx(math.log(total))
        expected += n * uses
    assert langid.expected_counts(words, counts, pieces, p) == pytest.approx(expected)


def test_long_pieces_and_words_are_summed_in_full(monkeypatch):
    rng = random.Random(4)
    names = ["▁", "a", "b", "ab", "▁a", "abababababab", "abababababababab", "bbbbbbbbbbbbbbbbbbbb"]
    pieces = langid.Pieces({n: k for k, n in enumerate(sorted(names))})
    assert pieces.width == 20
    p = np.array([[rng.random(), rng.random()] for _ in pieces])
    p /= p.sum(axis=0)
    table = langid.padded(p)
    for word in ("ab" * 9, "b" * 20, "c" + "ab" * 8, "abababababababab"):
        logs = langid.word_logs([word], pieces, table)[0]
        for k in range(2):
            assert logs[k] == pytest.approx(math.log(every_segmentation(word, pieces, p[:, k])[0]))
    # one by one with rescaling, and together, long words have the same sums
    words = ["ab" * 15, "bc" * 10, "b" * 32, "a"]
    together = langid.word_logs(words, pieces, table)
    monkeypatch.setattr(langid, "SHORT", 0)
    assert langid.word_logs(words, pieces, table) == pytest.approx(together)
    # a sum over a run of any length: of one letter that is a piece alone, its power
    alone = langid.Pieces({"a": 0})
    logs = langid.word_logs(["a" * 5_000], alone, langid.padded(np.array([[0.25]])))[0, 0]
    assert logs == pytest.approx(math.log(langid.UNKNOWN) + 5_000 * math.log(0.25))


def test_all_usable_pieces_of_the_vocabulary_are_taken():
    pieces = langid.load_pieces(langid.VOCABULARY)
    assert pieces.width > 10 and all(p == langid.START or p.removeprefix(langid.START).isalpha() for p in pieces)


def test_letters_beside_numbers_are_words():
    assert langid.words_in("m² x½ ½ 3 Ⅷ a_b it's É") == ["m", "x", "a", "b", "it", "s", "é"]
    assert langid.words_in("² ½ ①") == [] == langid.words_in(None)


def test_scores_are_kept_in_bounded_memory(monkeypatch):
    model = langid.Model(langid.VOCABULARY, ["x", "y"], np.full((len(langid.load_pieces(langid.VOCABULARY)), 2), 1e-4))
    model.probabilities[::2, 0] *= 2
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + j)}" for j in range(9)) for k in range(40)]
    free = langid.Scorer(model).predict(texts)
    monkeypatch.setattr(langid, "MEMORY", 30)
    tight = langid.Scorer(model)
    assert [tight.predict([t])[0] for t in texts * 2] == free * 2 and len(tight.keys) <= 30
    assert langid.scorer_of(model) is langid.scorer_of(model)


def test_awkward_rows(awkward, documents):
    model = langid.fit(documents, sample=30, rounds=2)
    rows = langid.identify(awkward.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert all(by_id[k] == ("und", 0.0) for k in (3, 4, 5))
    assert by_id[8][0] in model.languages and 0 < by_id[8][1] <= 1
    assert by_id[6][0] in model.languages


def test_nothing_to_learn_from(awkward, no_docs):
    model = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.identify(awkward, model).collect()} == {"und"}
    assert langid.identify(no_docs, model).collect() == []


def test_held_out_rows_teach_nothing(documents):
    changed = documents.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in langid.fit(changed, sample=20, rounds=1).languages


# rule ensemble


def test_quality_of_held_out_documents(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = op8_quality(spark, sf_dir).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(labels[r["doc_id"]] == r["predicted"] for r in tested)
    assert right >= 0.85 * len(tested)


def test_compiled_score_is_the_weighted_rules(spark):
    low = rule_ensemble.Condition("upper", False, 0.2)
    high = rule_ensemble.Condition("digits", True, 0.1)
    ensemble = rule_ensemble.Ensemble(-0.5, ((frozenset([low]), 1.5), (frozenset([low, high]), -2.0)))
    rows = [(0.1, 0.05), (0.2, 0.3), (0.3, 0.3), (0.1, 0.1)]
    found = spark.createDataFrame(rows, "upper double, digits double").select("upper", "digits", ensemble.score().alias("s")).collect()
    for r in found:
        z = -0.5 + 1.5 * (r["upper"] <= 0.2) - 2.0 * (r["upper"] <= 0.2 and r["digits"] > 0.1)
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_paths_are_simplified():
    c = rule_ensemble.Condition
    path = [c("upper", True, 0.1), c("digits", False, 0.5), c("upper", True, 0.3), c("digits", False, 0.2), c("upper", False, 0.9)]
    assert rule_ensemble.simplified(path) == {c("upper", True, 0.3), c("digits", False, 0.2), c("upper", False, 0.9)}


def test_rules_of_a_planted_signal(spark):
    rng = random.Random(2)
    rows = [[rng.random() for _ in rule_ensemble.STATISTICS] for _ in range(600)]
    k = rule_ensemble.STATISTICS.index("symbols")
    table = spark.createDataFrame([(*r, int(r[k] <= 0.4)) for r in rows], [*rule_ensemble.STATISTICS, "y"])
    ensemble = rule_ensemble.fit_ensemble(table, "y")
    assert any(c.statistic == "symbols" for r, _ in ensemble.weights for c in r)
    scored = table.select("y", (ensemble.score() >= 0.5).cast("int").alias("p")).collect()
    assert sum(r["y"] == r["p"] for r in scored) >= 0.95 * len(scored)


def test_telling_rules_and_flags(spark):
    rng = random.Random(3)
    rows = [[rng.choice([0.0, 0.25, 0.5, 1.0]) for _ in rule_ensemble.STATISTICS] for _ in range(400)]
    rows += rows[:100]  # repeated rows
    table = spark.createDataFrame([(*r, int(r[0] > 0.3)) for r in rows], [*rule_ensemble.STATISTICS, "y"]).repartition(3)
    c = rule_ensemble.Condition
    name = list(rule_ensemble.STATISTICS)
    rules = [
        frozenset([c(name[0], True, 0.3)]),
        frozenset([c(name[0], True, 0.4)]),  # holds for the same rows
        frozenset([c(name[0], True, 0.3), c(name[3], False, 0.5)]),
        frozenset([c(name[1], True, 1.0)]),  # never holds
        frozenset([c(name[1], False, 1.0)]),  # always holds
    ]
    kept = rule_ensemble.telling_rules(table, rules, len(rows))
    assert kept == [rules[0], rules[2]]
    flags = {(r["_y"], tuple(r["_x"].toArray())): r["_n"] for r in rule_ensemble.flag_table(table, "y", kept).collect()}
    want = {}
    for r in rows:
        k = (float(r[0] > 0.3), (float(r[0] > 0.3), float(r[0] > 0.3 and r[3] <= 0.5)))
        want[k] = want.get(k, 0) + 1
    assert flags == want


def test_awkward_quality_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (7, None), (None, 1), (8, 0), (13, 0)], "doc_id long, quality int")
    rows = rule_ensemble.score_quality(awkward.withColumn("upper", F.lit("clash")), labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert rule_ensemble.score_quality(no_docs, labels).collect() == []
    none = labels.where("quality > 5")
    assert len({r["score"] for r in rule_ensemble.score_quality(awkward, none).collect()}) == 1
