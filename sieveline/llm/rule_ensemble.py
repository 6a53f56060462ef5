"""A quality classifier as a sparse ensemble of rules.

Trees grown on text statistics give conjunctive rules (the conditions on the way to each node), a logistic model
with an L1 penalty keeps few of them with weights, and the result is compiled into one column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.partenum import mixed, slices
from sieveline.sources.scratch import discard, written

STATISTICS = (
    "log_words",
    "mean_word",
    "distinct_words",
    "top_word",
    "adjacent_repeats",
    "upper",
    "digits",
    "symbols",
    "pipes",
    "stops",
    "commas",
    "exclamations",
    "brackets",
    "non_ascii",
    "log_lines",
    "line_words",
    "repeated_lines",
    "capital_lines",
    "stopped_lines",
)
#: Expected number of labelled rows the ensemble is fitted on.
SAMPLE = 20_000
TREES, DEPTH, PENALTY = 20, 4, 0.002
#: Rules that hold for fewer rows of the sample, or fail for fewer, get no weight. Tasks that fit on the bounded sample.
LEAST_ROWS, FIT_TASKS = 5, 6
THRESHOLD = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&<>@^~=+_\\", np.uint8)
_BRACKETS = np.frombuffer(b"{}[]()", np.uint8)


def statistics_of(text: str | None) -> tuple[float, ...]:
    """:data:`STATISTICS` of one text, all finite; those of an empty text for null. Shares are per byte, word or line."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, w, k = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    forms: dict[bytes, int] = {}
    for word in words:
        forms[word] = forms.get(word, 0) + 1
    repeats = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
    return (
        float(np.log1p(len(words))),
        sum(map(len, words)) / w,
        len(forms) / w,
        max(forms.values(), default=0) / w,
        repeats / w,
        counts[65:91].sum() / n,
        counts[48:58].sum() / n,
        counts[_SYMBOLS].sum() / n,
        counts[ord("|")] / w,
        counts[ord(".")] / w,
        counts[ord(",")] / w,
        counts[ord("!")] / w,
        counts[_BRACKETS].sum() / n,
        counts[128:].sum() / n,
        float(np.log1p(len(lines))),
        len(words) / k,
        1 - len(set(lines)) / k if lines else 0.0,
        sum(x.strip()[:1].isupper() for x in lines) / k,
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / k,
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without the text, and one double per statistic. Texts are neither kept nor shuffled."""
    kept = [c for c in docs.columns if c != text and c not in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                rows = np.array([statistics_of(t) for t in part.column(0).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
                new = [pa.array(rows[:, k]) for k in range(len(STATISTICS))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *new], names=[*kept, *STATISTICS])

    rows = docs.select(text, *kept)
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept), *(f"{s} double" for s in STATISTICS)]
    return rows.mapInArrow(run, ", ".join(fields))


@dataclass(frozen=True)
class Condition:
    """A statistic is at most, or above, a threshold."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, limit = F.col(self.statistic), F.lit(self.threshold)
        return value > limit if self.above else value <= limit


Rule = frozenset[Condition]


def simplified(path: list[Condition]) -> Rule:
    """The tightest condition per statistic and side."""
    tight: dict[tuple[str, bool], Condition] = {}
    for c in path:
        old = tight.get((c.statistic, c.above))
        if old is None or (c.threshold > old.threshold) == c.above:
            tight[c.statistic, c.above] = c
    return frozenset(tight.values())


def rules_of(model: RandomForestClassificationModel, statistics: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The path to every node but the roots, each rule once, in a fixed order."""
    found: set[Rule] = set()

    def walk(node, path: list[Condition]) -> None:
        if path:
            found.add(simplified(path))
        if node.numDescendants() > 0:
            split = node.split()
            name, limit = statistics[split.featureIndex()], split.threshold()
            walk(node.leftChild(), [*path, Condition(name, False, limit)])
            walk(node.rightChild(), [*path, Condition(name, True, limit)])

    for tree in model._java_obj.trees():
        walk(tree.rootNode(), [])
    return sorted(found, key=lambda r: sorted((c.statistic, c.above, c.threshold) for c in r))


def holds(rule: Rule) -> Column:
    ordered = sorted(rule, key=lambda c: (c.statistic, c.above))
    return reduce(lambda a, b: a & b, [c.column() for c in ordered])


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and an intercept; without rules the score is the same for all."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as one expression over the statistics."""
        terms = [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.weights]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def flags_of(batch: pa.RecordBatch, rules: list[Rule]) -> np.ndarray:
    """Which rule holds for which row: (rows, rules). Each condition is evaluated once."""
    columns = {name: batch.column(k).to_numpy(zero_copy_only=False) for k, name in enumerate(batch.schema.names)}
    met: dict[Condition, np.ndarray] = {}
    for c in {c for r in rules for c in r}:
        met[c] = columns[c.statistic] > c.threshold if c.above else columns[c.statistic] <= c.threshold
    out = np.ones((batch.num_rows, len(rules)), bool)
    for k, rule in enumerate(rules):
        for c in rule:
            out[:, k] &= met[c]
    return out


def telling_rules(rows: DataFrame, rules: list[Rule], total: int, least: int = LEAST_ROWS) -> list[Rule]:
    """The rules that hold, and fail, for at least ``least`` rows; of rules that hold for the same rows the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(rules)), np.int64)
        for batch in batches:
            flags = flags_of(batch, rules).astype(np.int64)
            row = np.zeros(batch.num_rows, np.uint64)
            for column in batch.columns:
                row = mixed(row ^ column.to_numpy(zero_copy_only=False).view(np.uint64))
            low, high = (row & np.uint64(0xFFFFFFFF)).astype(np.int64), (row >> np.uint64(32)).astype(np.int64)
            sums += np.stack([flags.sum(axis=0), low @ flags, high @ flags])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rules))), *[pa.array(x) for x in sums]], names=["rule", "n", "low", "high"])

    parts = rows.select(*STATISTICS).mapInArrow(run, "rule long, n long, low long, high long").groupBy("rule")
    kept, seen = [], set()
    for r in sorted(parts.agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")).collect()):  # one row per rule
        if least <= r["n"] <= total - least and tuple(r[1:]) not in seen:
            seen.add(tuple(r[1:]))
            kept.append(rules[r["rule"]])
    return kept


def flag_table(rows: DataFrame, label: str, rules: list[Rule]) -> DataFrame:
    """(_y, _n, _x): each distinct vector of flags with its label and how many rows have it."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.packbits(flags_of(batch.select(list(STATISTICS)), rules), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in bits], pa.binary())], names=["_y", "_bits"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            values = np.unpackbits(raw, axis=1, count=len(rules)).astype(np.float64)
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * len(rules), values.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["_y", "_n", "_flags"])

    given = rows.select(F.col(label).cast("double").alias("_y"), *STATISTICS)
    counted = given.mapInArrow(packed, "_y double, _bits binary").groupBy("_y", "_bits").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    table = counted.select("_y", "_n", "_bits").mapInArrow(spread, "_y double, _n double, _flags array<double>")
    return table.select("_y", "_n", array_to_vector("_flags").alias("_x"))


def fit_ensemble(rows: DataFrame, label: str, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 2023) -> Ensemble:
    """Fit on rows with the statistics and a 0/1 label without nulls. One class, or no row, gives an ensemble without rules.

    Meant for a bounded sample. The weights are fitted on the distinct vectors of flags, each with its number of rows, in few tasks.
    """
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("ones")).first()
    n, ones = totals["n"], totals["ones"] or 0
    constant = Ensemble(float(np.log((ones + 0.5) / (n - ones + 0.5))), ())
    if ones in (0, n):
        return constant
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="_x").transform(rows.withColumn("_y", F.col(label).cast("double")))
    forest = RandomForestClassifier(
        labelCol="_y", featuresCol="_x", numTrees=trees, maxDepth=depth, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed
    ).fit(vectors)
    rules = telling_rules(rows, rules_of(forest), n)
    if not rules:
        return constant
    table = written(flag_table(rows, label, rules).coalesce(FIT_TASKS), "flags")
    lasso = LogisticRegression(
        labelCol="_y", featuresCol="_x", weightCol="_n", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100
    ).fit(table)
    discard(table)
    weights = zip(rules, lasso.coefficients.toArray().tolist(), strict=True)
    return Ensemble(float(lasso.intercept), tuple((r, w) for r, w in weights if w != 0.0))


def held_out(id: str) -> Column:
    """Documents no model may be fitted on: CRC32 of the id as text leaves no rest modulo 5. A null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def score_quality(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The ensemble is fitted on labelled rows that are not held out, about ``sample`` of them, chosen by a hash of the id if there
    are more. Every whole text is scored. Null labels are not learned from; a null text counts as empty; null ids are
    scored and never learned from; repeated documents get repeated scores. Other columns are not read.
    """
    stats = written(with_statistics(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text")), "_text"), "statistics")
    known = labels.select(F.col(id).alias("doc_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    open_known = known.where(~held_out("doc_id"))
    total = open_known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    chosen = open_known.where(draw * max(total, 1) < sample)
    # as many rows as the sample: a broadcast and a shuffle of bounded size
    rows = written(stats.join(F.broadcast(chosen), "doc_id").repartition(FIT_TASKS), "labelled")
    ensemble = fit_ensemble(rows, "_label")
    discard(rows)
    return stats.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        ensemble.score().alias("score"),
        (ensemble.score() >= THRESHOLD).cast("int").alias("predicted"),
    )
