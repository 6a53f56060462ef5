"""What filters remove together: a tensor of pass/fail counts per part, contracted for every order and step.

Each document fails or passes each of five filters. Its outcome is one cell of a 2x2x2x2x2 table, so whatever the number of
documents, a part is 32 counts (and as many of documents marked good and toxic). Every question about a filter order is a contraction
of that tensor: along each axis a vector selects pass, fail or all, and one ``einsum`` answers all steps of all orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.partenum import slices

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(raw: bytes, code_points: int) -> int:
    """The first four filters of one text as bits, A highest: short, repetitive, shouted, with symbols."""
    words = raw.split()
    short = len(words) < 200
    repetitive = 100 * len(set(words)) < 50 * len(words)
    shouted = 100 * (len(raw) - len(raw.translate(None, _UPPER))) > 3 * code_points
    symbols = len(raw.translate(None, _SYMBOLS)) < len(raw)
    return 8 * short + 4 * repetitive + 2 * shouted + symbols


def text_facts(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """(doc_id, part, digest, mask) per document: 128 bits of the text and the filters it fails. Texts are neither kept nor shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                digests, masks = [], []
                for body in rows.column(2).to_pylist():
                    raw = body.encode()
                    digests.append(hashlib.blake2b(raw, digest_size=16).digest())
                    masks.append(text_failures(raw, len(body)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                    names=["doc_id", "part", "digest", "mask"],
                )

    of_part = F.coalesce(F.col(part).cast("string"), F.lit(""))
    rows = docs.select(F.col(id).alias("doc_id"), of_part.alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int")


def contingency(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, and per measure its count among documents that pass and fail the last filter), at most 16 rows a part.

    The last filter asks whether a smaller id has the same text. Rows equal in id and text are counted first, then rows per text: a
    text that a third of the table repeats is a few rows before it is shuffled. Only digests, ids and bits are.
    """
    marks = (
        labels.select(F.col(id).alias("_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
        .groupBy("_id")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        .where("good or toxic")
    )
    facts = text_facts(docs, id, text, part).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = facts.join(marks, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "part", "digest", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    # per text and kind of row: how many rows, the smallest id, and how many rows have it
    grouped = marked.groupBy("digest", "part", "mask", "good", "toxic", F.col("doc_id").isNull().alias("without_id")).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least")
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    own = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(F.lit(0))
    same = F.when(F.col("without_id"), F.lit(0)).otherwise(F.col("n") - own)
    counted = grouped.withColumn("first", first).withColumn("fail", same).withColumn("pass", F.col("n") - F.col("fail"))
    among = {"n": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    return counted.groupBy("part", "mask").agg(
        *[F.sum(F.when(among[m], F.col(side)).otherwise(F.lit(0))).alias(f"{m}_{side}") for m in MEASURES for side in ("pass", "fail")]
    )


def selections(filters: str = FILTERS) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """All (order, step), and per question a vector for each of them and each axis: (steps, axes, 2)."""
    places = [("".join(order), step) for order in permutations(filters) for step in range(1, len(filters) + 1)]
    asked: dict[str, list] = {"removed": [], "kept": [], "failing": [], "alone": []}
    for order, step in places:
        before, here = set(order[: step - 1]), order[step - 1]
        asked["removed"].append([FAIL if f == here else PASS if f in before else ALL for f in filters])
        asked["kept"].append([PASS if f == here or f in before else ALL for f in filters])
        asked["failing"].append([FAIL if f == here else ALL for f in filters])
        asked["alone"].append([FAIL if f == here else PASS for f in filters])
    return places, {name: np.array(rows, np.int64) for name, rows in asked.items()}


def contracted(tensor: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Counts by (measure, step): the tensor with a vector of each step put into each axis."""
    axes = "abcdefghij"[: vectors.shape[1]]
    return np.einsum(f"q{axes},{','.join(f'n{x}' for x in axes)}->qn", tensor, *np.moveaxis(vectors, 1, 0), optimize=True)


def interactions(cells: DataFrame) -> DataFrame:
    """The audit of every part from its cells: one row per part, order of the filters and step."""

    def audited(group: pd.DataFrame) -> pd.DataFrame:
        places, asked = selections()
        tensor = np.zeros((len(MEASURES), 16, 2), np.int64)
        for k, m in enumerate(MEASURES):
            tensor[k, group["mask"], 0] = group[f"{m}_pass"]
            tensor[k, group["mask"], 1] = group[f"{m}_fail"]
        tensor = tensor.reshape(len(MEASURES), *[2] * len(FILTERS))
        found = {name: contracted(tensor, vectors) for name, vectors in asked.items()}
        removed = found["removed"]
        here = np.array([FILTERS.index(order[step - 1]) for order, step in places])
        shapley = np.array([removed[0][here == k].sum() for k in range(len(FILTERS))])
        return pd.DataFrame(
            {
                "part": group["part"].iloc[0],
                "filter_order": [order for order, _ in places],
                "step": [step for _, step in places],
                "kept": found["kept"][0],
                "removed": removed[0],
                "redundant": found["failing"][0] - removed[0],
                "unique_fails": found["alone"][0],
                "good_lost": removed[1],
                "toxic_lost": removed[2],
                "shapley": shapley[here],
            }
        )

    return cells.groupBy("part").applyInPandas(audited, RESULT)


def audit_filters(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of five filters and step: what the filter at that step removes, keeps and would have removed.

    Filters fail a text: A with under 200 words; B if under half of its words are distinct; C if over 3 % of its code points are A-Z; D
    with any of ``#$%&*|``; E if a smaller id has the same text. Words are runs of other than blanks.

    Null texts are empty, and equal to empty ones. Null parts and empty ones are one part, the empty string. A row without id fails
    E never and makes no other fail it; rows repeated in id and text pass E together. A document is good or toxic if any label row of its id
    says 1; null labels say nothing. An empty table has no parts, so no rows. Other columns are not read.
    """
    return interactions(contingency(docs, labels, id, text, part))
