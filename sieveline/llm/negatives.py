"""Hard negatives by threshold joins in the style of L2AP.

Each anchor asks for the best rows inside windows of scores: first for its positives (same label, any score), then, per positive, for
negatives (another label, between two shares of the positive's score). A window is searched from above: rows that score at least
a threshold are joined, and while a window holds too few of them its threshold is lowered, at last to the end of the window.

The join keeps an inverted index over a block of anchors. Dimensions are taken in one order for all, those of most energy first. Of
an anchor the index leaves out the last dimensions, as many as the bound allows: where the norm of that suffix times the longest row is
below the threshold, no row reaches the threshold without the indexed ones. Anchors are ordered by the number of their indexed
dimensions, so the list of a dimension is a run of them, and partial scores of many rows are one matrix product per group of
dimensions. After each group a pair whose partial score plus the product of the remaining norms is below its threshold is
dropped; once few are left they are finished one by one.

The anchors are the stated query set: they are dealt into blocks of bounded bytes, and each block goes over all rows in passes that
shuffle no vectors. A task keeps at most the wanted number of rows per window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.sources.scratch import discard, scratch_path, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of negatives, in percent of the score of the positive.
LOW, HIGH = 30, 90
#: Scaled components beyond this count as this, so that scores of up to 2048 dimensions fit a long.
LARGEST = 1 << 26
#: Bytes of the vectors of one block of anchors, and partial scores held at a time.
BLOCK_BYTES, TILE_CELLS = 8 << 20, 2_000_000
#: How far up its range a window is searched, pass by pass.
STEPS = (0.7, 0.35, 0.0)
#: Groups that the dimensions are added up in, and the share of pairs below which the rest are finished one by one.
GROUPS, FEW = 4, 0.1
#: Rows kept per window and task before the best are picked.
SLACK = 4

NONE = -(1 << 62)
SHAPE = "window int, score long, vec_id {kind}, row long"


def scaled_rows(embeddings: DataFrame, id: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, q) of the rows that take part, components scaled to whole numbers; ``row`` tells repeated rows apart."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    values = F.transform(F.col(vector), lambda v: v.cast("double"))
    whole = lambda v: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v * scale))).cast("int")
    given = embeddings.select(F.col(id).alias("vec_id"), F.col(label).alias("label"), values.alias("x"))
    sound = given.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return sound.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform("x", whole).alias("q"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a list column as rows, shorter ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


@dataclass(frozen=True)
class Shape:
    """What all rows have in common: dimensions in order of their energy, and the largest norm."""

    order: np.ndarray
    longest: float


def shape_of(rows: DataFrame) -> Shape:
    """One pass; a task sends one number per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        energy, longest = np.zeros(0), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            own = matrix(batch.column(0), int(sizes.max())) ** 2
            longest = max(longest, float(np.sqrt(own.sum(axis=1).max()))) if own.size else longest
            both = np.zeros(max(len(energy), own.shape[1]))
            both[: len(energy)] += energy
            both[: own.shape[1]] += own.sum(axis=0)
            energy = both
        dims = np.arange(len(energy), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(energy), pa.array(np.full(len(dims), longest))], names=["dim", "energy", "longest"])

    parts = rows.select("q").mapInArrow(run, "dim int, energy double, longest double")
    found = parts.groupBy("dim").agg(F.sum("energy").alias("energy"), F.max("longest").alias("longest")).collect()  # one row per dimension
    energy = np.zeros(len(found))
    for r in found:
        energy[r["dim"]] = r["energy"]
    return Shape(np.argsort(-energy, kind="stable"), max((r["longest"] for r in found), default=0.0))


@dataclass
class Windows:
    """The windows of a block of anchors, in the order of the anchors; one wants ``wanted`` rows from ``low`` to ``high``."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    wanted: int
    same: bool


class Index:
    """Inverted index over anchors for the least threshold of each; dimensions are in the order of the shape."""

    def __init__(self, vectors: np.ndarray, thresholds: np.ndarray, longest: float):
        dims = vectors.shape[1]
        bounds = np.unique(np.linspace(0, dims, GROUPS + 1).astype(int)) if dims else np.array([0])
        rest = suffix_norms(vectors)
        # the norms are rounded: a little less is asked for than the threshold
        self.asked = thresholds - 1e-9 * rest[:, 0] * longest - 1e-6
        # the first group boundary behind which an anchor reaches its threshold with no row; all are indexed if it is not positive
        within = (rest[:, bounds] * longest < self.asked[:, None]) & (self.asked > 0)[:, None]
        groups = np.where(within.any(axis=1), within.argmax(axis=1), len(bounds) - 1)
        self.order = np.argsort(-groups, kind="stable")
        self.groups, self.bounds = groups[self.order], bounds
        self.vectors, self.rest, self.asked = vectors[self.order], rest[self.order], self.asked[self.order]

    def candidates(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all pairs that may reach the threshold of the anchor."""
        rest = suffix_norms(rows)
        partial = np.zeros((len(rows), len(self.vectors)))
        ends = self.bounds[self.groups]
        for g in range(len(self.bounds) - 1):
            listed = int(np.searchsorted(-self.groups, -g, side="left"))  # anchors that index this group
            if not listed:
                break
            a, b = self.bounds[g], self.bounds[g + 1]
            partial[:, :listed] += rows[:, a:b] @ self.vectors[:listed, a:b].T
            if b < self.bounds[-1]:
                row, anchor = np.nonzero(partial + rest[:, np.minimum(ends, b)] * self.rest[np.arange(len(ends)), np.minimum(ends, b)] >= self.asked)
                if len(row) <= FEW * partial.size:
                    return row, self.order[anchor]
        row, anchor = np.nonzero(partial + rest[:, ends] * self.rest[np.arange(len(ends)), ends] >= self.asked)
        return row, self.order[anchor]


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm of what follows each place, from the whole vector to nothing."""
    squares = np.cumsum(vectors[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(vectors), 1))]))


def exact_scores(rows: np.ndarray, anchors: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products of the pairs, as whole numbers: in doubles where those add up exactly, else in longs."""
    dims = rows.shape[1]
    largest = max(np.abs(rows).max(initial=0), np.abs(anchors).max(initial=0))
    if dims * largest * largest >= 1 << 53:
        rows, anchors = rows.astype(np.int64), anchors.astype(np.int64)
    out = np.empty(len(row), np.int64)
    step = max(1, TILE_CELLS // max(dims, 1))
    for k in range(0, len(row), step):
        out[k : k + step] = np.einsum("ij,ij->i", rows[row[k : k + step]], anchors[anchor[k : k + step]])
    return out


def best(found: list[np.ndarray], wanted: int) -> list[np.ndarray]:
    """Of (window, score, no id, id, row) the first rows of each window: larger scores, smaller ids, rows without id last."""
    window, score, absent, id, row = found
    order = np.lexsort((row, id, absent, -score, window))
    sorted_windows = window[order]
    first = np.searchsorted(sorted_windows, sorted_windows, side="left")
    kept = order[np.arange(len(order)) - first < wanted]
    return [c[kept] for c in found]


def search(rows: DataFrame, block: dict, windows: Windows, thresholds: np.ndarray, shape: Shape) -> DataFrame:
    """(window, score, vec_id, row): per window its best rows that reach the threshold, at most ``wanted``.

    ``block`` has the vectors, labels and rows of the anchors. One pass over all rows, no shuffle of vectors.
    """
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast((block, windows, thresholds, shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, asked, limits, common = sent.value
        limits = limits.copy()
        anchors = own["q"][:, common.order]
        used = np.unique(asked.anchor)
        first = np.searchsorted(asked.anchor, used, side="left")
        number = np.bincount(asked.anchor, minlength=len(anchors))
        starts = np.cumsum(number) - number
        index = Index(anchors[used], np.minimum.reduceat(limits, first).astype(np.float64), common.longest) if len(used) else None
        tile = max(1, TILE_CELLS // max(len(used), 1))
        kept: list[np.ndarray] = [np.empty(0, np.int64) for _ in range(5)]
        waiting: list[list[np.ndarray]] = []
        held, id_type = 0, None

        def settle() -> None:
            nonlocal kept, held
            kept = best([np.concatenate([kept[c], *[w[c] for w in waiting]]) for c in range(5)], asked.wanted)
            waiting.clear()
            held = 0
            # a window that is full here wants nothing below its last row
            full, count = np.unique(kept[0], return_counts=True)
            last = np.cumsum(count) - 1
            limits[full[count == asked.wanted]] = kept[1][last[count == asked.wanted]]

        for batch in batches:
            id_type = batch.schema.field(1).type
            if index is None or not batch.num_rows:
                continue
            row_number, label = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            absent = batch.column(1).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = matrix(batch.column(3), len(common.order))[:, common.order]
            for k in range(0, len(vectors), tile):
                part = vectors[k : k + tile]
                row, anchor = index.candidates(part)
                anchor, row = used[anchor], row + k
                fits = (label[row] == own["label"][anchor]) == asked.same
                fits &= row_number[row] != own["row"][anchor]
                row, anchor = row[fits], anchor[fits]
                score = exact_scores(vectors, anchors, row, anchor)
                times = number[anchor]
                window = np.repeat(starts[anchor] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                row, score = np.repeat(row, times), np.repeat(score, times)
                inside = (score >= limits[window]) & (score <= asked.high[window])
                row, score, window = row[inside], score[inside], window[inside]
                if len(row):
                    waiting.append([window, score, absent[row], ids[row], row_number[row]])
                    held += len(row)
                    if held > SLACK * asked.wanted * len(limits) + TILE_CELLS // 8:
                        settle()
        if waiting:
            settle()
        if len(kept[0]):
            found_ids = pa.array(kept[3], mask=kept[2].astype(bool)).cast(id_type)
            columns = [pa.array(kept[0].astype(np.int32)), pa.array(kept[1]), found_ids, pa.array(kept[4])]
            yield pa.RecordBatch.from_arrays(columns, names=["window", "score", "vec_id", "row"])

    found = rows.select("row", "vec_id", "label", "q").mapInArrow(run, SHAPE.format(kind=kind))
    place = Window.partitionBy("window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= windows.wanted)


def filled(rows: DataFrame, block: dict, windows: Windows, shape: Shape, path: str) -> list[DataFrame]:
    """The rows of all windows, searched from above; each pass lowers the threshold of the windows that hold too few."""
    spark = rows.sparkSession
    norms = np.sqrt((block["q"] ** 2).sum(axis=1))
    top = np.minimum(windows.high, np.ceil(norms[windows.anchor] * shape.longest).astype(np.int64) + 1)
    open_windows = np.nonzero(windows.high >= windows.low)[0]
    tables = []
    for step in STEPS:
        if not len(open_windows):
            break
        low, high = windows.low[open_windows], top[open_windows]
        base = np.where(low == NONE, 0, low)
        limit = np.where(step > 0, np.maximum(low, base + np.ceil((high - base) * step).astype(np.int64)), low)
        part = Windows(windows.anchor[open_windows], low, windows.high[open_windows], windows.wanted, windows.same)
        names = spark.createDataFrame(
            pa.table({"window": np.arange(len(open_windows), dtype=np.int32), "whole": open_windows.astype(np.int32), "ended": limit <= low})
        )
        # one row per window of the block
        found = search(rows, block, part, limit, shape).join(F.broadcast(names), "window")
        place = f"{path}/pass{len(tables)}"
        found.withColumn("n", F.max("rank").over(Window.partitionBy("window"))).write.parquet(place)
        table = spark.read.parquet(place)
        tables.append(table.where((F.col("n") >= windows.wanted) | F.col("ended")).select(F.col("whole").alias("window"), "rank", "score", "vec_id", "row"))
        full = table.where((F.col("rank") == 1) & (F.col("n") >= windows.wanted)).select("whole").toArrow()["whole"].to_numpy()
        open_windows = np.setdiff1d(open_windows[limit > low], full)
    return tables


def _read(tables: list[DataFrame], columns: list[str]) -> pa.Table | None:
    """All rows of the passes of one block: at most the wanted rows of its windows."""
    if not tables:
        return None
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole.select(*columns).orderBy("window", "rank").toArrow()


def hard_negatives(
    embeddings: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: per anchor and positive its hardest negatives.

    ``anchors`` is a condition over ``vec_id`` (and ``row``). Components become ``floor(256 * x)``; scores are inner products of those,
    exact, higher ones first, ties by smaller id, rows without id last. Positives are the first ``positives`` other rows of the same
    label, negatives the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of the positive's score (so none for a
    negative score); all, if there are fewer.

    Rows with a null label, a null vector or a null or non-finite component take no part. A shorter vector counts as filled up with
    zeros, an empty one as all zeros. Repeated rows are rows of their own, and each other's positives. Scaled components beyond 2^26
    count as 2^26. No anchor, or an empty table, gives no rows. Ids are whole numbers or null; other columns are not read.

    The driver holds one block of anchors at a time, its windows and their rows.
    """
    spark = embeddings.sparkSession
    rows = written(scaled_rows(embeddings, id, label, vector), "vectors")
    shape = shape_of(rows)
    chosen = rows.where(anchors)
    blocks = max(1, -(-chosen.count() * max(1, len(shape.order)) * 8 // block_bytes))
    dealt = written(chosen.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "anchors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    path = scratch_path(spark, "negatives")
    out = f"{path}/found"
    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/block=-1")
    for b in range(blocks):
        own = dealt.where(F.col("block") == b).orderBy("row").toArrow()
        if not own.num_rows:
            continue
        vectors = matrix(own["q"].combine_chunks(), len(shape.order))
        block = {"q": vectors, "label": own["label"].to_numpy(), "row": own["row"].to_numpy()}
        everyone = np.arange(own.num_rows)
        any_score = Windows(everyone, np.full(len(everyone), NONE), np.full(len(everyone), -NONE), positives, True)
        found = _read(filled(rows, block, any_score, shape, f"{path}/positives{b}"), ["window", "rank", "score", "vec_id"])
        if found is None or not found.num_rows:
            continue
        of, score = found["window"].to_numpy(), found["score"].to_numpy()
        between = Windows(of, -(-low * score // 100), high * score // 100, negatives, False)
        pairs = pa.table(
            {
                "window": pa.array(np.arange(len(of), dtype=np.int32)),
                "anchor_id": own["vec_id"].combine_chunks().take(pa.array(of)),
                "positive_id": found["vec_id"].combine_chunks(),
                "positive_score": pa.array(score),
            }
        )
        named = F.broadcast(spark.createDataFrame(pairs))  # one row per window of the block
        for k, table in enumerate(filled(rows, block, between, shape, f"{path}/negatives{b}")):
            result = table.join(named, "window").select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
            result.write.parquet(f"{out}/block={b}/pass={k}")
    discard(dealt, rows)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
