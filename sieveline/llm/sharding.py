"""Contiguous shards of near-equal byte size, from global prefix sums.

The rows are dealt into ranges of the order, each range is summed, and the totals of the ranges before
give every row its global start. Only keys and sizes travel, never texts; no task sees more than one
range, and the single window without a partition runs over one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.sources.scratch import written

RANGE, TIE = "_range", "_tie"


def running_totals(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add ``start`` (sizes of all rows before) and ``position`` (number of rows before), both long.

    Nulls come first in the order. Rows equal in every key are told apart by their place in the input,
    so a value shared by a third of all rows is still cut into ranges. Which of several equal rows
    comes first is open; the set of rows returned does not depend on it. The table of ranges is stored, so a
    lost executor costs a file read and the sampled range bounds cannot change between its readers.
    """
    keyed = rows.withColumn(TIE, F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*order, TIE]])
    placed = written(ranged.withColumn(RANGE, F.spark_partition_id()), "ranges")
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(RANGE)
        .agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            RANGE,
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        )
    )
    inside = Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in [*order, TIE]])
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        # one row per range, and there are as many ranges as shuffle partitions: bounded, whatever the input
        placed.join(F.broadcast(offsets), RANGE)
        .withColumn("start", F.col("_bytes_before") + F.coalesce(F.sum(size).over(earlier), F.lit(0)))
        .withColumn("position", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .drop(RANGE, TIE, "_bytes_before", "_rows_before")
    )


def shard_at_middle(start: Column, size: Column, total: int, shards: int) -> Column:
    """The shard whose equal share of the total holds the middle of the row."""
    middle, whole = (2 * start + size) * shards, F.lit(2 * max(total, 1))
    return ((middle - middle % whole) / whole).cast("int")  # exact: the division leaves no remainder


def contiguous_shards(rows: DataFrame, order: list[str], size: str, shards: int) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (place in the shard, from 0 without gaps).

    A row belongs to the shard that holds the middle of its bytes, so a shard differs from an equal
    share by at most the two rows at its ends. An empty input gives no rows; with fewer rows than
    shards some shards stay empty. ``size`` must be a positive long without nulls.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    run = running_totals(rows, order, size)
    total = run.agg(F.max(F.col("start") + F.col(size))).first()[0] or 0
    placed = run.withColumn("shard", shard_at_middle(F.col("start"), F.col(size), total, shards))
    first = placed.groupBy("shard").agg(F.min("position").alias("_first"))  # one row per shard
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("position") - F.col("_first"))
        .drop("_first")
    )


def shard_documents(docs: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Documents are laid out by id, then by checksum. A null text has size 1 and the checksum of no
    bytes (0); null ids come first; repeated rows are placed one after another. Columns of ``docs``
    other than the two named are not read. ``grown_shard`` is null, since byte shares move when one
    more shard is added.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    placed = contiguous_shards(rows, ["doc_id", "text_crc32", "size"], "size", shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
