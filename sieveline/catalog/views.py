"""Inputs shaped like those of a training run, derived from the benchmark tables."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.features import assemble, encode_label, fit_label_index
from sieveline.operators.split import hash_split, three_way_split
from sieveline.sources.scratch import discard, written

DOC_FEATURES = ["n_chars", "n_words", "n_distinct_words", "n_digits", "n_punct"]
PLAIN_FEATURES = ["constant", "noise"]
SEED = 2023


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text columns with missing values: few in f1 and f3, most in f2."""
    id = F.col("o_orderkey")
    missing = F.lit("?")
    return table(spark, sf_dir, "orders").select(
        id.alias("id"),
        F.when(id % 7 == 0, missing).otherwise(F.floor("o_totalprice").cast("string")).alias("f1"),
        F.when(id % 5 == 0, (F.col("o_custkey") % 100).cast("string")).otherwise(missing).alias("f2"),
        F.when(id % 11 == 0, missing).otherwise(F.col("o_custkey").cast("string")).alias("f3"),
        F.col("o_orderstatus").alias("target"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a scored table, so that every metric can be checked without a model."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.col("o_totalprice").alias("score"),
        # few distinct values, each shared by many rows
        F.floor(F.col("o_totalprice") / 100000).cast("double").alias("tied_score"),
        (F.col("o_totalprice") > 250000).cast("int").alias("pred"),
        (F.col("o_orderkey") % 3 + 1).alias("w"),
    )


def scored_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return three_way_split(scored(spark, sf_dir), "id")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with three actual and three predicted classes."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("label"),
        F.when(price > 250000, "F").when(price > 50000, "O").otherwise("P").alias("prediction"),
    )


def contrib(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as stand-in contributions."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("contributions")
    )


def docfeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the whole text of every labelled document, with its quality as target.

    Texts without a label are left out first, and the others dealt over the tasks: a file of one row group would give
    all texts to one task. The counts are stored, since fitting a model reads its input many times, in the order in which the texts
    are read, so that a fit sees one order however the texts were dealt.
    """
    words = F.array_remove(F.split("text", r"\s+"), "")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("target"))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.monotonically_increasing_id().alias("_place"))
    labelled = texts.join(labels, "id", "left_semi")
    counts = labelled.repartition("id").select(
        "_place",
        "id",
        F.length("text").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        F.size(F.array_distinct(words)).cast("double").alias("n_distinct_words"),
        F.regexp_count("text", F.lit(r"[0-9]")).cast("double").alias("n_digits"),
        F.regexp_count("text", F.lit(r"[.,;:!?]")).cast("double").alias("n_punct"),
        F.lit(1.0).alias("constant"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("noise"),
    )
    # stored before they are ordered: an order draws its ranges first, and would count all texts twice
    counted = written(counts.join(labels, "id"), "counts")
    ordered = written(counted.orderBy("_place").drop("_place"), "docfeat")
    discard(counted)
    return ordered


def raw_docfeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document counts as they might arrive: as text, with missing values in three columns."""
    id, missing = F.col("id"), F.lit("?")

    def text(c: str, absent) -> Column:
        return F.when(absent, missing).otherwise(F.col(c).cast("long").cast("string")).alias(c)

    return docfeat(spark, sf_dir).select(
        "id",
        "n_chars",
        "n_words",
        "n_distinct_words",
        text("n_digits", id % 7 == 0),
        text("n_punct", id % 11 == 0),
        text("constant", id % 5 != 0),
        "noise",
        "target",
    )


def document_vectors(
    spark: SparkSession, sf_dir: str, features: list[str]
) -> tuple[DataFrame, DataFrame, StringIndexerModel]:
    """(train, test, label index) with id, label and feature vector."""
    docs = docfeat(spark, sf_dir)
    index = fit_label_index(docs, "target")
    ready = assemble(encode_label(docs, index), features).select("id", "label", "features")
    split = hash_split(ready, "id", seed=SEED)
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return train, test, index
