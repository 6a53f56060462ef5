"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and gives the documents it keeps."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import decontamination, langid, mixing, partenum, sharding


#: A text is rejected if no language reaches this posterior probability.
LEAST_SCORE = 0.5
#: Near duplicates of the corpus share so many percent of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def kept_where(docs: DataFrame, new: Collection[str], judged: Callable[[DataFrame], DataFrame], condition: Column) -> DataFrame:
    """The rows of ``docs`` that a judgement lets stay, all columns with their names and values.

    ``judged`` adds the columns ``new``; columns of ``docs`` with such names are out of its way meanwhile.
    """
    names = [f"_{k}_{c}" if c in new else c for k, c in enumerate(docs.columns)]
    found = judged(docs.toDF(*names)).where(condition)
    return found.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, docs.columns, strict=True)])


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages learned from the open, labelled ones.

    A null text, or one without letters, is in none and goes, however short or long; so do all if nothing can be learned. Each row is
    judged by its whole text alone, so repeated rows stay or go together. Columns keep their names and values, also
    those named like the operator's own. An empty table gives no rows.
    """
    model = langid.fit(docs)
    fits = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)
    return kept_where(docs, ("lang_pred", "score"), lambda rows: langid.identify(rows, model), fits)


def by_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    Null texts and those without words are like no other and stay, repeated or not; of rows repeated in id and text one stays. Very long
    texts are compared in full. Null ids come last. Columns keep their names and values. An empty table gives no rows.
    """
    return partenum.without_similar(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have none and stay, so do all beside an empty benchmark. Each row is judged by its whole text alone, so repeated
    rows stay or go together. Columns keep their names and values, also those named like the operator's own.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = F.col("n_hit") == 0
    return kept_where(docs, decontamination.RESULT.names, lambda rows: decontamination.find_benchmark(rows, benchmark), clean)


def by_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times.

    Null and empty texts have no words; a null source is a source. Rows that tie in odds, id and size are taken alike. Columns keep their
    names and values. An empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document of the mix in 16 shards of near-equal size.

    A null text counts one byte; copies are documents of their own, ties follow the text's checksum. Other columns are not read. An empty
    table gives no rows.
    """
    return sharding.shard_documents(docs)
