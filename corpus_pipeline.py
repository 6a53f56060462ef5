"""The corpus pipeline: its stages, in order, and the job that applies them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm.stages import by_benchmark, by_language, by_mixture, by_similarity, to_shards
from sieveline.sources.scratch import discard, recorded, remove, written

STAGES = [
    ("language_id", by_language),
    ("ngram_jaccard_join", by_similarity),
    ("benchmark_decontamination", by_benchmark),
    ("source_mixture", by_mixture),
    ("byte_shards", to_shards),
]

#: The trained language model cannot be expressed in SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. Each stage's rows are written as Parquet, read again by the next, and then deleted,
    with all that the stage wrote on its way."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with recorded() as made:
            before, docs = docs, written(stage(spark, docs, sf_dir), name)
        discard(before)
        for path in made:
            if path != docs.scratch_path:
                remove(spark, path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
