"""What a stored stage was made from: a small table per stage, written after the stage itself.

A stage is known by a hash of its input rows, its arguments and the stages before it. A job that was stopped leaves a stage without
its manifest, so half a stage is never taken for a whole one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.sources.scratch import remove

MANIFESTS = "manifests"
SCHEMA = "stage string, fingerprint string, arguments string"
#: What becomes of a stored stage that was made from other inputs or arguments.
POLICIES = ("rebuild", "refuse", "keep")


def fingerprint_of(**parts: Any) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def data_fingerprint(df: DataFrame) -> str:
    """A hash of the schema and of the rows as a multiset, from one aggregate: their order and partitions do not matter."""
    # a null leaves a row hash as it is, so where the nulls are is hashed too
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    row = F.xxhash64(*cells) if cells else F.lit(0).cast("bigint")
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
    sums = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x.cast("decimal(20,0)")).alias(a) for x, a in ((low, "low"), (high, "high"))]
    )
    return fingerprint_of(schema=df.schema.json(), rows=[str(v) for v in sums.first()])


def manifest_path(work_dir: str, stage: str) -> str:
    return f"{work_dir.rstrip('/')}/{MANIFESTS}/{stage}"


def read_manifest(spark: SparkSession, work_dir: str, stage: str) -> dict | None:
    """The manifest of a finished stage, None if there is none."""
    try:
        rows = spark.read.schema(SCHEMA).json(manifest_path(work_dir, stage)).collect()
    except AnalysisException:
        return None
    return rows[0].asDict() if len(rows) == 1 else None


@dataclass
class Stages:
    """The stages of one job below a folder. ``states`` says what was done about each: built, rebuilt, reused or kept."""

    spark: SparkSession
    work_dir: str
    stale: str = "rebuild"
    states: list[tuple[str, str, str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.stale not in POLICIES:
            raise ValueError(f"stale must be one of {', '.join(POLICIES)}")

    def run(
        self, stage: str, make: Callable[[], None], load: Callable[[], Any], has: Callable[[], bool], found: bool = False, **arguments: Any
    ) -> Any:
        """Load the stage if it was made from the same arguments (fingerprints of its inputs among them), else make it first.

        ``has`` says whether something is stored for the stage. Under ``keep`` that is used, whatever it was made from, if it was
        ``found`` by a search; under ``refuse`` a finished stage of other arguments is an error. A manifest goes before its
        stage is made again.
        """
        wanted = fingerprint_of(stage=stage, **arguments)
        manifest = read_manifest(self.spark, self.work_dir, stage)
        if manifest and manifest["fingerprint"] == wanted and has():
            state = "reused"
        elif self.stale == "keep" and found and has():
            state = "kept"
        else:
            if manifest and self.stale == "refuse":
                told = json.loads(manifest["arguments"])
                now = json.loads(json.dumps(arguments, sort_keys=True, default=str))
                differ = sorted(k for k in told.keys() | now.keys() if told.get(k) != now.get(k))
                raise ValueError(f"stage {stage} below {self.work_dir} was made from other {', '.join(differ) or 'files'}")
            state = "rebuilt" if manifest else "built"
            path = manifest_path(self.work_dir, stage)
            remove(self.spark, path)
            make()
            row = (stage, wanted, json.dumps(arguments, sort_keys=True, default=str))
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").json(path)
        self.states.append((stage, state, wanted))
        return load()

    def table(self) -> DataFrame:
        """(stage, state, fingerprint) in the order the stages were run."""
        return self.spark.createDataFrame(
            [(i, *s) for i, s in enumerate(self.states)], "position int, stage string, state string, fingerprint string"
        )
