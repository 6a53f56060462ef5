"""Where stages put tables they need again."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RECORDS: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The scratch paths that are given out inside the block, so that a job can delete what its steps leave behind."""
    made: list[str] = []
    _RECORDS.append(made)
    try:
        yield made
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not made]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one stage output below the shared folder in ``spark.checkpoint.dir``.

    Executors on other machines must see the path, so a local temporary folder is only made when
    the setting is absent and the session runs inside one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="sieveline-")
    elif shared.startswith("file:") and spark.sparkContext.master.startswith(("yarn", "k8s", "spark:", "mesos")):
        warnings.warn(f"spark.checkpoint.dir is {shared}: every machine must mount that folder", stacklevel=2)
    path = f"{shared.rstrip('/')}/sieveline/{name}-{uuid.uuid4().hex}"
    for made in _RECORDS:
        made.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a table on shared storage.

    For a derived table that is read many times: it is computed once, later reads prune columns, and
    a lost executor costs a file read instead of the whole lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`written` that no later plan reads any more."""
    for table in tables:
        if path := getattr(table, "scratch_path", None):
            remove(table.sparkSession, path)
