"""Where intermediate tables are kept, and how lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names. Only where all tasks run in this one process is one made where none is
    named; anywhere else that would be a folder each machine has for itself, so it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="panelspark-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    Later steps start from files that outlive any executor, and the optimizer sees the true size,
    so a small table is broadcast and a large one is not.
    """
    at = path or new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def together(*steps: Callable[[], R]) -> list[R]:
    """What the steps give. Their jobs don't wait for each other, so small ones share the executors; the first error
    is raised when all have ended."""
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]
