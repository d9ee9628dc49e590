"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to differ from the columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sent_if(df: DataFrame, few: bool) -> DataFrame:
    """A written table of measured size, marked to go to every executor where it is small enough; else joins shuffle."""
    return F.broadcast(df) if few else df


def in_batches(df: DataFrame, column: str, added: list[T.StructField], work) -> DataFrame:
    """The rows with more columns: ``work(array)`` gets an Arrow array of the column and yields, for consecutive
    runs of rows, the arrays of the added columns."""
    schema = T.StructType([*df.schema.fields, *added])
    return df.mapInArrow(functools.partial(_run, column, [f.name for f in added], work), schema)


def _run(column: str, names: list[str], work, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index(column)
        done = 0
        for arrays in work(batch.column(at)):
            part = batch.slice(done, len(arrays[0]))
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *names])
            done += len(arrays[0])
