"""Tables published by version: readers see the last complete one, and a run that dies leaves it in place.

A table is a folder with ``data/published-batch=…`` (what one write made, in partition folders) and ``manifest/at=…``, which
names for every partition the batch it is in. A write adds a batch and then, last, one more manifest of a single
file; the highest number is the current one. Replacing some partitions therefore writes these alone, and the new
manifest names the old batches for all others.

An entry also says what its partition was made from, so a table that is derived from another one partition by
partition can tell which of its own are out of date, whatever happened to the run that should have renewed them.

Partition columns are whole numbers of bounded range, as years and months; manifests go through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.calendar import col

MONTHS = ("year", "month")
OWN = "own"


@dataclass(frozen=True)
class Part:
    batch: str
    rows: int
    made_from: str | None = None


@dataclass(frozen=True)
class Version:
    """One state of a table: its number, its parts by folder (``year=2024/month=1``; one ``""`` where there are no
    partition columns), its schema."""

    at: int
    parts: dict[str, Part]
    schema: T.StructType

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())


def part_name(values: dict[str, int]) -> str:
    return "/".join(f"{c}={int(v)}" for c, v in values.items())


def month_parts(months: Iterable[tuple[int, int]]) -> list[str]:
    return [part_name(dict(zip(MONTHS, m))) for m in months]


def months_of(parts: Iterable[str]) -> list[tuple[int, int]]:
    return sorted(tuple(int(piece.split("=")[1]) for piece in p.split("/")) for p in parts)


def _manifests(spark: SparkSession, path: str) -> dict[int, str]:
    """Files of the manifests by number; a listing, no job."""
    try:
        files = spark.read.schema("entries string").parquet(f"{path.rstrip('/')}/manifest").inputFiles()
    except AnalysisException:
        return {}
    return {int(f.rsplit("/at=", 1)[1].split("/")[0]): f for f in files}


def current(spark: SparkSession, path: str, at: int | None = None) -> Version | None:
    """The current version, or that of a number; None where nothing is published."""
    files = _manifests(spark, path)
    if not files or at is not None and at not in files:
        return None
    number = max(files) if at is None else at
    kept = json.loads(spark.read.schema("entries string").parquet(files[number]).first()["entries"])
    return Version(number, {name: Part(**p) for name, p in kept["parts"].items()}, T.StructType.fromJson(kept["schema"]))


def read_version(spark: SparkSession, path: str, version: Version, parts: Iterable[str] | None = None) -> DataFrame:
    """The table as of a version, or some of its parts; only their folders are listed and read."""
    base = f"{path.rstrip('/')}/data"
    wanted = list(version.parts) if parts is None else [p for p in parts if p in version.parts]
    folders = [f"{base}/published-batch={version.parts[p].batch}/{p}".rstrip("/") for p in wanted]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).option("basePath", base).parquet(*folders).select(*[col(c) for c in version.schema.names])


def read_published(spark: SparkSession, path: str) -> DataFrame:
    version = current(spark, path)
    if version is None:
        raise ValueError(f"nothing is published at {path}")
    return read_version(spark, path, version)


def publish(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    scope: Iterable[str] | str | None = None,
    made_from: dict[str, str] | None = None,
    order: Sequence[Column] = (),
) -> Version:
    """Write the rows and make them current: as the whole table, or in place of the parts in ``scope`` only, which is
    ``OWN`` for the parts that the rows are in.

    Files are sorted by ``order``. Rows are rebalanced by part first, so that a part that holds most rows gets many
    writers. If anything fails before the manifest is there, the table stays what it was.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = current(spark, base)
    batch = uuid.uuid4().hex
    folder = f"{base}/data/published-batch={batch}"
    rows = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    if order:
        rows = rows.sortWithinPartitions(*by, *order)
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    counts = written.groupBy(*by).count().collect() if by else [{"count": written.count()}]
    source = made_from or {}
    new = {}
    for r in counts:
        name = part_name({c: r[c] for c in by})
        new[name] = Part(batch, r["count"], source.get(name))
    gone = None if scope is None else set(new) if scope == OWN else set(scope)
    kept = {} if gone is None or before is None else {n: p for n, p in before.parts.items() if n not in gone}
    outside = set() if gone is None else new.keys() - gone
    if outside:
        raise ValueError(f"rows outside the parts that are replaced: {sorted(outside)}")
    schema = T.StructType([*[f for f in df.schema if f.name not in by], *[df.schema[c] for c in by]])
    version = Version((before.at if before else 0) + 1, kept | new, schema)
    entries = {"parts": {n: vars(p) for n, p in version.parts.items()}, "schema": schema.jsonValue()}
    # one row of one partition: one file, which is there or not
    one = spark.range(0, 1, 1, 1).select(F.lit(json.dumps(entries)).alias("entries"))
    one.write.mode("errorifexists").parquet(f"{base}/manifest/at={version.at:012d}")
    return version


def stale_parts(upstream: Version, own: Version | None, settings: str) -> list[str]:
    """Upstream parts for which the own table has none, or one made from something else."""
    have = {} if own is None else {name: p.made_from for name, p in own.parts.items()}
    return [name for name, p in upstream.parts.items() if have.get(name) != _made_from(p, settings)]


def _made_from(part: Part, settings: str) -> str:
    return f"{part.batch} {settings}"


def propagate(
    upstream: Version,
    path: str,
    own: Version | None,
    settings: str,
    build: Callable[[list[str]], DataFrame],
    by: Sequence[str] = MONTHS,
    order: Sequence[Column] = (),
) -> Version:
    """Bring a table up to date that is made part by part from another; ``own`` is its current version.

    A part is built anew where it was made from another batch of the upstream part or with other ``settings`` (what
    else its rows depend on); parts that the upstream table no longer has go. If all are up to date nothing is written.
    """
    stale = stale_parts(upstream, own, settings)
    gone = [] if own is None else [name for name in own.parts if name not in upstream.parts]
    if own is not None and not stale and not gone:
        return own
    made_from = {name: _made_from(upstream.parts[name], settings) for name in stale}
    return publish(build(stale), path, by, [*stale, *gone], made_from, order)


def forget(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions and the folders that none of those names; gives how many went."""
    base = path.rstrip("/")
    files = _manifests(spark, base)
    last = sorted(files)[-keep:]
    if len(last) == len(files):
        return 0
    named = {f"published-batch={p.batch}/{n}".rstrip("/") for at in last for n, p in current(spark, base, at).parts.items()}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(base).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f"{base}/manifest/at={at:012d}" for at in files if at not in last]
    for status in fs.listStatus(hadoop(f"{base}/data")):
        batch = status.getPath().getName()
        inside = {n for n in named if n == batch or n.startswith(batch + "/")}
        if not inside:
            old.append(f"{base}/data/{batch}")
        elif batch not in inside:
            old += [f"{base}/data/{n}" for n in _folders(fs, hadoop, base, batch, len(next(iter(inside)).split("/"))) if n not in inside]
    for folder in old:
        fs.delete(hadoop(folder), True)
    return len(old)


def _folders(fs, hadoop, base: str, start: str, depth: int) -> list[str]:
    """Partition folders below a batch, as many levels down as its parts have."""
    found = [start]
    for _ in range(depth - 1):
        found = [
            f"{f}/{s.getPath().getName()}" for f in found for s in fs.listStatus(hadoop(f"{base}/data/{f}")) if s.isDirectory()
        ]
    return found
