"""Weekly counter files with whole-file quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.joins import lookup
from panelspark.schemas import READINGS
from panelspark.specs import FIRST_WEEKLY_FILE
from panelspark.workspace import stored

WEEKLY_NAME = r"turnstile_(\d{6})\.txt"


def weekly_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every line of the files as text, with where it stands: file, start of its block, number within the task.

    A block is read by one task from front to back, so the number orders the lines of a block.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path if isinstance(path, str) else list(path))
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.size(F.split("value", ",")).alias("width"),
            F.monotonically_increasing_id().alias("at"),
        )
    )


def file_verdicts(lines: DataFrame, pattern: str = WEEKLY_NAME, first: int = FIRST_WEEKLY_FILE) -> DataFrame:
    """One row per file: its week, header width, widest row, whether it can be used, and where its header is.

    A file is used when its name carries a week not before ``first``, its header has the right
    number of columns and no row has more. The header is the first line of the file's first block.
    """
    week = F.regexp_extract("file", pattern, 1).try_cast("int")
    in_first = F.when(F.col("start") == 0, F.col("at"))
    per_file = lines.groupBy("file").agg(
        F.min_by("width", in_first).alias("header_width"),
        F.min(in_first).alias("header_at"),
        F.max("width").alias("max_width"),
        F.count(F.lit(1)).alias("lines"),
    )
    wide = len(READINGS.names)
    usable = week.isNotNull() & (week >= first) & (F.col("header_width") == wide) & (F.col("max_width") <= wide)
    return per_file.select(
        "file", week.alias("week"), "header_width", "max_width", "lines", F.coalesce(usable, F.lit(False)).alias("usable"), "header_at"
    )


def weekly_file_report(
    spark: SparkSession, path: str | Sequence[str], pattern: str = WEEKLY_NAME, first: int = FIRST_WEEKLY_FILE
) -> DataFrame:
    """One row per file and whether it can be used; see ``file_verdicts``."""
    return file_verdicts(weekly_lines(spark, path), pattern, first).drop("header_at")


def scan_weekly(
    spark: SparkSession, path: str | Sequence[str], pattern: str = WEEKLY_NAME, first: int = FIRST_WEEKLY_FILE
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows of all usable files and the verdict on every file, from one pass over the raw text.

    The pass parses every line and writes it down with its place; verdicts come from the places alone, and rows of
    files that can't be used, and headers, go when the written rows are read. ``seq`` says where a reading stands:
    file name, start of the block, line. Neither how files are packed into tasks nor a later join changes it.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READINGS.fields)
    parsed = F.from_csv("value", fields, {"ignoreTrailingWhiteSpace": "true"})
    lines = weekly_lines(spark, path).withColumn("reading", F.when(F.trim("value") != "", parsed)).drop("value")
    lines = stored(lines, "weekly-lines")
    verdicts = stored(file_verdicts(lines, pattern, first), "file-verdicts")
    good = verdicts.filter("usable").select("file", "header_at")
    rows = lookup(lines.filter("reading IS NOT NULL"), good, ["file"], "inner")
    # the reading depends on the verdict, so no later filter is tried on lines that the verdict leaves out
    is_header = (F.col("start") == 0) & (F.col("at") == F.col("header_at"))
    rows = rows.withColumn("reading", F.when(~is_header, F.col("reading"))).filter("reading IS NOT NULL")
    return rows.select("reading.*", F.struct("file", "start", F.col("at").alias("line")).alias("seq")), verdicts


def read_weekly_readings(
    spark: SparkSession, path: str | Sequence[str], pattern: str = WEEKLY_NAME, first: int = FIRST_WEEKLY_FILE, ordered: bool = True
) -> DataFrame:
    """Readings of all usable files, columns named by position; ``seq``, where a reading stands, is left out on demand."""
    rows, _ = scan_weekly(spark, path, pattern, first)
    return rows if ordered else rows.drop("seq")
