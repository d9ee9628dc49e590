"""Tables with required columns, hourly files, dimensions and configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.calendar import col
from panelspark.functions.numbers import lenient_double, strict_bigint
from panelspark.functions.text import year_list
from panelspark.operators.filters import keep_first
from panelspark.schemas import HOURLY, STATION_PANEL
from panelspark.sources.publishing import current, read_version


def require_columns(df: DataFrame, required: Sequence[str], label: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{label} missing required columns: {missing}. Found: {df.columns}")
    return df


def read_text_columns(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every column as text; names come from the header, types from no data.

    A file whose header differs from the first one's fails the query rather than being misread.
    """
    where = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("escape", '"').option("inferSchema", False)
    return reader.option("enforceSchema", False).csv(where)


def load_required(
    spark: SparkSession, paths: str | Sequence[str], required: Sequence[str], label: str, fmt: str = "csv"
) -> DataFrame:
    """A table that must exist and have the required columns."""
    try:
        if fmt == "csv":
            df = read_text_columns(spark, paths)
        else:
            df = spark.read.format(fmt).load(paths if isinstance(paths, str) else list(paths))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"Missing {label} file: {paths}") from exc
        raise
    return require_columns(df, required, label)


def read_hourly(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The five columns of hourly files that panels need; a bad count fails, a missing one stays missing.

    One call reads any number of files; Spark splits them, so no batching or chunking is needed.
    """
    raw = load_required(spark, paths, HOURLY.names, "hourly ridership")
    return raw.select(
        F.col("transit_timestamp").cast("timestamp_ntz").alias("transit_timestamp"),
        "transit_mode",
        "station_complex_id",
        "payment_method",
        strict_bigint("ridership").alias("ridership"),
    )


def combine_files(spark: SparkSession, paths: str | Sequence[str], numeric_name: str | None = None) -> DataFrame:
    """All files as one table. With a pattern, each row also tells the number in its file's path."""
    df = read_text_columns(spark, paths)
    if numeric_name is None:
        return df
    number = F.regexp_extract(F.col("_metadata.file_path"), numeric_name, 1).try_cast("int")
    return df.select("*", number.alias("file_number"))


def read_dimension(
    spark: SparkSession, paths: str | Sequence[str], columns: dict[str, str], key: str, fmt: str = "csv"
) -> DataFrame:
    """A dimension with one row per key: source columns renamed, all as text."""
    df = load_required(spark, paths, list(columns), "dimension", fmt)
    picked = df.select(*[col(old).cast("string").alias(new) for old, new in columns.items()])
    return keep_first(picked, [key], [c for c in picked.columns if c != key])


def read_special_cases(spark: SparkSession, path: str) -> DataFrame:
    """The special-case table with its line numbers; the file is a configuration, one split."""
    raw = load_required(spark, path, ["complex_id", "baseline_years"], "special cases")
    return raw.withColumn("line", F.monotonically_increasing_id() + 2)


def special_years(config: DataFrame) -> DataFrame:
    """(complex_id, years array), the last line winning where an id is repeated."""
    row = F.struct(year_list("baseline_years").alias("years"))
    return (
        config.groupBy(F.trim(F.col("complex_id").cast("string")).alias("complex_id"))
        .agg(F.max_by(row, F.col("line")).alias("r"))
        .select("complex_id", F.col("r.years").alias("years"))
    )


def read_source_map(spark: SparkSession, path: str) -> DataFrame:
    """A ``{year: source}`` JSON object as rows (year, source)."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return text.select(F.explode(pairs).alias("year", "source")).select(F.col("year").cast("int").alias("year"), "source")


def load_stored_panel(
    spark: SparkSession, path: str, schema: T.StructType = STATION_PANEL, fmt: str = "parquet"
) -> DataFrame:
    """The stored panel, or an empty one of the same schema where there is none to read; of a published table, the
    current version.

    Ids become text and measures numbers, bad numbers becoming zero.
    """
    version = current(spark, path) if fmt == "parquet" else None
    try:
        if version is not None:
            raw = read_version(spark, path, version)
        else:
            raw = read_text_columns(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        require_columns(raw, schema.names, "stored panel")
    except (AnalysisException, ValueError):
        return spark.createDataFrame([], schema)
    return raw.select(
        *[
            lenient_double(F.col(f.name).cast("string")).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
