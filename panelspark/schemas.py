"""Explicit schemas of the tables that are read and written; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

HOURLY = T.StructType(
    [
        T.StructField("transit_timestamp", T.TimestampNTZType()),
        T.StructField("transit_mode", T.StringType()),
        T.StructField("station_complex_id", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("ridership", T.LongType()),
    ]
)

# Preferred column order of an hourly record page.
HOURLY_RECORD_COLUMNS = (
    "transit_timestamp",
    "transit_mode",
    "station_complex_id",
    "station_complex",
    "borough",
    "payment_method",
    "fare_class_category",
    "ridership",
    "transfers",
    "latitude",
    "longitude",
    "georeference",
)

# Names given by position to the columns of a weekly counter file.
READING_COLUMNS = (
    "C/A",
    "UNIT",
    "SCP",
    "STATION",
    "LINENAME",
    "DIVISION",
    "DATE",
    "TIME",
    "DESC",
    "ENTRIES",
    "EXITS",
)

READINGS = T.StructType(
    [
        T.StructField(name, T.LongType() if name in ("ENTRIES", "EXITS") else T.StringType())
        for name in READING_COLUMNS
    ]
)

STATION_PANEL = T.StructType(
    [
        T.StructField("complex_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("period", T.StringType()),
        T.StructField("day_group", T.StringType()),
        T.StructField("ridership", T.DoubleType()),
        T.StructField("omny_pct", T.DoubleType()),
    ]
)

SPECIAL_CASES = T.StructType(
    [
        T.StructField("complex_id", T.StringType()),
        T.StructField("baseline_years", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)
