"""Declared schemas and the typed serving contract.

Raw reads always use a declared schema (widened types, so month-to-month
physical drift does not break the read) instead of inference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw trip table as declared over the monthly Parquet files.
RAW_TRIPS = T.StructType([
    T.StructField("VendorID", T.LongType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
])
RAW_PARTITION = "trip_month"
RAW_TRIPS_PARTITIONED = T.StructType(
    RAW_TRIPS.fields + [T.StructField(RAW_PARTITION, T.StringType())]
)

# Zone lookup CSV (header line, quoted fields).
ZONE_LOOKUP = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

FACT_PARTITION = "year_month"

# Serving contract of the fact: (column, type, nullable).  Widths of the
# string columns are contract checks, not types.
SERVING_FACT = (
    ("trip_key", "string", False),
    ("date_key", "int", False),
    ("time_key", "smallint", False),
    ("pu_zone_key", "int", False),
    ("do_zone_key", "int", False),
    ("vendor_key", "smallint", True),
    ("payment_key", "smallint", True),
    ("ratecode_key", "smallint", True),
    ("trip_distance", "decimal(10,2)", True),
    ("fare_amount", "decimal(10,2)", True),
    ("tip_amount", "decimal(10,2)", True),
    ("tolls_amount", "decimal(10,2)", True),
    ("total_amount", "decimal(10,2)", True),
    ("passenger_count", "smallint", True),
    ("trip_duration_min", "int", True),
    ("tip_pct", "decimal(6,4)", True),
    ("pu_is_cbd", "smallint", True),
)
SERVING_STRING_WIDTHS = {"trip_key": 32}


@dataclass(frozen=True)
class ServingTable:
    """Contract of a serving dimension: (column, type, nullable), the key that
    must be unique, and widths of the string columns."""

    columns: tuple[tuple[str, str, bool], ...]
    key: str
    widths: dict[str, int]


# The serving dimensions' types and widths.
SERVING_DIMS = {
    "zone": ServingTable((
        ("zone_key", "int", False), ("location_id", "int", False), ("borough", "string", True),
        ("zone", "string", True), ("service_zone", "string", True), ("is_cbd", "smallint", False)),
        "zone_key", {"borough": 64, "zone": 128, "service_zone": 64}),
    "date": ServingTable((
        ("date_key", "int", False), ("date", "date", False), ("year", "smallint", False),
        ("month", "smallint", False), ("dow", "smallint", False), ("year_month", "string", False),
        ("is_weekend", "smallint", False), ("period", "string", False)),
        "date_key", {"year_month": 7, "period": 8}),
    "time": ServingTable((
        ("time_key", "smallint", False), ("hour", "smallint", False), ("daypart", "string", False)),
        "time_key", {"daypart": 16}),
    "payment": ServingTable((
        ("payment_key", "smallint", False), ("payment_desc", "string", True)), "payment_key", {"payment_desc": 32}),
    "ratecode": ServingTable((
        ("ratecode_key", "smallint", False), ("ratecode_desc", "string", True)), "ratecode_key", {"ratecode_desc": 32}),
    "vendor": ServingTable((
        ("vendor_key", "smallint", False), ("vendor_desc", "string", True)), "vendor_key", {"vendor_desc": 64}),
}
