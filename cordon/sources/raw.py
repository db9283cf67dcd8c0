"""Raw sources and sinks (S1-S3 and the raw month writer)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.schemas import RAW_PARTITION, RAW_TRIPS, RAW_TRIPS_PARTITIONED, ZONE_LOOKUP
from cordon.shuffles import shuffles_for


def conform_read(df: DataFrame, schema) -> DataFrame:
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        cols.append((F.col(src) if src else F.lit(None)).cast(f.dataType).alias(f.name))
    if RAW_PARTITION in df.columns:
        cols.append(F.col(RAW_PARTITION).cast("string").alias(RAW_PARTITION))
    return df.select(*cols)


def list_months(spark: SparkSession, root: str) -> DataFrame:
    """The month folders under ``root``: the read has the partition column
    only, so no data column is decoded."""
    return (spark.read.schema(f"{RAW_PARTITION} string").option("basePath", root).parquet(root)
            .select(RAW_PARTITION).distinct())


def month_schemas(spark: SparkSession, root: str) -> list[tuple[T.StructType, list[str]]]:
    """The distinct physical schemas of the month folders and their months
    (one footer is read per month)."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for r in sorted(list_months(spark, root).collect()):
        month = r[RAW_PARTITION]
        own = spark.read.parquet(f"{root}/{RAW_PARTITION}={month}").schema
        groups.setdefault(own.json(), (own, []))[1].append(month)
    return list(groups.values())


def read_raw_trips(spark: SparkSession, root: str, schema=RAW_TRIPS, uniform: bool = False,
                   months: list[str] | None = None) -> DataFrame:
    """Monthly Parquet under ``root/trip_month=YYYY-MM/``.

    Each column is taken by its declared name (any case) and cast to the
    declared type; a column missing from a month reads as NULL.  Months may
    store a column in different physical types (INT in one, DOUBLE in
    another): months of one physical schema are one scan, and the scans are
    unioned, so the plan grows with the number of schemas, not of months.
    ``uniform`` says that all files were written in the declared types: one
    scan with that schema, no footer read while planning; ``months`` then names
    the month folders to open (all without it).
    """
    if uniform:
        declared = T.StructType([*schema.fields, T.StructField(RAW_PARTITION, T.StringType())])
        if months is not None:
            if not months:
                return spark.createDataFrame([], declared)
            return spark.read.schema(declared).option("basePath", root).parquet(*months)
        return spark.read.schema(declared).parquet(root)
    parts = []
    for own, months in month_schemas(spark, root):
        full = T.StructType([*own.fields, T.StructField(RAW_PARTITION, T.StringType())])
        folders = [f"{root}/{RAW_PARTITION}={m}" for m in months]
        scan = spark.read.option("basePath", root).schema(full).parquet(*folders)
        parts.append(conform_read(scan, schema))
    if not parts:
        return spark.createDataFrame([], RAW_TRIPS_PARTITIONED)
    return reduce(lambda a, b: a.unionByName(b), parts)


def conform_raw(raw: DataFrame, schema=RAW_TRIPS) -> DataFrame:
    """The declared raw columns, by name, in the declared types."""
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                      F.col(RAW_PARTITION))


#: Month for the folders, the others so that one month's rows can be split.
RANGE_KEYS = (RAW_PARTITION, "tpep_pickup_datetime", "PULocationID", "total_amount")


def write_raw_months(raw: DataFrame, root: str, mode: str = "overwrite",
                     conform: bool = True, layout: str = "range", rows: int | None = None) -> None:
    """Land raw rows as ``trip_month=`` folders, by default in the declared
    types; dynamic partition overwrite replaces only the months present in
    ``raw``.  ``rows``: about how many rows there are, for which the shuffles
    of ``raw`` and of the layout are planned.

    ``range``: range-partition on month and splitting keys - each task writes
    a contiguous slice of one or two months, and a month holding a large
    share of the rows is split across tasks.  For input whose rows arrive
    mixed across months (a join's output).
    ``local``: no shuffle - each task writes what it read.  For copying
    monthly files, where every input split already belongs to one month, so
    each task writes a single file and split sizes bound the task size.
    """
    rel = conform_raw(raw) if conform else raw
    if layout == "range":
        rel = rel.repartitionByRange(*RANGE_KEYS)
    elif layout == "local":
        rel = rel.sortWithinPartitions(RAW_PARTITION)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    with shuffles_for(raw.sparkSession, rows):
        (rel
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(RAW_PARTITION)
            .parquet(root))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with one header line (S3)."""
    return (spark.read.schema(ZONE_LOOKUP)
            .option("header", True).option("sep", ",").option("quote", '"')
            .option("mode", "FAILFAST")
            .csv(path))


def write_zone_lookup_csv(lookup: DataFrame, path: str) -> None:
    (lookup.coalesce(1).write.mode("overwrite")
        .option("header", True).option("quoteAll", True)
        .csv(path))
