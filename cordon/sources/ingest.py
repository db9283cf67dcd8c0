"""Idempotent monthly ingest.

A landing area holds monthly raw files (``trip_month=YYYY-MM/``); the raw
store receives every month it has not taken yet.  A month counts as taken only
by its marker, a row in ``<store>/_months`` that is written after the month's
rows are committed.  A run that breaks between the two leaves no marker, so the
next run writes that month again, whole: dynamic partition overwrite replaces
what the broken run left.  Re-running with nothing pending writes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.schemas import RAW_PARTITION
from cordon.sources.raw import list_months, read_raw_trips, write_raw_months

MARKER = f"{RAW_PARTITION} string, rows long"


def taken_months(spark: SparkSession, store: str) -> DataFrame:
    """(trip_month, rows) of the months whose rows are committed."""
    try:
        return spark.read.schema(MARKER).parquet(f"{store}/_months")
    except AnalysisException as e:  # the first run
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKER)


def pending_months(spark: SparkSession, landing: str, store: str) -> DataFrame:
    return list_months(spark, landing).join(taken_months(spark, store), RAW_PARTITION, "left_anti")


def ingest_pending(spark: SparkSession, landing: str, store: str) -> DataFrame:
    """Copy the pending months of ``landing``; returns them with their row
    counts."""
    todo = sorted(r[RAW_PARTITION] for r in pending_months(spark, landing, store).collect())
    if not todo:
        return spark.createDataFrame([], MARKER)
    rows = read_raw_trips(spark, landing).filter(F.col(RAW_PARTITION).isin(todo))
    write_raw_months(rows, store, layout="local")
    done = (read_raw_trips(spark, store, uniform=True).filter(F.col(RAW_PARTITION).isin(todo))
            .groupBy(RAW_PARTITION).agg(F.count(F.lit(1)).alias("rows")))
    done.write.mode("append").parquet(f"{store}/_months")
    return taken_months(spark, store).filter(F.col(RAW_PARTITION).isin(todo))
