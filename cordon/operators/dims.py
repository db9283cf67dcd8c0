"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.config import PipelineConfig
from cordon.functions import date_key, daypart, iso_dow, month_label


def dim_zone(zone_ref: DataFrame) -> DataFrame:
    """Zone dimension; natural id is the key.  Role-played as pickup and
    dropoff zone."""
    return zone_ref.select(
        F.col("location_id").alias("zone_key"), "location_id", "borough", "zone",
        "service_zone", "is_cbd")


def inline_table(spark: SparkSession, rows, columns: list[tuple[str, str]]) -> DataFrame:
    """A small constant table as an SQL inline table (VALUES): a local
    relation the planner knows the exact size of, so it is broadcast."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return repr(v)
    names = ", ".join(n for n, _ in columns)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in columns)
    if not rows:
        return spark.sql(f"SELECT {casts} FROM VALUES ({', '.join('NULL' for _ in columns)}) "
                         f"AS t({names}) WHERE FALSE")
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def _decode(spark: SparkSession, rows, key: str, desc: str) -> DataFrame:
    return inline_table(spark, list(rows), [(key, "int"), (desc, "string")])


def dim_payment(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return _decode(spark, cfg.payment_codes, "payment_key", "payment_desc")


def dim_ratecode(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return _decode(spark, cfg.ratecode_codes, "ratecode_key", "ratecode_desc")


def dim_vendor(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return _decode(spark, cfg.vendor_codes, "vendor_key", "vendor_desc")


def dim_date(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """One row per calendar date of the window, with the pre/post period
    defined once from ``cfg.cutoff``."""
    n_days = (cfg.window_end - cfg.window_start).days
    d = F.date_add(F.lit(cfg.window_start), F.col("id").cast("int"))
    spine = spark.range(0, n_days, 1, 1).select(d.alias("date"))
    dow = iso_dow("date")
    return spine.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        dow.alias("dow"),
        month_label("date").alias("year_month"),
        F.when(dow.isin(list(cfg.weekend_iso_days)), 1).otherwise(0).alias("is_weekend"),
        F.when(F.col("date") >= F.lit(cfg.cutoff), "post").otherwise("pre").alias("period"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per hour of day with its daypart."""
    h = F.col("id").cast("int")
    return spark.range(0, 24, 1, 1).select(
        h.alias("time_key"), h.alias("hour"), daypart(h).alias("daypart"))
