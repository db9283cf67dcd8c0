"""Dashboard marts (D38-D42).  Each collapses the fact to a small grouped
aggregate first and joins the dimensions to that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _measures(*keys) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("n_total"),
        F.sum("tip_pct").alias("s_tip"),
        F.count("tip_pct").alias("n_tip"),
        F.sum("trip_duration_min").alias("minutes"),
    ]


def _reagg() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("trips", "revenue", "n_total", "s_tip", "n_tip", "minutes")]


def _finish(df: DataFrame, *keys) -> DataFrame:
    return df.select(
        *keys,
        F.coalesce(F.col("trips"), F.lit(0)).cast("bigint").alias("trips"),
        _d("revenue").alias("revenue"),
        (_d("revenue") / _d("n_total")).alias("avg_fare"),
        (_d("s_tip") / _d("n_tip")).alias("avg_tip_pct"),
        F.when(F.col("minutes") != 0, _d("revenue") / _d("minutes")).alias("revenue_per_min"))


def kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("trips"),
        _d(F.sum("total_amount")).alias("revenue"),
        (_d(F.sum("total_amount")) / _d(F.count("total_amount"))).alias("avg_fare"))


def monthly_trend(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("year_month", "pu_is_cbd").agg(*_measures())
    return _finish(g, "year_month", "pu_is_cbd").orderBy("year_month", "pu_is_cbd")


def zone_map(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Every zone of the dimension with its pickup metrics (0 trips when
    none)."""
    g = fact.groupBy("pu_zone_key").agg(*_measures())
    z = dim_zone.select(F.col("zone_key").alias("location_id"), "borough", "zone", "is_cbd")
    j = z.join(g, z.location_id == g.pu_zone_key, "left")
    return _finish(j, "location_id", "borough", "zone", "is_cbd")


def hour_heatmap(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Day of week x hour grid with the hour's daypart."""
    g = fact.groupBy("date_key", "time_key").agg(*_measures())
    j = (g.join(dim_date.select("date_key", "dow"), "date_key")
          .join(dim_time.select("time_key", "hour", "daypart"), "time_key"))
    return _finish(j.groupBy("dow", "hour", "daypart").agg(*_reagg()), "dow", "hour", "daypart")


def metric_slices(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Revenue, volume, tip and efficiency for every combination of pickup
    zone, daypart and payment type, with subtotals (CUBE); ``slice_level``
    is the grouping id (bit set = column rolled up)."""
    g = fact.groupBy("pu_zone_key", "time_key", "payment_key").agg(*_measures())
    j = g.join(dim_time.select("time_key", "daypart"), "time_key")
    c = (j.cube("pu_zone_key", "daypart", "payment_key")
          .agg(*_reagg(), F.grouping_id().alias("slice_level")))
    return _finish(c, "pu_zone_key", "daypart", "payment_key",
                   F.col("slice_level").cast("int").alias("slice_level"))


def trips_with_zone_roles(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """The zone dimension role-played as pickup and as dropoff zone."""
    pu = dim_zone.select(F.col("zone_key").alias("_pu"), F.col("borough").alias("pu_borough"),
                         F.col("zone").alias("pu_zone"))
    do = dim_zone.select(F.col("zone_key").alias("_do"), F.col("borough").alias("do_borough"),
                         F.col("zone").alias("do_zone"))
    j = (fact.join(pu, fact.pu_zone_key == pu._pu, "left")
             .join(do, fact.do_zone_key == do._do, "left"))
    return j.select("trip_key", "pu_zone_key", "pu_borough", "pu_zone",
                    "do_zone_key", "do_borough", "do_zone")
