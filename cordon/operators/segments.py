"""Zone x daypart revenue-efficiency segmentation (D33) and concentration
(D34).  The fact is first collapsed to (zone, hour) - at most zones x 24
rows - so the dimension joins and the global windows (rank, ntile, share)
only ever see that small aggregate, never trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def zone_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pu_zone_key", "time_key").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("n_total"),
        F.sum("trip_duration_min").alias("minutes"),
        F.count("trip_duration_min").alias("n_minutes"),
    )


def segment_stats(fact: DataFrame, dim_zone: DataFrame, dim_time: DataFrame,
                  keys=("borough", "zone", "daypart")) -> DataFrame:
    zh = zone_hour(fact)
    z = dim_zone.select("zone_key", "borough", "zone")
    j = (zh.join(z, zh.pu_zone_key == z.zone_key)
           .join(dim_time.select("time_key", "daypart"), "time_key"))
    seg = j.groupBy(*keys).agg(
        F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"),
        F.sum("n_total").alias("n_total"), F.sum("minutes").alias("minutes"),
        F.sum("n_minutes").alias("n_minutes"))
    return seg.select(
        *keys, "trips", "revenue",
        (_d("revenue") / _d("n_total")).alias("avg_fare"),
        (_d("minutes") / _d("n_minutes")).alias("avg_duration_min"),
        F.when(F.col("minutes") != 0, _d("revenue") / _d("minutes")).alias("revenue_per_min"))


def segment_ranking(fact: DataFrame, dim_zone: DataFrame, dim_time: DataFrame,
                    min_trips: int, top: int | None, deciles: int = 10) -> DataFrame:
    """Segments with at least ``min_trips`` trips ranked by revenue per
    minute (NULL efficiency ranks last), their share of the eligible revenue
    and efficiency decile; the ``top`` best."""
    keys = ("borough", "zone", "daypart")
    seg = segment_stats(fact, dim_zone, dim_time, keys).filter(F.col("trips") >= min_trips)
    eff = F.col("revenue_per_min").desc_nulls_last()
    # one global window over the small segment aggregate
    w_rank = Window.orderBy(eff)
    w_tile = Window.orderBy(eff, *keys)
    w_all = Window.partitionBy()
    ranked = seg.select(
        F.rank().over(w_rank).alias("efficiency_rank"),
        *keys,
        F.col("trips"),
        _d("revenue").alias("revenue"),
        "avg_fare",
        "revenue_per_min",
        (F.lit(100.0) * _d("revenue") / _d(F.sum("revenue").over(w_all))).alias("pct_of_total_revenue"),
        F.ntile(deciles).over(w_tile).alias("efficiency_decile"),
    )
    ordered = ranked.orderBy("efficiency_rank", *keys)
    return ordered.limit(top) if top is not None else ordered


def segment_concentration(fact: DataFrame, dim_zone: DataFrame, dim_time: DataFrame,
                          min_trips: int, deciles: int = 10) -> DataFrame:
    """Top efficiency decile versus the rest: segments, revenue, % of the
    eligible revenue.  Segments here are (zone, daypart) - a zone name shared
    by two boroughs is one segment, as in the study."""
    keys = ("zone", "daypart")
    seg = segment_stats(fact, dim_zone, dim_time, keys).filter(F.col("trips") >= min_trips)
    w_tile = Window.orderBy(F.col("revenue_per_min").desc_nulls_last(), *keys)
    d = seg.withColumn("decile", F.ntile(deciles).over(w_tile))
    bucket = F.when(F.col("decile") == 1, "top_decile").otherwise("rest").alias("bucket")
    g = d.groupBy(bucket).agg(F.count(F.lit(1)).alias("segments"),
                              F.sum("revenue").alias("revenue"))
    return g.select("bucket", "segments", _d("revenue").alias("revenue"),
                    (F.lit(100.0) * _d("revenue") / _d(F.sum("revenue").over(Window.partitionBy())))
                    .alias("pct_of_revenue"))
