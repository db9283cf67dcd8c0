"""The shared zone x day aggregate, zone counts (D27) and the group x day
panel (D35).

``zone_day`` collapses the fact once to one row per (pickup zone, date):
trips plus exact sums and counts of the measures the analyses average (all
trips and card trips).  Its size is bounded by zones x days however many
trips there are - the partial aggregation runs before the shuffle, so even a
zone holding a large share of the trips is one row per task.  Every DiD,
trend, placebo, panel and sensitivity query derives from it instead of
rescanning the fact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.functions import date_key, month_label


def zone_day(fact: DataFrame, card_payment: int, *also: str) -> DataFrame:
    """One row per pickup zone and date; ``also``: columns the date determines."""
    card = F.col("payment_key") == card_payment

    def on_card(c: str):
        return F.when(card, F.col(c))

    return fact.groupBy(*also, "pu_zone_key", "pu_is_cbd", "date_key").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("trip_distance").alias("dist_sum"), F.count("trip_distance").alias("dist_n"),
        F.sum("tip_pct").alias("tip_sum"), F.count("tip_pct").alias("tip_n"),
        F.count(F.when(card, 1)).alias("card_trips"),
        F.sum(on_card("trip_distance")).alias("card_dist_sum"),
        F.count(on_card("trip_distance")).alias("card_dist_n"),
        F.sum(on_card("tip_pct")).alias("card_tip_sum"),
        F.count(on_card("tip_pct")).alias("card_tip_n"),
    )


def active_zone_counts(zd: DataFrame, dim_zone: DataFrame,
                       group_col: str = "pu_is_cbd") -> DataFrame:
    """Zones of the dimension that have at least one trip, per group."""
    used = zd.select("pu_zone_key", group_col).distinct()
    z = dim_zone.select("zone_key")
    return (used.join(z, used.pu_zone_key == z.zone_key)
            .groupBy(group_col)
            .agg(F.countDistinct("zone_key").alias("n_zones")))


def group_days(zd: DataFrame, dim_date: DataFrame,
               group_col: str = "pu_is_cbd") -> DataFrame:
    """Trips per (group, date) with the date's attributes; only dates with
    trips appear (the panel is not zero-filled)."""
    per_day = zd.groupBy(group_col, "date_key").agg(F.sum("trips").alias("trips"))
    return per_day.join(dim_date, "date_key")


def did_panel(zd: DataFrame, dim_date: DataFrame, zone_counts: DataFrame,
              cutoff: dt.date, group_col: str = "pu_is_cbd") -> DataFrame:
    """date, group, trips, n_zones, treated, post, trips_per_zone, month,
    dow (0 = Monday).  Groups without a zone count (unknown zones) drop out."""
    g = group_days(zd, dim_date, group_col).join(zone_counts, group_col)
    return g.select(
        "date",
        F.col(group_col),
        F.col("trips").cast("bigint").alias("trips"),
        F.col("n_zones").cast("bigint").alias("n_zones"),
        F.col(group_col).cast("int").alias("treated"),
        F.when(F.col("date") >= F.lit(cutoff), 1).otherwise(0).alias("post"),
        (F.col("trips").cast("double") / F.col("n_zones").cast("double")).alias("trips_per_zone"),
        month_label("date").alias("month"),
        F.weekday("date").alias("dow"),
    )


def zone_day_panel(zd: DataFrame, dim_zone: DataFrame, cfg, group_col: str = "pu_is_cbd") -> DataFrame:
    """Zero-filled zone x day panel: every zone of the dimension that has a
    trip, on every day of the window - zone, date, trips (0 without trips),
    treated, post.  Its size is zones x days by construction; each zone's row
    is expanded into its days, no cross join."""
    used = (zd.filter(F.col(group_col).isNotNull())
            .groupBy("pu_zone_key").agg(F.max(group_col).cast("int").alias("treated")))
    zones = used.join(dim_zone.select(F.col("zone_key").alias("pu_zone_key")).distinct(), "pu_zone_key")
    days = F.sequence(F.lit(cfg.window_start), F.lit(cfg.last_window_date), F.expr("INTERVAL 1 DAY"))
    grid = zones.select("pu_zone_key", "treated", F.explode(days).alias("date")).withColumn(
        "date_key", date_key("date"))
    trips = zd.groupBy("pu_zone_key", "date_key").agg(F.sum("trips").alias("trips"))
    return grid.join(trips, ["pu_zone_key", "date_key"], "left").select(
        F.col("pu_zone_key").alias("zone"), "date", F.coalesce("trips", F.lit(0)).cast("double").alias("trips"),
        "treated", F.when(F.col("date") >= F.lit(cfg.cutoff), 1).otherwise(0).alias("post"))


def calendar_profile(zd: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Trips and days with trips per year, month, weekend flag and period."""
    per_day = zd.groupBy("date_key").agg(F.sum("trips").alias("trips"))
    return (per_day.join(dim_date, "date_key").groupBy("year", "month", "year_month", "is_weekend", "period")
            .agg(F.sum("trips").cast("bigint").alias("trips"), F.count(F.lit(1)).alias("days"),
                 F.min("date").alias("first_date"), F.max("dow").cast("int").alias("last_dow")))
