"""Treated-zone classification (D5-D7) and the unmatched-name audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.config import PipelineConfig


def classify_zones(lookup: DataFrame, cfg: PipelineConfig,
                   boroughs=None, names=None) -> DataFrame:
    """location_id, borough, zone, service_zone, is_cbd (1 iff the borough is
    treated and the zone name is in the treated list)."""
    boroughs = list(cfg.treated_boroughs if boroughs is None else boroughs)
    names = list(cfg.treated_zones if names is None else names)
    treated = F.col("Borough").isin(boroughs) & F.col("Zone").isin(names)
    return lookup.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
        F.when(treated, 1).otherwise(0).alias("is_cbd"),
    )


def treated_zone_list(zone_ref: DataFrame) -> DataFrame:
    return (zone_ref.filter(F.col("is_cbd") == 1)
            .select("location_id", "zone")
            .orderBy("zone", "location_id"))


def treated_zone_counts(zone_ref: DataFrame) -> DataFrame:
    return zone_ref.groupBy("is_cbd").agg(F.count(F.lit(1)).alias("zones"))


def unmatched_treated_names(zone_ref: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Treated-list names that match no zone of a treated borough; the
    classification would silently ignore them."""
    from cordon.operators.dims import inline_table
    names = inline_table(zone_ref.sparkSession, [(n,) for n in cfg.treated_zones],
                         [("zone", "string")])
    matched = zone_ref.filter(F.col("borough").isin(list(cfg.treated_boroughs))).select("zone")
    return names.join(matched, "zone", "left_anti")
