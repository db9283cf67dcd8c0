"""Difference-in-differences as grouped aggregations.

The 2x2 DiD is one call: ``(post_t - pre_t) - (post_c - pre_c)`` of a cell
statistic.  Volume cells are trips / (observed days x zones with trips);
mean cells are exact sums divided once by counts.  All operators read the
zone x day aggregate (``panel.zone_day``), never the trips.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.config import PipelineConfig
from cordon.operators.panel import group_days


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _cell(flag: int, period: str, value: str) -> Column:
    return F.max(F.when((F.col("_g") == flag) & (F.col("_p") == period), F.col(value)))


def _cells(value: str, pre: str = "pre", post: str = "post", prefix: str = "") -> list[Column]:
    """The four cells of a 2x2 as columns of one row."""
    return [_cell(g, p, value).alias(f"{prefix}{n}_{w}")
            for g, n in ((1, "treated"), (0, "control")) for p, w in ((pre, "pre"), (post, "post"))]


def _change(group: str, prefix: str = "") -> Column:
    return F.col(f"{prefix}{group}_post") - F.col(f"{prefix}{group}_pre")


def _did(prefix: str = "") -> Column:
    """Change of the treated group over the change of the control group."""
    return _change("treated", prefix) - _change("control", prefix)


def rounded(df: DataFrame, digits: int | dict[str, int]) -> DataFrame:
    """Display variant of a result: DOUBLE columns rounded (``digits``: one
    number, or by column; columns not named stay)."""
    out = []
    for f in df.schema.fields:
        n = digits if isinstance(digits, int) else digits.get(f.name)
        out.append(F.round(f.name, n).alias(f.name) if f.dataType.typeName() == "double" and n is not None
                   else F.col(f.name))
    return df.select(*out)


def _period(cutoff: dt.date | None, pre: str = "pre", post: str = "post") -> Column:
    if cutoff is None:
        return F.col("period")
    return F.when(F.col("date") >= F.lit(cutoff), post).otherwise(pre)


def volume_cells(zd: DataFrame, dim_date: DataFrame, zone_counts: DataFrame,
                 cutoff: dt.date | None = None, date_before: dt.date | None = None,
                 group_col: str = "pu_is_cbd") -> DataFrame:
    """(group, period, trips, days, n_zones, rate).  ``cutoff`` None uses the
    date dimension's own period; ``date_before`` restricts the dates."""
    daily = group_days(zd, dim_date, group_col)
    if date_before is not None:
        daily = daily.filter(F.col("date") < F.lit(date_before))
    cells = (daily.withColumn("_p", _period(cutoff))
             .groupBy(group_col, "_p")
             .agg(F.sum("trips").alias("trips"), F.count(F.lit(1)).alias("days")))
    cells = cells.join(zone_counts, group_col)
    return cells.select(
        F.col(group_col).alias("_g"), "_p", "trips", "days", "n_zones",
        (_d("trips") / (F.col("days") * F.col("n_zones")).cast("double")).alias("rate"))


def did_volume(zd: DataFrame, dim_date: DataFrame, zone_counts: DataFrame,
               digits: int | None = None) -> DataFrame:
    """Outcome A: trips per zone-day, treated vs control, pre vs post."""
    r = volume_cells(zd, dim_date, zone_counts).agg(*_cells("rate"))
    out = r.select(
        F.lit("volume_trips_per_zone_day").alias("outcome"),
        "treated_pre", "treated_post", "control_pre", "control_post",
        _change("treated").alias("treated_change"), _change("control").alias("control_change"),
        _did().alias("did_estimate"),
        (F.lit(100.0) * _did() / F.col("treated_pre")).alias("did_pct_of_treated_pre"))
    if digits is None:
        return out
    places = {c: digits for c in out.columns[1:]} | {"did_pct_of_treated_pre": 1}
    return rounded(out, places)


def placebo_did(zd: DataFrame, dim_date: DataFrame, zone_counts: DataFrame,
                cfg: PipelineConfig) -> DataFrame:
    """Volume DiD at the fake cutoff on dates before ``placebo_end`` only."""
    cells = volume_cells(zd, dim_date, zone_counts, cutoff=cfg.placebo_cutoff,
                         date_before=cfg.placebo_end)
    return cells.agg(*_cells("rate")).select(
        F.lit("placebo_volume").alias("test"),
        _did().alias("placebo_did_estimate_should_be_near_zero"))


def did_means(zd: DataFrame, dim_date: DataFrame, card_only: bool = True,
              group_col: str = "pu_is_cbd") -> DataFrame:
    """Outcomes B and C: DiD of mean trip distance and mean tip % (both on
    card trips only, as in the study)."""
    p = "card_" if card_only else ""
    per = (zd.groupBy(group_col, "date_key")
           .agg(F.sum(f"{p}dist_sum").alias("s_dist"), F.sum(f"{p}dist_n").alias("n_dist"),
                F.sum(f"{p}tip_sum").alias("s_tip"), F.sum(f"{p}tip_n").alias("n_tip"))
           .join(dim_date, "date_key")
           .groupBy(group_col, "period")
           .agg(F.sum("s_dist").alias("s_dist"), F.sum("n_dist").alias("n_dist"),
                F.sum("s_tip").alias("s_tip"), F.sum("n_tip").alias("n_tip")))
    cells = per.select(F.col(group_col).alias("_g"), F.col("period").alias("_p"),
                       (_d("s_dist") / _d("n_dist")).alias("avg_distance"),
                       (_d("s_tip") / _d("n_tip")).alias("avg_tip_pct"))

    row = cells.agg(*_cells("avg_distance", prefix="d_"), *_cells("avg_tip_pct", prefix="t_"))
    return row.select(_did("d_").alias("d"), _did("t_").alias("t")).selectExpr(
        "stack(2, 'avg_trip_distance', d, 'avg_tip_pct', t) AS (outcome, did_estimate)")


# The group labels of the trend outputs.
TREATED_LABEL = "treated_CBD"
CONTROL_LABEL = "control_nonCBD"


MEASURES = {"trip_distance": ("dist_sum", "dist_n"), "tip_pct": ("tip_sum", "tip_n")}


def parallel_trends(zd: DataFrame, dim_date: DataFrame, zone_counts: DataFrame,
                    measure: str = "volume", group_col: str = "pu_is_cbd") -> DataFrame:
    """Monthly series per group: mean over days of trips per zone (volume),
    or the monthly mean of a trip measure (``trip_distance``, ``tip_pct``)."""
    grp = F.when(F.col(group_col) == 1, TREATED_LABEL).otherwise(CONTROL_LABEL).alias("grp")
    if measure == "volume":
        daily = group_days(zd, dim_date, group_col).join(zone_counts, group_col)
        out = (daily.groupBy("year_month", grp)
               .agg(F.sum("trips").alias("s"), F.count(F.lit(1)).alias("n"),
                    F.max("n_zones").alias("z"))
               .select("year_month", "grp",
                       (_d("s") / (F.col("n") * F.col("z")).cast("double"))
                       .alias("avg_trips_per_zone_day")))
    else:
        s_col, n_col = MEASURES[measure]
        per = (zd.groupBy(group_col, "date_key")
               .agg(F.sum(s_col).alias("s"), F.sum(n_col).alias("n"))
               .join(dim_date, "date_key").join(zone_counts, group_col))
        out = (per.groupBy("year_month", grp)
               .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
               .select("year_month", "grp", (_d("s") / _d("n")).alias(f"avg_{measure}")))
    return out.orderBy("year_month", "grp")


def parallel_trends_wide(trends: DataFrame) -> DataFrame:
    """Month x group table (one column per group)."""
    value = [c for c in trends.columns if c not in ("year_month", "grp")][0]
    return (trends.groupBy("year_month")
            .pivot("grp", [CONTROL_LABEL, TREATED_LABEL])
            .agg(F.max(value))
            .orderBy("year_month"))


def boundary_sensitivity(zd: DataFrame, dim_date: DataFrame, zone_ref: DataFrame,
                         cfg: PipelineConfig, borderline=None) -> DataFrame:
    """Volume DiD re-run with borderline zones moved across the boundary.

    Scenarios: ``baseline``, one per borderline zone, and ``all`` when there
    are several.  Each scenario is a zone -> flag table (zones x scenarios
    rows); the trips enter once, as a (zone, date) aggregate joined to it,
    and one grouped aggregation yields every scenario's 2x2.
    """
    borderline = list(cfg.borderline_zones if borderline is None else borderline)
    scenarios = [("baseline", [])] + [(f"move {z}", [z]) for z in borderline]
    if len(borderline) > 1:
        scenarios.append(("move all", borderline))
    flag = F.col("is_cbd")
    entries = []
    for name, moved in scenarios:
        f = F.when(F.col("zone").isin(moved), F.lit(1) - flag).otherwise(flag) if moved else flag
        entries.append(F.struct(F.lit(name).alias("scenario"),
                                F.lit(", ".join(moved)).alias("moved_zones"),
                                f.alias("treated")))
    flags = (zone_ref.select(F.col("location_id").alias("pu_zone_key"),
                             F.explode(F.array(*entries)).alias("s"))
             .select("pu_zone_key", "s.*"))
    per = (zd.groupBy("pu_zone_key", "date_key").agg(F.sum("trips").alias("trips"))
           .join(dim_date.select("date_key", "date", "period"), "date_key"))
    j = per.join(flags, "pu_zone_key")
    keys = ["scenario", "moved_zones", "treated"]
    n_zones = j.groupBy(*keys).agg(F.countDistinct("pu_zone_key").alias("n_zones"))
    cells = (j.groupBy(*keys, "period")
             .agg(F.sum("trips").alias("trips"), F.countDistinct("date").alias("days"))
             .join(n_zones, keys)
             .select("scenario", "moved_zones", F.col("treated").alias("_g"),
                     F.col("period").alias("_p"),
                     (_d("trips") / (F.col("days") * F.col("n_zones")).cast("double")).alias("rate")))
    return cells.groupBy("scenario", "moved_zones").agg(*_cells("rate")).select(
        "scenario", "moved_zones", "treated_pre", "treated_post", "control_pre", "control_post",
        _did().alias("did_estimate"))
