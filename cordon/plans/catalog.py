"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator.

Each query runs over the trips adapter of the test tables in ``sf_dir`` with
the ``TPCH_TRIPS`` profile.  Queries share one ``Warehouse`` per session and
folder, so the fact is built and written once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.config import TPCH_TRIPS
from cordon.operators import causal, marts, panel, permutation, profiling, quality, regression, segments, serving, zones
from cordon.operators import dims as dims_ops
from cordon.operators import fact as fact_ops
from cordon.plans.warehouse import tpch_warehouse

CFG = TPCH_TRIPS

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        _QUERIES[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _wh(spark, sf_dir):
    return tpch_warehouse(spark, sf_dir, CFG)


def _zc(wh):
    return panel.active_zone_counts(wh.zone_day, wh.dim_zone)


# -- causal --------------------------------------------------------------------

@query("did_volume")
def q_did_volume(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.did_volume(wh.zone_day, wh.dim_date, _zc(wh))


@query("did_means")
def q_did_means(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.did_means(wh.zone_day, wh.dim_date)


@query("placebo_did")
def q_placebo(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.placebo_did(wh.zone_day, wh.dim_date, _zc(wh), CFG)


@query("active_zone_counts")
def q_active_zone_counts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return _zc(wh).select("pu_is_cbd", F.col("n_zones").cast("bigint").alias("n_zones"))


@query("parallel_trends")
def q_parallel_trends(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.parallel_trends(wh.zone_day, wh.dim_date, _zc(wh))


@query("parallel_trends_wide")
def q_parallel_trends_wide(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.parallel_trends_wide(causal.parallel_trends(wh.zone_day, wh.dim_date, _zc(wh)))


@query("did_boundary_sensitivity")
def q_boundary(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return causal.boundary_sensitivity(wh.zone_day, wh.dim_date, wh.zone_ref, CFG)


@query("did_panel")
def q_did_panel(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return panel.did_panel(wh.zone_day, wh.dim_date, _zc(wh), CFG.cutoff)


# -- segmentation -----------------------------------------------------------------

@query("segment_top25")
def q_segment_top(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return segments.segment_ranking(wh.fact, wh.dim_zone, wh.dim_time,
                                    CFG.min_segment_trips, CFG.top_segments, CFG.deciles)


@query("segment_concentration")
def q_segment_conc(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return segments.segment_concentration(wh.fact, wh.dim_zone, wh.dim_time,
                                          CFG.min_segment_trips, CFG.deciles)


# -- fact stages ----------------------------------------------------------------------

def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE for engine-neutral comparison."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "decimal":
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


@query("fact_trips")
def q_fact(spark, sf_dir):
    return _doubles(_wh(spark, sf_dir).fact)


@query("fact_incremental")
def q_fact_incremental(spark, sf_dir):
    """The fact kept by months: all but the last two file months first, then
    those two late, then the first one once more."""
    from cordon.plans.incremental import MonthlyFact
    from cordon.sources.raw import list_months
    wh = _wh(spark, sf_dir)
    months = sorted(r[0] for r in list_months(spark, wh.raw_path).collect())
    fact = MonthlyFact(spark, wh.raw_path, _scratch(spark, "fact_incremental"), wh.dim_zone, CFG,
                       wh.source_raw.schema)
    for arrived in (months[:-2], months[-2:], months[:1]):
        fact.update(arrived)
    return _doubles(fact.fact())


@query("fact_streamed")
def q_fact_streamed(spark, sf_dir):
    """The landed months taken as a stream, gated per batch; run twice on one
    checkpoint (the second run must add nothing)."""
    from cordon.plans.incremental import MonthlyFact
    from cordon.streaming.fact import stream_fact
    wh = _wh(spark, sf_dir)
    fact = MonthlyFact(spark, _scratch(spark, "stream_store"), _scratch(spark, "fact_streamed"), wh.dim_zone, CFG,
                       wh.source_raw.schema)
    ckpt = _scratch(spark, "stream_fact")
    n = stream_fact(spark, wh.raw_path, fact, wh.dims, ckpt).count()
    if stream_fact(spark, wh.raw_path, fact, wh.dims, ckpt).count() != n:
        raise RuntimeError("the stream is not idempotent: files were taken twice")
    return _doubles(fact.fact())


# -- sources -------------------------------------------------------------------------

def _scratch(spark, name):
    from cordon.plans.scratch import scratch_path
    return scratch_path(spark, name)


@query("src_raw_trips")
def q_src_raw(spark, sf_dir):
    """The landed monthly folders read in the declared types (partition
    discovery of ``trip_month``)."""
    from cordon.sources import read_raw_trips
    return read_raw_trips(spark, _wh(spark, sf_dir).raw_path)


@query("src_zone_lookup")
def q_src_zone_lookup(spark, sf_dir):
    """Zone lookup written as a quoted CSV with a header and read back."""
    from cordon.sources import read_zone_lookup, write_zone_lookup_csv
    wh = _wh(spark, sf_dir)
    path = _scratch(spark, "zone_lookup")
    write_zone_lookup_csv(wh.lookup, path)
    return read_zone_lookup(spark, path)


@query("ingest_pending_months")
def q_ingest(spark, sf_dir):
    """Ingest every landed month into an empty store, twice (the second run
    must add nothing); rows per month in the store."""
    from cordon.sources import read_raw_trips
    from cordon.sources.ingest import ingest_pending
    landing, store = _wh(spark, sf_dir).raw_path, _scratch(spark, "store")
    ingest_pending(spark, landing, store)
    if not ingest_pending(spark, landing, store).isEmpty():
        raise RuntimeError("ingest is not idempotent: months were copied twice")
    return (read_raw_trips(spark, store, uniform=True).groupBy("trip_month")
            .agg(F.count(F.lit(1)).alias("trips")))


@query("stream_ingest_months")
def q_stream_ingest(spark, sf_dir):
    """The same ingest as an availableNow Structured Streaming job, run twice
    on one checkpoint; rows per month in the store."""
    from cordon.streaming import stream_ingest
    landing = _wh(spark, sf_dir).raw_path
    store, ckpt = _scratch(spark, "s_store"), _scratch(spark, "s_ckpt")
    stream_ingest(spark, landing, store, ckpt)
    return (stream_ingest(spark, landing, store, ckpt).groupBy("trip_month")
            .agg(F.count(F.lit(1)).alias("trips")))


# -- profiling --------------------------------------------------------------------------


@query("profile_rows_by_month")
def q_prof_month(spark, sf_dir):
    return profiling.rows_by_month(_wh(spark, sf_dir).raw)


@query("profile_invalid_rates")
def q_prof_invalid(spark, sf_dir):
    return profiling.invalid_rates(_wh(spark, sf_dir).raw)


@query("profile_value_ranges")
def q_prof_ranges(spark, sf_dir):
    return profiling.value_ranges(_wh(spark, sf_dir).raw)


@query("profile_key_cardinality")
def q_prof_card(spark, sf_dir):
    return profiling.key_cardinality(_wh(spark, sf_dir).raw)


@query("profile_cardinality_sketches")
def q_prof_sketches(spark, sf_dir):
    """Monthly sketches, the last month added alone; their merged estimates
    against exact counts."""
    from cordon.sources.raw import list_months
    wh, store = _wh(spark, sf_dir), _scratch(spark, "sketches")
    months = sorted(r[0] for r in list_months(spark, wh.raw_path).collect())
    for own in (months[:-1], months[-1:]):
        profiling.update_sketches(spark, wh.raw_path, store, own)
    return profiling.sketch_accuracy(spark.read.parquet(store), wh.raw)


# -- zones and dimensions ------------------------------------------------------------------


@query("zone_treated_ref")
def q_zone_ref(spark, sf_dir):
    return _wh(spark, sf_dir).zone_ref


@query("zone_treated_list")
def q_zone_list(spark, sf_dir):
    return zones.treated_zone_list(_wh(spark, sf_dir).zone_ref)


@query("zone_treated_counts")
def q_zone_counts(spark, sf_dir):
    return zones.treated_zone_counts(_wh(spark, sf_dir).zone_ref)


@query("zone_treated_unmatched")
def q_zone_unmatched(spark, sf_dir):
    return zones.unmatched_treated_names(_wh(spark, sf_dir).zone_ref, CFG)


@query("dim_zone")
def q_dim_zone(spark, sf_dir):
    return dims_ops.dim_zone(_wh(spark, sf_dir).zone_ref)


# -- fact stages ------------------------------------------------------------------------------


@query("trips_cleaned")
def q_cleaned(spark, sf_dir):
    return _doubles(_wh(spark, sf_dir).cleaned)


@query("exclusion_counts")
def q_exclusions(spark, sf_dir):
    return fact_ops.exclusion_counts(_wh(spark, sf_dir).raw, CFG)


@query("trips_deduped")
def q_deduped(spark, sf_dir):
    return _doubles(_wh(spark, sf_dir).deduped)


@query("trips_keyed")
def q_keyed(spark, sf_dir):
    return _doubles(_wh(spark, sf_dir).keyed)


@query("trip_with_zone_roles")
def q_roles(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.trips_with_zone_roles(wh.fact, wh.dim_zone)


# -- data quality ---------------------------------------------------------------------------------


@query("dq_row_reconciliation")
def q_dq1(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.row_reconciliation(wh.raw, wh.fact, CFG)


@query("dq_referential_integrity")
def q_dq2(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.referential_integrity(wh.fact, wh.dims)


@query("dq_range_assertions")
def q_dq3(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.range_assertions(wh.fact, CFG)


@query("dq_duplicate_keys")
def q_dq4(spark, sf_dir):
    return quality.duplicate_keys(_wh(spark, sf_dir).fact)


@query("dq_schema_drift")
def q_dq5(spark, sf_dir):
    return quality.schema_drift(_wh(spark, sf_dir).raw)


@query("dq_month_completeness")
def q_dq6(spark, sf_dir):
    return quality.month_completeness(_wh(spark, sf_dir).fact, CFG)


@query("dq_gate_report")
def q_gate(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return quality.gate_report(wh.raw, wh.fact, wh.dims, CFG)


@query("dq_gate_observed")
def q_gate_observed(spark, sf_dir):
    """The gate with its fused pass observed while the fact is written."""
    from cordon.plans.warehouse import read_fact, write_fact
    wh = _wh(spark, sf_dir)
    path = _scratch(spark, "fact_observed")
    observer = quality.FactObserver(wh.dims, CFG)
    write_fact(wh.fact_plan, path, observer.mark, wh.raw_rows)
    return observer.report(wh.raw, read_fact(spark, path, wh.fact_plan.schema))


# -- serving ------------------------------------------------------------------------------------------


@query("post_period_trips")
def q_post_period(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return serving.post_period_trips(wh.fact, wh.dim_date)


@query("serving_fact")
def q_serving(spark, sf_dir):
    """Typed serving table: contract cast, written, read back."""
    from cordon.plans.build import publish_serving
    wh = _wh(spark, sf_dir)
    path = _scratch(spark, "serving_fact")
    return publish_serving(wh.fact, path, rows=wh.raw_rows)


@query("serving_dim_zone")
def q_serving_dim_zone(spark, sf_dir):
    """Typed serving copy of the zone dimension (the dimension that is read
    from given tables), written and read back."""
    from cordon.plans.build import publish_serving_dim
    return publish_serving_dim(_wh(spark, sf_dir).dim_zone, "zone", _scratch(spark, "serving_dim_zone"))


@query("serving_rounding")
def q_serving_rounding(spark, sf_dir):
    """Rows whose money the serving contract's scale rounds, per column."""
    return serving.contract_rounding(_wh(spark, sf_dir).fact)


@query("trips_by_calendar")
def q_calendar(spark, sf_dir):
    """Trips per year, month, weekend flag and period (every column of the
    date dimension)."""
    wh = _wh(spark, sf_dir)
    return panel.calendar_profile(wh.zone_day, wh.dim_date)


@query("trips_per_period")
def q_trips_per_period(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return serving.trips_per_period(wh.fact, wh.dim_date)


@query("orphan_zone_recheck")
def q_orphan_recheck(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return serving.orphan_zone_recheck(wh.fact, wh.dim_zone)


# -- marts ----------------------------------------------------------------------------------------------


@query("mart_kpis")
def q_kpis(spark, sf_dir):
    return marts.kpis(_wh(spark, sf_dir).fact)


@query("mart_monthly_trend")
def q_monthly(spark, sf_dir):
    return marts.monthly_trend(_wh(spark, sf_dir).fact)


@query("mart_zone_map")
def q_zone_map(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.zone_map(wh.fact, wh.dim_zone)


@query("mart_hour_heatmap")
def q_heatmap(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.hour_heatmap(wh.fact, wh.dim_date, wh.dim_time)


@query("mart_metric_slices")
def q_slices(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.metric_slices(wh.fact, wh.dim_time)


# -- regression -------------------------------------------------------------------------------------------


def _panel(spark, sf_dir):
    """The group x day panel (from the zone x day table; the regression
    checkpoints its own projected input)."""
    wh = _wh(spark, sf_dir)
    return panel.did_panel(wh.zone_day, wh.dim_date, _zc(wh), CFG.cutoff)


def _shown(df: DataFrame, *extra: str) -> DataFrame:
    """Estimates to 8 decimals (sums of doubles differ in the last digits
    between runs), without the p-value, which the z value determines."""
    return df.select("term", *[F.round(c, 8).alias(c) for c in ("coef", "se", "z", "ci_lo", "ci_hi")],
                     "n", F.col("k").cast("bigint").alias("k"), "cov_type", "warning", *extra)


@query("pretrend_regression")
def q_pretrend(spark, sf_dir):
    """Pre-trend slope difference with HC1 covariance and its verdict."""
    return _shown(regression.pretrend_test(_panel(spark, sf_dir), CFG.cutoff), "verdict")


def _zone_panel(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return panel.zone_day_panel(wh.zone_day, wh.dim_zone, CFG)


@query("did_regression")
def q_did_reg(spark, sf_dir):
    """DiD without fixed effects: HC1 on the group x day panel, and clustered
    by zone on the zero-filled zone x day panel."""
    hc1 = regression.did_regression(_panel(spark, sf_dir), with_fe=False)
    clustered = regression.did_regression(_zone_panel(spark, sf_dir), y="trips", with_fe=False, cov_type="cluster",
                                          cluster_col="zone")
    return _shown(hc1.unionByName(clustered))


@query("did_regression_fe")
def q_did_reg_fe(spark, sf_dir):
    """DiD with month and weekday fixed effects, HC1."""
    return _shown(regression.did_regression(_panel(spark, sf_dir)))


@query("did_regression_two_way")
def q_did_reg_two_way(spark, sf_dir):
    """DiD with zone and day effects, both absorbed, clustered by zone."""
    return _shown(regression.did_two_way(_zone_panel(spark, sf_dir)))


@query("did_permutation")
def q_did_permutation(spark, sf_dir):
    """Permutation test over the sets of zones that could have been treated."""
    return permutation.did_permutation(_zone_panel(spark, sf_dir))
