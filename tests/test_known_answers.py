"""The adapter reproduces the published small-fixture numbers (FIXTURES §5)
when restricted to the same raw window and study window (sf0.01)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF01

from cordon.schemas import RAW_TRIPS
from cordon.config import TPCH_TRIPS
from cordon.operators import causal, panel
from cordon.operators.fact import exclusion_counts
from cordon.plans.warehouse import Warehouse
from cordon.sources import tpch_raw_trips, tpch_zone_lookup

CFG = TPCH_TRIPS.with_(window_start=dt.date(1999, 10, 1), window_end=dt.date(2001, 1, 1),
                       cutoff=dt.date(2000, 10, 5), placebo_cutoff=dt.date(2000, 4, 1),
                       placebo_end=dt.date(2000, 10, 5))


@pytest.fixture(scope="module")
def wh(spark):
    raw = tpch_raw_trips(spark, SF01).filter(
        "tpep_pickup_datetime >= '1999-09-28' and tpep_pickup_datetime < '2001-01-03'")
    return Warehouse(spark, CFG, raw, tpch_zone_lookup(spark, SF01))


def test_counts(wh):
    ex = exclusion_counts(wh.raw, CFG).first()
    assert ex.raw_rows == 12180
    assert ex.excluded_rows == 587
    assert ex.nonpos_distance == 245
    assert ex.negative_fare == 100
    assert ex.dropoff_before_pickup == 121
    f = wh.fact.agg(F.count("*").alias("n"), F.countDistinct("trip_key").alias("k"),
                    F.sum("trip_duration_min").alias("m"), F.sum("time_key").alias("h"),
                    F.sum("pu_is_cbd").alias("t"), F.countDistinct("date_key").alias("d")).first()
    assert (f.n, f.k, f.m, f.h, f.t, f.d) == (11466, 11466, 294843, 133628, 2533, 455)
    assert ex.kept_rows - f.n == 127
    assert wh.raw.filter(F.col("RatecodeID").isNull()).count() == 257


def test_did_cells(wh):
    zc = panel.active_zone_counts(wh.zone_day, wh.dim_zone)
    cells = {(r._g, r._p): (r.trips, r.days, r.n_zones)
             for r in causal.volume_cells(wh.zone_day, wh.dim_date, zc).collect()}
    assert cells[(0, "pre")] == (7177, 368, 21)
    assert cells[(0, "post")] == (1756, 87, 21)
    assert cells[(1, "pre")] == (2014, 360, 4)
    assert cells[(1, "post")] == (519, 85, 4)


def test_segments(wh):
    from cordon.operators.segments import segment_stats
    seg = segment_stats(wh.fact, wh.dim_zone, wh.dim_time)
    agg = seg.agg(F.count("*").alias("n"), F.count(F.when(F.col("trips") >= 30, 1)).alias("big"),
                  F.min("trips").alias("lo"), F.max("trips").alias("hi")).first()
    assert (agg.n, agg.big, agg.lo, agg.hi) == (125, 116, 15, 274)


def test_monthly_sketches_merge(spark, tmp_dir):
    """Estimates over merged months are within the bound, a month delivered
    again replaces its own sketch, and only its folder is read."""
    from pyspark.sql import functions as F

    from cordon.operators import profiling
    from cordon.sources import write_raw_months

    def raw(month, lo, hi):
        return spark.range(lo, hi).select(
            (F.col("id") % 3).alias("VendorID"), (F.col("id") % 250).alias("PULocationID"),
            F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("tpep_pickup_datetime"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_TRIPS.fields
              if f.name not in ("VendorID", "PULocationID", "tpep_pickup_datetime")], F.lit(month).alias("trip_month"))

    root, store = f"{tmp_dir}/raw", f"{tmp_dir}/sk"
    write_raw_months(raw("2024-01", 0, 30_000).unionByName(raw("2024-02", 20_000, 60_000)), root)
    profiling.update_sketches(spark, root, store, ["2024-01"])
    profiling.update_sketches(spark, root, store, ["2024-02"])

    def check(n):
        got = {r.key: r.estimate for r in profiling.sketched_cardinality(spark.read.parquet(store)).collect()}
        assert got["vendors"] == 3 and abs(got["pu_zones"] - 250) <= 250 * profiling.SKETCH_BOUND
        assert abs(got["pickup_times"] - n) <= n * profiling.SKETCH_BOUND and got["payment_types"] == 0
    check(60_000)
    write_raw_months(raw("2024-02", 0, 10), root)
    profiling.update_sketches(spark, root, store, ["2024-02"])
    check(30_000)
