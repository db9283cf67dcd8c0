"""Hand-written raw rows, each with a stated fate (taxi profile)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cordon.config import TAXI
from cordon.operators import causal, panel, quality, segments
from cordon.operators.fact import exclusion_counts
from cordon.plans.warehouse import Warehouse
from cordon.schemas import RAW_TRIPS, ZONE_LOOKUP

T = dt.datetime

# zones: a treated Manhattan zone, a control Manhattan zone, and a zone name
# that exists in two boroughs
ZONES = [
    (161, "Manhattan", "Midtown Center", "Yellow Zone"),
    (236, "Manhattan", "Upper East Side North", "Yellow Zone"),
    (300, "Queens", "Twin Name", "Boro Zone"),
    (301, "Brooklyn", "Twin Name", "Boro Zone"),
]


def trip(tag, pickup, dropoff, pu=161, vendor=1, dist=2.5, rate=1.0, pay=1,
         fare=15.0, tip=3.0, total=None, do=236):
    total = float((fare or 0.0) + (tip or 0.0)) if total is None else total
    return dict(tag=tag, VendorID=vendor, tpep_pickup_datetime=pickup,
                tpep_dropoff_datetime=dropoff, passenger_count=1.0, trip_distance=dist,
                RatecodeID=rate, store_and_fwd_flag="N", PULocationID=pu, DOLocationID=do,
                payment_type=pay, fare_amount=fare, extra=0.0, mta_tax=0.5, tip_amount=tip,
                tolls_amount=0.0, improvement_surcharge=1.0, total_amount=total,
                congestion_surcharge=2.5, airport_fee=0.0)


def rows():
    d = T(2024, 6, 3, 10, 0)
    m = dt.timedelta(minutes=1)
    return [
        trip("E1", d, d + 15 * m),
        trip("E2", d, d + 15 * m),                                    # exact copy
        trip("E3", d, d + 20 * m),                                    # later dropoff
        trip("E4", d + 60 * m, d + 70 * m, dist=0.0),
        trip("E5", d + 61 * m, d + 70 * m, dist=None),
        trip("E6", d + 62 * m, d + 70 * m, dist=None, fare=-1.0),
        trip("E7", d + 63 * m, d + 70 * m, fare=-5.0),
        trip("E8", d + 64 * m, d + 70 * m, fare=0.0, tip=0.0),
        trip("E9", d + 65 * m, d + 65 * m),
        trip("E10", T(2024, 6, 3, 12, 0, 50), T(2024, 6, 3, 12, 1, 10)),
        trip("E11", d + 66 * m, d + 60 * m),
        trip("E12a", T(2023, 12, 31, 23, 59, 59), T(2024, 1, 1, 0, 10)),
        trip("E12b", T(2024, 1, 1, 0, 0, 0), T(2024, 1, 1, 0, 10)),
        trip("E13a", T(2025, 3, 31, 23, 59, 59, 999000), T(2025, 4, 1, 0, 10)),
        trip("E13b", T(2025, 4, 1, 0, 0, 0), T(2025, 4, 1, 0, 10)),
        trip("E14a", T(2025, 1, 4, 23, 59, 59), T(2025, 1, 5, 0, 10)),
        trip("E14b", T(2025, 1, 5, 0, 0, 0), T(2025, 1, 5, 0, 10)),
        trip("E15", d + 67 * m, d + 70 * m, rate=None),
        trip("E16a", d + 68 * m, d + 70 * m, vendor=None),
        trip("E16b", d + 69 * m, d + 75 * m, vendor=None),
        trip("E17", d + 70 * m, d + 75 * m, pu=999),
        trip("E18", d + 71 * m, d + 75 * m, pay=0),
        trip("E19", d + 72 * m, d + 75 * m, fare=10.0, tip=60.0),
        trip("E20", d + 73 * m, d + 75 * m, fare=10.0, tip=0.0, total=-1.0),
        trip("E21a", d + 74 * m, d + 80 * m, pu=300),
        trip("E21b", d + 75 * m, d + 80 * m, pu=301),
        trip("E22", d + 76 * m, d + 76 * m, pu=236),
    ]


@pytest.fixture(scope="module")
def wh(spark):
    data = rows()
    cols = ["tag"] + RAW_TRIPS.fieldNames()
    schema = "tag string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TRIPS)
    raw = spark.createDataFrame([tuple(r[c] for c in cols) for r in data], schema)
    raw = raw.withColumn("trip_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    zones = spark.createDataFrame(ZONES, ZONE_LOOKUP)
    w = Warehouse(spark, TAXI, raw, zones, materialize=False)
    return w


def tags(df):
    return sorted(r.tag for r in df.select("tag").collect())


def test_cleaning_fates(wh, spark):
    kept = tags(wh.cleaned.join(wh.source_raw.select("tag", F.col("tpep_pickup_datetime").alias("pickup_ts"),
                                                     F.col("tpep_dropoff_datetime").alias("dropoff_ts"),
                                                     "VendorID"),
                                ["pickup_ts", "dropoff_ts"], "inner").dropDuplicates(["tag"]))
    for t in ["E4", "E5", "E6", "E7", "E11", "E12a", "E13b"]:
        assert t not in kept
    for t in ["E1", "E8", "E9", "E10", "E12b", "E13a", "E14a", "E14b", "E15", "E17"]:
        assert t in kept


def test_exclusion_accounting(wh):
    ex = exclusion_counts(wh.raw, TAXI).first()
    assert ex.raw_rows == 27
    # counted: E4, E6 (NULL AND FALSE = FALSE), E7, E11, E12a, E13b
    assert ex.excluded_rows == 6
    # E5: NULL rule result - excluded but not counted by NOT(cond)
    assert ex.excluded_null_rows == 1
    fact_rows = wh.fact.count()
    assert ex.kept_rows == fact_rows + 2          # E2 and E3 removed by dedup
    rec = quality.row_reconciliation(wh.raw, wh.fact, TAXI).first()
    assert rec.unexplained_gap == 3 and rec.duplicates_removed == 2


def test_dedup_keeps_earliest_dropoff(wh):
    f = wh.fact.filter((F.col("date_key") == 20240603) & (F.col("time_key") == 10)
                       & (F.col("pu_zone_key") == 161) & (F.col("trip_duration_min") >= 15))
    assert [r.trip_duration_min for r in f.collect()] == [15]


def test_derived_measures(wh):
    f = {(r.date_key, r.time_key, r.trip_duration_min, str(r.tip_pct)): r
         for r in wh.fact.collect()}
    fact = wh.fact
    e8 = fact.filter((F.col("fare_amount") == 0)).first()
    assert e8.tip_pct is None
    e10 = fact.filter(F.col("time_key") == 12).first()
    assert e10.trip_duration_min == 0
    e15 = fact.filter(F.col("ratecode_key") == 99).count()
    assert e15 == 1
    assert f  # non-empty
    e14 = {r.date_key for r in fact.filter(F.col("date_key").isin(20250104, 20250105)).collect()}
    assert e14 == {20250104, 20250105}
    periods = {r.date_key: r.period for r in
               fact.join(wh.dim_date, "date_key").filter(F.col("date_key").isin(20250104, 20250105))
               .select("date_key", "period").collect()}
    assert periods == {20250104: "pre", 20250105: "post"}
    e19 = fact.filter(F.col("tip_amount") == 60).first()
    assert e19.tip_pct == Decimal("6.0000")


def test_null_vendor_keys_and_orphans(wh):
    fact = wh.fact
    assert fact.filter(F.col("trip_key").isNull()).count() == 2
    ri = {r.check_name: r.failures for r in quality.referential_integrity(fact, wh.dims).collect()}
    assert ri["orphan_vendor"] == 2
    assert ri["orphan_pickup_zone"] == 1
    assert ri["orphan_payment"] == 1
    assert ri["orphan_time"] == 0
    anti = {r.check_name: r.failures for r in
            quality.referential_integrity_antijoin(fact, wh.dims).collect()}
    assert all(anti[k] == ri[k] for k in anti)
    assert quality.duplicate_keys(fact).first().failures == 1
    assert quality.range_assertions(fact, TAXI).first().failures == 2   # E19, E20
    e17 = fact.filter(F.col("pu_zone_key") == 999).first()
    assert e17.pu_is_cbd is None


def test_unknown_zone_absent_from_did(wh):
    zc = panel.active_zone_counts(wh.zone_day, wh.dim_zone)
    cells = causal.volume_cells(wh.zone_day, wh.dim_date, zc).collect()
    assert all(r._g in (0, 1) for r in cells)
    total = sum(r.trips for r in cells)
    assert total == wh.fact.filter(F.col("pu_is_cbd").isNotNull()).count()


def test_twin_zone_names_and_zero_minutes(wh):
    top = segments.segment_ranking(wh.fact, wh.dim_zone, wh.dim_time, min_trips=1, top=None)
    twin = top.filter(F.col("zone") == "Twin Name").collect()
    assert len(twin) == 2                              # separate per borough
    conc = segments.segment_stats(wh.fact, wh.dim_zone, wh.dim_time, ("zone", "daypart"))
    assert conc.filter(F.col("zone") == "Twin Name").count() == 1   # merged
    ranked = top.collect()
    nulls = [r for r in ranked if r.revenue_per_min is None]
    assert nulls and all(r.efficiency_rank == ranked[-1].efficiency_rank for r in nulls)


def test_empty_fact_does_not_pass(wh):
    empty = wh.fact.limit(0)
    report = {r.check_name: r.failures for r in
              quality.gate_report(wh.raw, empty, wh.dims, TAXI).collect()}
    assert report["range_assertions"] == 0
    assert report["fact_not_empty"] == 1
    assert report["month_completeness"] == 1
    with pytest.raises(quality.GateFailed):
        quality.enforce(quality.gate_report(wh.raw, empty, wh.dims, TAXI))


def test_schema_drift(wh):
    assert quality.schema_drift(wh.raw).first().failures == 0
    assert quality.schema_drift(wh.raw.drop("tolls_amount")).first().failures == 1


def test_serving_contract_violations(wh):
    from cordon.operators.serving import contract_violations
    v = {r.check_name: r.failures for r in contract_violations(wh.fact).collect()}
    assert v["not_null_trip_key"] == 2          # E16: NULL vendor -> NULL key
    assert v["width_trip_key"] == 0
    assert sum(v.values()) == 2
