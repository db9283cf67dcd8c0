"""De-duplication forms agree; the fact is invariant to input duplication,
row order and partitioning (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from cordon.config import TPCH_TRIPS
from cordon.operators import fact as FT
from cordon.plans.warehouse import Warehouse
from cordon.sources import tpch_raw_trips, tpch_zone_lookup


def _fact_rows(wh):
    return sorted(tuple(r) for r in wh.fact.drop("tip_pct").collect())


@pytest.fixture(scope="module")
def base(spark):
    raw = tpch_raw_trips(spark, SF001)
    zones = tpch_zone_lookup(spark, SF001)
    return raw, zones


def test_dedup_forms_agree(spark, base):
    raw, zones = base
    cl = FT.clean(raw, TPCH_TRIPS)
    a = FT.dedup(cl, method="aggregate")
    w = FT.dedup(cl, method="window")
    assert a.count() == w.count()
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_duplicated_input_same_fact(spark, base):
    raw, zones = base
    one = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    two = Warehouse(spark, TPCH_TRIPS, raw.unionByName(raw), zones, materialize=False)
    assert _fact_rows(one) == _fact_rows(two)


def test_order_and_partitioning_invariance(spark, base):
    raw, zones = base
    one = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    shuffled = raw.repartition(13).orderBy(F.rand(3))
    two = Warehouse(spark, TPCH_TRIPS, shuffled, zones, materialize=False, dedup_method="window")
    assert _fact_rows(one) == _fact_rows(two)


def test_duplicate_keys_in_one_scan_and_shuffle(spark, base):
    from cordon.operators import quality
    raw, zones = base
    wh = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    doubled = wh.fact.unionByName(wh.fact.limit(37))
    assert quality.duplicate_keys(wh.fact).first().failures == 0
    assert quality.duplicate_keys(doubled).first().failures == 37
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quality.duplicate_keys(spark.range(9).select(F.md5(F.col("id").cast("string")).alias("trip_key")))
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and text.count("Range (") == 1 and "Join" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_boundary_baseline_equals_did_volume(spark, base):
    from cordon.operators import causal, panel
    raw, zones = base
    wh = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    zd = wh.zone_day
    vol = causal.did_volume(zd, wh.dim_date, panel.active_zone_counts(zd, wh.dim_zone)).first()
    sens = {r.scenario: r for r in
            causal.boundary_sensitivity(zd, wh.dim_date, wh.zone_ref, TPCH_TRIPS).collect()}
    base_row = sens["baseline"]
    assert (base_row.treated_pre, base_row.control_pre, base_row.did_estimate) == (
        vol.treated_pre, vol.control_pre, vol.did_estimate)
    assert set(sens) == {"baseline", "move NATION_21"}
    # moving a control zone into the treated set changes the control rate
    assert sens["move NATION_21"].control_pre != base_row.control_pre


def test_trend_measures_and_means_variants(spark, base):
    from cordon.operators import causal, panel
    raw, zones = base
    wh = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    zd = wh.zone_day
    zc = panel.active_zone_counts(zd, wh.dim_zone)
    fact = wh.fact
    for measure in ("trip_distance", "tip_pct"):
        got = {(r.year_month, r.grp): r[f"avg_{measure}"] for r in
               causal.parallel_trends(zd, wh.dim_date, zc, measure=measure).collect()}
        grp = F.when(F.col("pu_is_cbd") == 1, "treated_CBD").otherwise("control_nonCBD")
        want = {(r.year_month, r.g): r.m for r in
                fact.filter(F.col("pu_is_cbd").isNotNull())
                .groupBy("year_month", grp.alias("g"))
                .agg((F.sum(measure).cast("double") / F.count(measure)).alias("m")).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 for k in got if want[k] is not None)
    all_trips = {r.outcome: r.did_estimate for r in
                 causal.did_means(zd, wh.dim_date, card_only=False).collect()}
    card = {r.outcome: r.did_estimate for r in causal.did_means(zd, wh.dim_date).collect()}
    assert set(all_trips) == set(card) == {"avg_trip_distance", "avg_tip_pct"}
    rounded = causal.did_volume(zd, wh.dim_date, zc, digits=2).first()
    exact = causal.did_volume(zd, wh.dim_date, zc).first()
    assert rounded.control_pre == round(exact.control_pre, 2)


@pytest.mark.parametrize("share,bits", [(0, 1 << 24), (1, 1 << 24), (50, 1 << 24), (50, 1 << 7)])
def test_candidate_dedup_equals_the_exact_form(spark, base, share, bits):
    """Few and many copies, nulls in every key column, a filter that is full."""
    raw, _ = base
    cl = FT.clean(raw, TPCH_TRIPS)
    key = F.pmod(F.xxhash64("pickup_ts", "total_amount"), F.lit(100))
    cl = cl.withColumn("VendorID", F.when(key != 7, F.col("VendorID"))).withColumn(
        "total_amount", F.when(key != 8, F.col("total_amount")))
    copies = cl.filter(key < share).withColumn("dropoff_ts", F.col("dropoff_ts") + F.expr("INTERVAL 3 MINUTES"))
    rel = cl.unionByName(copies)
    a, b = FT.dedup(rel, method="aggregate"), FT.dedup_candidates(rel, bits=bits)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_shuffles_whole_rows_once(spark, base):
    """Rows that are alone with their key reach the write without a shuffle:
    whole rows are exchanged by the write's range partitioning and, among the
    candidates only, by the exact path."""
    raw, zones = base
    wh = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    plan = FT.dedup(wh.cleaned)._jdf.queryExecution().executedPlan().toString()
    whole = [line for line in plan.splitlines() if "Exchange hashpartitioning(VendorID" in line]
    assert len(whole) == 1 and "Union" in plan
    alone = plan[plan.index("Union"):plan.index("SortAggregate")]
    assert "BroadcastHashJoin" in alone and "NOT coalesce" in alone


def test_incremental_fact_follows_its_files(spark, tmp_dir):
    """Rows filed under another month, months that arrive late, one delivered
    again with other rows, one taken back; other months' files stay untouched."""
    import glob
    import os
    import shutil

    from cordon.config import TPCH_TRIPS as C
    from cordon.plans.incremental import MonthlyFact
    from cordon.sources import write_raw_months
    raw, zones = tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001)
    raw = raw.filter("tpep_pickup_datetime >= '2001-03-01'")
    stray = F.pmod(F.xxhash64("total_amount"), F.lit(9)) == 0
    raw = raw.withColumn("trip_month", F.when(stray, "2001-04").otherwise(F.col("trip_month")))
    store, root = f"{tmp_dir}/raw", f"{tmp_dir}/inc"
    write_raw_months(raw, store)
    wh = Warehouse(spark, C, raw, zones, materialize=False)
    fact = MonthlyFact(spark, store, root, wh.dim_zone, C)

    def check():
        want = Warehouse(spark, C, spark.read.parquet(store), zones, materialize=False)
        a, b = fact.fact(), want.fact
        b = b.select(a.columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
        z = fact.zone_day().drop("year_month")
        assert z.exceptAll(want.zone_day.select(z.columns)).count() == 0 and z.count() == want.zone_day.count()

    months = sorted({r[0] for r in raw.select("trip_month").distinct().collect()})
    assert fact.fact().count() == 0 and fact.update([]) == []
    assert set(fact.update([m for m in months if m not in ("2001-05", "2001-06")])) >= {"2001-03", "2001-04", "2001-05"}
    before = fact.state().months
    assert fact.update(["2001-05", "2001-06"]) == ["2001-05", "2001-06"]
    check()
    after = fact.state().months
    assert {m for m in before if after[m] != before[m]} == {"2001-05", "2001-06"}
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/runs/**/*.parquet", recursive=True)}
    again = raw.filter("trip_month = '2001-05' and VendorID <> 2").unionByName(raw.filter("trip_month = '2001-05' and VendorID = 1"))
    write_raw_months(again, store)
    assert fact.update(["2001-05"]) == ["2001-05"]
    check()
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    shutil.rmtree(f"{store}/trip_month=2001-04")  # taken back: the trips of other months filed there go as well
    assert set(fact.update(["2001-04"])) >= {"2001-03", "2001-04", "2001-05"}
    check()


def test_post_period_prunes_the_fact(spark, base):
    """Month folders before the cutoff are not read."""
    from cordon.operators import serving
    wh = Warehouse(spark, TPCH_TRIPS, *base)
    df = serving.post_period_trips(wh.fact, wh.dim_date)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(year_month" in plan
    df.collect()
    read = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves()
    scans = [read.apply(i) for i in range(read.size())]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in text and scans
    got = {r.year_month: r.trips for r in df.groupBy("year_month").agg(F.sum("trips").alias("trips")).collect()}
    want = {r.year_month: r.n for r in wh.fact.filter(F.col("date_key") >= 20001005).filter("pu_is_cbd is not null or true")
            .groupBy("year_month").agg(F.count("*").alias("n")).collect()}
    assert got == want and min(got) == "2000-10"


def test_streamed_fact_equals_the_batch_result(spark, tmp_dir):
    """Late and repeated files over several batches and a restart; a batch that
    fails its gate changes nothing and is taken once it is in order."""
    from cordon.operators import quality
    from cordon.plans.incremental import MonthlyFact
    from cordon.streaming.fact import stream_fact
    raw, zones = tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001)
    raw = raw.filter("tpep_pickup_datetime >= '2001-05-01'").cache()
    wh = Warehouse(spark, TPCH_TRIPS, raw, zones, materialize=False)
    landing, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    fact = MonthlyFact(spark, f"{tmp_dir}/store", f"{tmp_dir}/inc", wh.dim_zone, TPCH_TRIPS, raw.schema)

    def land(rows):
        rows.coalesce(1).write.mode("append").partitionBy("trip_month").parquet(landing)

    def check(seen):
        want = Warehouse(spark, TPCH_TRIPS, seen, zones, materialize=False).fact
        got = fact.fact().select(want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0

    land(raw.filter("trip_month = '2001-07'"))
    assert [r.late_rows for r in stream_fact(spark, landing, fact, wh.dims, ckpt).collect()] == [0]
    check(raw.filter("trip_month = '2001-07'"))
    # a late month, and copies of trips of the first batch with an earlier dropoff
    earlier = raw.filter("trip_month = '2001-07' and VendorID = 1").withColumn(
        "tpep_dropoff_datetime", F.col("tpep_pickup_datetime"))
    land(raw.filter("trip_month = '2001-05'"))
    land(earlier)
    got = stream_fact(spark, landing, fact, wh.dims, ckpt, max_files_per_trigger=1).orderBy("batch").collect()
    assert len(got) == 3 and sum(r.late_rows for r in got) == raw.filter("trip_month = '2001-05'").count()
    seen = raw.filter("trip_month <> '2001-06'").unionByName(earlier)
    check(seen)
    # a batch with a payment code that no dimension has
    land(raw.filter("trip_month = '2001-06'"))
    few = dict(wh.dims, payment=wh.dims["payment"].filter("payment_key > 1"))
    with pytest.raises(Exception, match="orphan_payment"):
        stream_fact(spark, landing, fact, few, ckpt)
    check(seen)
    stream_fact(spark, landing, fact, wh.dims, ckpt)
    check(seen.unionByName(raw.filter("trip_month = '2001-06'")))
    assert quality.duplicate_keys(fact.fact()).first().failures == 0
    assert stream_fact(spark, landing, fact, wh.dims, ckpt).count() == 4
