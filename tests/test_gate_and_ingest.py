"""Write-audit-publish, the gate, and idempotent batch/streaming ingest."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from cordon.config import TPCH_TRIPS, Bounds
from cordon.operators import quality
from cordon.plans.build import run_build
from cordon.plans.warehouse import Warehouse, read_fact, write_fact
from cordon.schemas import SERVING_DIMS, SERVING_FACT
from cordon.sources import read_raw_trips, tpch_raw_trips, tpch_zone_lookup, write_raw_months
from cordon.sources.ingest import ingest_pending
from cordon.streaming import stream_ingest


# a window of seven months
FEW = TPCH_TRIPS.with_(window_start=dt.date(2001, 1, 1), cutoff=dt.date(2001, 5, 1))


def late(spark):
    return tpch_raw_trips(spark, SF001).filter("tpep_pickup_datetime >= '2000-12-20'")


def test_build_publishes_when_gate_passes(spark, tmp_dir):
    wh = Warehouse(spark, FEW, late(spark), tpch_zone_lookup(spark, SF001))
    res = run_build(wh, tmp_dir, database="cordon_test")
    assert all(f == 0 for _, f in res.report)
    assert {"load_rows", "load_orphan_zones", "load_trips_per_period", "duplicate_trip_keys"} <= {n for n, _ in res.report}
    n = wh.fact.count()
    fact, serving = spark.table("cordon_test.fact_trips"), spark.table("cordon_test.serving_fact_trips")
    assert fact.exceptAll(wh.fact.select(fact.columns)).count() == 0 and fact.count() == serving.count() == n
    assert dict(fact.dtypes) == dict(wh.fact.dtypes) and sum(res.trips_per_period.values()) == n
    assert serving.schema["tip_pct"].dataType.simpleString() == "decimal(6,4)"
    assert [c for c in serving.columns if c != "year_month"] == [c for c, _, _ in SERVING_FACT]
    for name in wh.dims:
        typed = spark.table(f"cordon_test.serving_dim_{name}")
        assert typed.dtypes == [(c, t) for c, t, _ in SERVING_DIMS[name].columns]
        assert typed.count() == spark.table(f"cordon_test.dim_{name}").count() == wh.dims[name].count()
    stats = spark.sql(f"DESCRIBE EXTENDED cordon_test.dim_zone_runs PARTITION (run_id='{res.run}')").collect()
    assert any(r.col_name == "Partition Statistics" and "rows" in r.data_type for r in stats)
    only = spark.sql("SELECT count(*) FROM cordon_test.fact_trips WHERE year_month = '2001-03'")
    assert only.first()[0] == wh.fact.filter("year_month = '2001-03'").count()


def test_build_reports_every_failure(spark, tmp_dir):
    """Gate, contract, dimension and load checks in one exception."""
    cfg = FEW.with_(payment_codes=(*TPCH_TRIPS.payment_codes[:2], (1, "again")))   # codes 3-6 orphaned, 1 twice
    raw = late(spark).withColumn("DOLocationID", F.when(F.col("passenger_count") > 4, F.col("DOLocationID")))
    wh = Warehouse(spark, cfg, raw, tpch_zone_lookup(spark, SF001))
    with pytest.raises(quality.GateFailed) as e:
        run_build(wh, tmp_dir, database="cordon_never")
    failed = {n for n, _ in e.value.failures}
    assert {"orphan_payment", "orphan_dropoff_zone", "not_null_do_zone_key", "dim_payment_unique_payment_key"} <= failed
    assert not spark.catalog.databaseExists("cordon_never")


class Broken(Exception):
    pass


def test_readers_see_one_whole_run_wherever_publishing_breaks(spark, tmp_dir):
    """Two tables, one by month; a failure after every step of the second and
    third run.  The third keeps a month of the second."""
    from cordon.plans.publish import Part, Publication

    def part(run, months):
        rows = [(run, m) for m in months]
        spark.createDataFrame(rows, "v int, year_month string").write.partitionBy("year_month").parquet(f"{tmp_dir}/{run}/m")
        spark.createDataFrame([(run,)], "v int").write.parquet(f"{tmp_dir}/{run}/d")
        own = spark.createDataFrame([], "v int, year_month string").schema
        return {"monthly": Part(own, months={m: f"{tmp_dir}/{run}/m/year_month={m}" for m in months}),
                "small": Part(spark.createDataFrame([], "v int").schema, f"{tmp_dir}/{run}/d")}

    def seen():
        return (sorted(map(tuple, spark.table("cordon_steps.monthly").collect())),
                [r.v for r in spark.table("cordon_steps.small").collect()])

    steps: list[str] = []
    one = part(1, ["2024-01", "2024-02"])
    Publication(spark, "cordon_steps", steps.append).publish("one", one, tmp_dir)
    assert steps[0] == "database" and steps[-1] == "switch" and len(steps) == 8
    states = [seen()]
    assert states[0] == ([(1, "2024-01"), (1, "2024-02")], [1])
    two = part(2, ["2024-02", "2024-03"])
    three = part(3, ["2024-01"])
    kept = {"2024-02": two["monthly"].months["2024-02"]} | three["monthly"].months
    three["monthly"] = Part(two["monthly"].schema, months=kept)
    for n, (run, tables) in enumerate((("two", two), ("three", three))):
        for step in steps:
            def after(done, step=step):
                if done == step:
                    raise Broken(step)
            with pytest.raises(Broken):
                Publication(spark, "cordon_steps", after).publish(run, tables, tmp_dir)
            if step == "switch":
                states.append(seen())
            else:
                assert seen() == states[n], (run, step)
    assert states[1] == ([(2, "2024-02"), (2, "2024-03")], [2])
    assert states[2] == ([(2, "2024-02"), (3, "2024-01")], [3])
    p = Publication(spark, "cordon_steps")
    assert p.published_run() == "three" and p.months("monthly", "two") == ["2024-02", "2024-03"]
    assert p.month_paths("monthly", "three")["2024-02"].endswith("/2/m/year_month=2024-02")


def test_failed_build_leaves_the_published_tables(spark, tmp_dir):
    cfg = TPCH_TRIPS.with_(window_start=dt.date(2001, 6, 1), cutoff=dt.date(2001, 7, 1))
    raw = tpch_raw_trips(spark, SF001).filter("tpep_pickup_datetime >= '2001-06-01'")
    zones = tpch_zone_lookup(spark, SF001)
    good = run_build(Warehouse(spark, cfg, raw, zones), tmp_dir, database="cordon_safe")
    n = spark.table("cordon_safe.fact_trips").count()
    wrong = raw.withColumn("payment_type", F.lit(77).cast("bigint"))
    with pytest.raises(quality.GateFailed):
        run_build(Warehouse(spark, cfg, wrong, zones), tmp_dir, database="cordon_safe")
    after = spark.table("cordon_safe.fact_trips")
    assert after.count() == n > 0 and after.filter("payment_key = 77").count() == 0
    again = run_build(Warehouse(spark, cfg, raw, zones), tmp_dir, database="cordon_safe")
    assert again.fact_path != good.fact_path and spark.table("cordon_safe.fact_trips").count() == n
    assert spark.read.parquet(good.serving_path).count() == n  # the earlier run's files stay as they were


def test_observed_gate_equals_the_scan(spark, tmp_dir):
    """Every figure, on data that fail several checks, and when files and
    figures come from different attempts."""
    cfg = FEW.with_(payment_codes=TPCH_TRIPS.payment_codes[:3], bounds=Bounds(fare_max=30000.0, minutes_max=20))
    raw = late(spark).filter("trip_month <> '2001-02'")
    wh = Warehouse(spark, cfg, raw, tpch_zone_lookup(spark, SF001))
    observer = quality.FactObserver(wh.dims, cfg)
    write_fact(wh.fact_plan, f"{tmp_dir}/fact", observer.mark)
    fact = read_fact(spark, f"{tmp_dir}/fact", wh.fact_plan.schema)
    want = {tuple(r) for r in quality.gate_report(wh.raw, fact, wh.dims, cfg).collect()}
    assert {tuple(r) for r in observer.report(wh.raw, fact).collect()} == want
    assert {n for n, v, _ in want if v} >= {"orphan_payment", "range_assertions", "month_completeness"}
    less = fact.filter("time_key < 12")
    assert {tuple(r) for r in observer.report(wh.raw, less).collect()} == {
        tuple(r) for r in quality.gate_report(wh.raw, less, wh.dims, cfg).collect()}


def test_gate_failure_carries_its_figures(spark):
    wh = Warehouse(spark, TPCH_TRIPS, tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001))
    few = wh.fact.filter("time_key < 12")
    with pytest.raises(quality.GateFailed) as e:
        quality.enforce(quality.gate_report(wh.raw, few, wh.dims, TPCH_TRIPS))
    assert "fact_rows=" in e.value.details["row_reconciliation"] and "raw_rows=" in str(e.value)


@pytest.mark.parametrize("name", ["zone", "date", "time", "payment", "ratecode", "vendor"])
def test_serving_dimensions(spark, tmp_dir, name):
    from cordon.operators import serving
    from cordon.plans.build import publish_serving_dim
    from cordon.schemas import SERVING_DIMS
    wh = Warehouse(spark, TPCH_TRIPS, tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001))
    dim = wh.dims[name]
    assert {r.failures for r in serving.dim_violations(dim, name).collect()} == {0}
    twice = {r.check_name: r.failures for r in serving.dim_violations(dim.unionByName(dim), name).collect()}
    key = SERVING_DIMS[name].key
    assert twice[f"dim_{name}_unique_{key}"] == dim.count()
    got = publish_serving_dim(dim, name, f"{tmp_dir}/{name}")
    assert got.dtypes == [(c, t) for c, t, _ in SERVING_DIMS[name].columns] and got.count() == dim.count()


def test_serving_fact_is_laid_out_by_month(spark, tmp_dir):
    from cordon.plans.build import publish_serving
    wh = Warehouse(spark, TPCH_TRIPS, tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001))
    got = publish_serving(wh.fact, f"{tmp_dir}/s")
    assert glob.glob(f"{tmp_dir}/s/year_month=1998-03") and "year_month" not in got.columns
    assert got.count() == wh.fact.count()


def test_half_written_month_is_completed(spark, tmp_dir):
    """A run that broke after some rows of a month: the next run replaces the
    month whole, and takes it only once."""
    raw = tpch_raw_trips(spark, SF001).filter("trip_month in ('1999-01', '1999-02')")
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    write_raw_months(raw, landing)
    half = read_raw_trips(spark, landing, uniform=True).filter("trip_month = '1999-01'").limit(11)
    write_raw_months(half, store)
    assert ingest_pending(spark, landing, store).count() == 2
    got = read_raw_trips(spark, store, uniform=True)
    assert got.exceptAll(read_raw_trips(spark, landing, uniform=True)).count() == 0 and got.count() == raw.count()
    assert ingest_pending(spark, landing, store).count() == 0


def test_batch_ingest_is_idempotent(spark, tmp_dir):
    raw = tpch_raw_trips(spark, SF001)
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    early = raw.filter(F.col("trip_month") < "1998-01")
    write_raw_months(early, landing)
    ingest_pending(spark, landing, store)
    write_raw_months(raw, landing)
    copied = {r.trip_month for r in ingest_pending(spark, landing, store).collect()}
    assert copied and min(copied) >= "1998-01"
    assert ingest_pending(spark, landing, store).count() == 0
    assert read_raw_trips(spark, store).count() == raw.count()


def test_stream_ingest_is_idempotent(spark, tmp_dir):
    raw = tpch_raw_trips(spark, SF001)
    landing = f"{tmp_dir}/landing"
    write_raw_months(raw, landing)
    store, ckpt = f"{tmp_dir}/s_store", f"{tmp_dir}/ckpt"
    stream_ingest(spark, landing, store, ckpt)
    assert stream_ingest(spark, landing, store, ckpt).count() == raw.count()


def test_export_csv(spark, tmp_dir):
    from cordon.operators import causal, panel
    from cordon.plans.build import export_csv
    wh = Warehouse(spark, TPCH_TRIPS, tpch_raw_trips(spark, SF001), tpch_zone_lookup(spark, SF001))
    zc = panel.active_zone_counts(wh.zone_day, wh.dim_zone)
    res = {"did_volume": causal.did_volume(wh.zone_day, wh.dim_date, zc)}
    paths = export_csv(res, tmp_dir)
    back = spark.read.option("header", True).option("inferSchema", True).csv(paths["did_volume"])
    assert back.count() == 1 and "did_estimate" in back.columns


def test_taxi_warehouse_reads_files(spark, tmp_dir):
    """The file-based entry point: monthly Parquet + zone CSV, taxi-style
    declared types (money as DOUBLE)."""
    from cordon.plans.warehouse import taxi_warehouse
    from cordon.sources import write_zone_lookup_csv
    raw = tpch_raw_trips(spark, SF001)
    write_raw_months(raw, f"{tmp_dir}/raw")
    write_zone_lookup_csv(tpch_zone_lookup(spark, SF001), f"{tmp_dir}/zones")
    wh = taxi_warehouse(spark, f"{tmp_dir}/raw", f"{tmp_dir}/zones", TPCH_TRIPS)
    assert wh.raw.schema["fare_amount"].dataType.simpleString() == "double"
    ref = Warehouse(spark, TPCH_TRIPS, raw, tpch_zone_lookup(spark, SF001))
    assert wh.fact.count() == ref.fact.count()
    assert {r.check_name: r.failures for r in
            quality.gate_report(wh.raw, wh.fact, wh.dims, TPCH_TRIPS).collect()}["orphan_date"] == 0


def test_catalog_drift_and_partitions(spark, tmp_dir):
    from cordon.plans.build import add_partition, register_table
    root = f"{tmp_dir}/raw"
    write_raw_months(tpch_raw_trips(spark, SF001), root)
    register_table(spark, "cordon_test.raw_trips", root, analyze=False)
    assert quality.schema_drift_table(spark, "cordon_test.raw_trips").first().failures == 0
    add_partition(spark, "cordon_test.raw_trips", "trip_month", "1995-01", f"{root}/trip_month=1995-01")


def test_rows_filed_under_another_month_are_kept(spark):
    from cordon.operators.fact import clean
    raw = tpch_raw_trips(spark, SF001)
    moved = raw.withColumn("trip_month", F.lit("2010-01"))
    assert clean(moved, TPCH_TRIPS).count() == clean(raw, TPCH_TRIPS).count()


def test_iterate_result(spark):
    from cordon.plans.build import iterate_result
    assert list(iterate_result(spark.range(3))) == [{"id": 0}, {"id": 1}, {"id": 2}]


def test_raw_read_survives_type_drift(spark, tmp_dir):
    """Months storing a column as INT in one month and DOUBLE in another, and
    a month lacking a column, read into the declared schema."""
    a = spark.sql("SELECT 1L AS VendorID, timestamp_ntz'2024-01-02 10:00:00' AS tpep_pickup_datetime, "
                  "2 AS passenger_count, 3 AS trip_distance, 4.5D AS fare_amount")
    b = spark.sql("SELECT 2 AS vendorid, timestamp_ntz'2024-02-02 10:00:00' AS tpep_pickup_datetime, "
                  "2.0D AS passenger_count, 3.5D AS trip_distance, 5L AS fare_amount, 1.0D AS tolls_amount")
    a.write.parquet(f"{tmp_dir}/trip_month=2024-01")
    b.write.parquet(f"{tmp_dir}/trip_month=2024-02")
    rows = sorted(read_raw_trips(spark, tmp_dir).select(
        "VendorID", "passenger_count", "trip_distance", "fare_amount", "tolls_amount",
        "trip_month").collect())
    assert [tuple(r) for r in rows] == [(1, 2.0, 3.0, 4.5, None, "2024-01"),
                                        (2, 2.0, 3.5, 5.0, 1.0, "2024-02")]


def test_stream_survives_type_drift(spark, tmp_dir):
    spark.sql("SELECT 1L AS VendorID, 2 AS passenger_count, 4.5D AS fare_amount").write.parquet(
        f"{tmp_dir}/l/trip_month=2024-01")
    spark.sql("SELECT 2L AS VendorID, 3.0D AS passenger_count, 5L AS fare_amount").write.parquet(
        f"{tmp_dir}/l/trip_month=2024-02")
    got = stream_ingest(spark, f"{tmp_dir}/l", f"{tmp_dir}/s", f"{tmp_dir}/c")
    assert sorted((r.VendorID, r.passenger_count, r.fare_amount, r.trip_month) for r in got.collect()) == [
        (1, 2.0, 4.5, "2024-01"), (2, 3.0, 5.0, "2024-02")]
