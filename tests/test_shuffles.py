"""Shuffles of the warehouse follow the rows; the adapter joins customers to orders."""

import datetime as dt

import pytest

from cordon import shuffles
from cordon.config import TPCH_TRIPS
from cordon.plans import warehouse
from cordon.plans.incremental import MonthlyFact
from cordon.sources import raw as raw_source
from cordon.sources import tpch_raw_trips, tpch_zone_lookup, write_raw_months

from conftest import SF001


def number(spark) -> int:
    return int(spark.conf.get(shuffles.PARTITIONS))


@pytest.fixture()
def asked(monkeypatch):
    """The rows for which shuffles were planned."""
    seen = []
    plain = shuffles.shuffles_for

    def noted(spark, rows):
        seen.append(rows)
        return plain(spark, rows)

    for module in (warehouse, raw_source):
        monkeypatch.setattr(module, "shuffles_for", noted)
    return seen


def test_partitions_follow_rows_and_are_put_back(spark):
    own = number(spark)
    with shuffles.shuffles_for(spark, 100 * shuffles.ROWS_PER_TASK + 1):
        assert number(spark) == 101
        assert spark.range(5).repartitionByRange("id").count() == 5
    with shuffles.shuffles_for(spark, None), shuffles.shuffles_for(spark, 1):
        assert number(spark) == own
    with pytest.raises(ZeroDivisionError), shuffles.shuffles_for(spark, 10**9):
        raise ZeroDivisionError
    assert number(spark) == own


def test_initial_number_of_adaptive_execution_does_not_hold_it_down(spark):
    spark.conf.set(shuffles.INITIAL, "4")
    try:
        with shuffles.shuffles_for(spark, 9 * shuffles.ROWS_PER_TASK):
            assert spark.conf.get(shuffles.INITIAL) == "9"
        assert spark.conf.get(shuffles.INITIAL) == "4"
    finally:
        spark.conf.unset(shuffles.INITIAL)


def test_warehouse_plans_for_its_rows(spark, asked):
    wh = warehouse.tpch_warehouse(spark, SF001 + "/", dedup_method="aggregate")
    n = wh.raw.count()
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert wh.fact.count() > 0
    assert asked == [lines, n]


def test_monthly_fact_plans_for_the_rows_it_rebuilds(spark, asked, tmp_dir):
    raw = tpch_raw_trips(spark, SF001).filter("trip_month in ('1996-01', '1996-02')")
    write_raw_months(raw, f"{tmp_dir}/raw", conform=False)
    wh = warehouse.Warehouse(spark, TPCH_TRIPS, raw, tpch_zone_lookup(spark, SF001))
    fact = MonthlyFact(spark, f"{tmp_dir}/raw", f"{tmp_dir}/fact", wh.dim_zone, TPCH_TRIPS, raw.schema)
    del asked[:]
    fact.update(["1996-01", "1996-02"])
    assert asked == [raw.count()]


def test_customers_join_orders_with_repeated_and_missing_keys(spark, tmp_dir):
    day = dt.datetime(1996, 1, 5)
    tables = {
        "lineitem": ([(1, 1, 1, 1, 3.0, 10.0, 0.0), (2, 1, 1, 1, 3.0, 10.0, 0.0), (3, 1, 9, 1, 3.0, 10.0, 0.0),
                      (None, 1, None, 1, 3.0, 10.0, 0.0)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double"),
        "orders": ([(1, 7, day), (1, 8, day), (2, None, day), (None, 7, day)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "supplier": ([(1, 4), (None, 5)], "s_suppkey long, s_nationkey int"),
        "customer": ([(7, 2), (7, 3), (None, 6)], "c_custkey long, c_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    trips = tpch_raw_trips(spark, tmp_dir)
    got = sorted((tuple(r) for r in trips.select("PULocationID", "DOLocationID", "trip_month").collect()), key=str)
    assert got == sorted([(4, 2, "1996-01"), (4, 3, "1996-01"), (4, None, "1996-01"), (4, None, "1996-01"),
                          (None, None, None), (None, None, None)], key=str)
    plan = trips._jdf.queryExecution().optimizedPlan().toString()
    # the join that takes customers has orders, not line items, on its other side
    at = plan.index("o_custkey", plan.index("Join LeftOuter, (o_custkey"))
    assert "l_orderkey" not in plan[at:]
