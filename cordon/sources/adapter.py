"""Trips adapter over the TPC-H style test tables.

The test tables hold orders and line items, not taxi trips; this module
derives a deterministic raw trip table with the taxi column names from them,
so every operator can be run (and checked against an SQL oracle) on data whose
volume grows with the tables.  All rows of ``lineitem`` are used.

Derivation (one raw trip per line item):

* vendor from the line number (0 -> 1, 1 -> 2, 2 -> 6, else 7, by ``% 4``);
* pickup = order date + ``(orderkey*37 + linenumber*211 + partkey*13) % 1440``
  minutes; dropoff = pickup + quantity minutes, or 5 minutes *before* pickup
  for every 89th order (invalid rows the cleaning must exclude);
* distance = quantity - 1 (0 for quantity 1: excluded);
* rate code NULL for every 50th part, else ``partkey % 6 + 1``;
* pickup / dropoff zone = supplier / customer nation;
* payment = ``suppkey % 6 + 1``;
* fare = extended price as DECIMAL(12,2), negated for every 97th order;
  tip = fare * discount; total = fare + tip (exact decimals);
* every line of every 101st order appears twice, the copy 5 minutes later at
  dropoff (duplicates the de-duplication must remove).

Money stays in exact decimals so that sums are identical in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.functions import add_minutes, month_label


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tpch_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with the declared raw column names plus ``trip_month``, one
    or two per line item: a line item without an order, supplier or customer
    stays, with NULLs that the cleaning and the orphan checks then find."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supp = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    # Orders grows with line items (a quarter of their count), so that join is
    # always a sort-merge join on the order key - never a broadcast of a side
    # that grows with the data.  Supplier and customer are left to the
    # planner: broadcast only while their measured size is under the
    # broadcast threshold, otherwise shuffle joins.  The customer joins the
    # order, so a shuffle for it moves orders and not line items.
    placed = orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        "o_orderkey", "o_orderdate", "c_nationkey")
    j = (li.join(placed.hint("merge"), li.l_orderkey == placed.o_orderkey, "left")
           .join(supp, li.l_suppkey == supp.s_suppkey, "left"))

    ln4 = F.col("l_linenumber") % 4
    vendor = (F.when(ln4 == 0, 1).when(ln4 == 1, 2).when(ln4 == 2, 6).otherwise(7)).cast("bigint")
    offset = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211 + F.col("l_partkey") * 13) % 1440
    pickup = add_minutes(F.col("o_orderdate"), offset)
    dur = F.when(F.col("l_orderkey") % 89 == 0, F.lit(-5)).otherwise(F.col("l_quantity").cast("int"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    fare = F.when(F.col("l_orderkey") % 97 == 0, -price).otherwise(price)
    tip = price * F.col("l_discount").cast("decimal(4,2)")
    # injected copies: lines of every 101st order come twice, the second
    # 5 minutes later at dropoff (one pass, no second scan of the join)
    copy_shift = F.explode(
        F.when(F.col("l_orderkey") % 101 == 0, F.array(F.lit(0), F.lit(5)))
         .otherwise(F.array(F.lit(0))))

    base = j.select(
        vendor.alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dur.alias("_dur"),
        (F.col("l_linenumber") % 5 + 1).cast("double").alias("passenger_count"),
        (F.col("l_quantity") - 1).cast("decimal(10,2)").alias("trip_distance"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None))
         .otherwise(F.col("l_partkey") % 6 + 1).cast("double").alias("RatecodeID"),
        F.col("s_nationkey").cast("bigint").alias("PULocationID"),
        F.col("c_nationkey").cast("bigint").alias("DOLocationID"),
        (F.col("l_suppkey") % 6 + 1).cast("bigint").alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        copy_shift.alias("_shift"),
    )
    raw = base.select(
        "VendorID",
        "tpep_pickup_datetime",
        add_minutes(add_minutes(F.col("tpep_pickup_datetime"), F.col("_dur")), F.col("_shift"))
            .alias("tpep_dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "RatecodeID",
        F.lit("N").alias("store_and_fwd_flag"),
        "PULocationID",
        "DOLocationID",
        "payment_type",
        "fare_amount",
        F.lit(0).cast("decimal(12,2)").alias("extra"),
        F.lit(0).cast("decimal(12,2)").alias("mta_tax"),
        "tip_amount",
        F.lit(0).cast("decimal(12,2)").alias("tolls_amount"),
        F.lit(0).cast("decimal(12,2)").alias("improvement_surcharge"),
        (F.col("fare_amount") + F.col("tip_amount")).alias("total_amount"),
        F.lit(0).cast("decimal(12,2)").alias("congestion_surcharge"),
        F.lit(0).cast("decimal(12,2)").alias("airport_fee"),
        month_label("tpep_pickup_datetime").alias("trip_month"),
    )
    return raw


def tpch_trip_count(spark: SparkSession, sf_dir: str) -> int:
    """About the rows of ``tpch_raw_trips``: the line items, from the footers."""
    return _t(spark, sf_dir, "lineitem").count()


def tpch_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: one zone per nation, borough = region name."""
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                     F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"),
                     F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"))
                      .alias("service_zone")))
