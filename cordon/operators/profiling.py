"""Raw-data profiling (D1-D4): one aggregation each, no shuffle of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.schemas import RAW_PARTITION
from cordon.sources.raw import read_raw_trips


def rows_by_month(raw: DataFrame, month_col: str = "trip_month") -> DataFrame:
    return (raw.groupBy(month_col).agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(month_col))


def invalid_rates(raw: DataFrame) -> DataFrame:
    def n(c):
        return F.count(F.when(c, 1))
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        n(F.col("tpep_pickup_datetime").isNull()).alias("null_pickup_ts"),
        n(F.col("PULocationID").isNull()).alias("null_pu_zone"),
        n(F.col("trip_distance") <= 0).alias("nonpos_distance"),
        n(F.col("fare_amount") < 0).alias("negative_fare"),
        n(F.col("tpep_dropoff_datetime") < F.col("tpep_pickup_datetime")).alias("dropoff_before_pickup"),
    )


def value_ranges(raw: DataFrame) -> DataFrame:
    d = {"trip_distance": "dist", "fare_amount": "fare", "total_amount": "total"}
    aggs = []
    for c, short in d.items():
        aggs += [F.min(c).cast("double").alias(f"min_{short}"),
                 F.max(c).cast("double").alias(f"max_{short}")]
    return raw.agg(*aggs)


def key_cardinality(raw: DataFrame) -> DataFrame:
    """Exact distinct counts of the would-be dimension keys.  Rows are grouped
    by the four keys first (one partial row per combination and task); the
    distinct counts then see only those few combinations."""
    keys = {"PULocationID": "distinct_pu_zones", "payment_type": "distinct_payment_types",
            "VendorID": "distinct_vendors", "RatecodeID": "distinct_ratecodes"}
    combos = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return combos.agg(*[F.countDistinct(c).alias(n) for c, n in keys.items()])


#: Keys whose distinct values the monthly sketches estimate: (name, raw column).
SKETCHED = (("pu_zones", "PULocationID"), ("payment_types", "payment_type"), ("vendors", "VendorID"),
            ("ratecodes", "RatecodeID"), ("pickup_times", "tpep_pickup_datetime"))
LG_K = 12
#: Three standard errors of a sketch of 2^LG_K registers.
SKETCH_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)


def month_sketches(raw: DataFrame) -> DataFrame:
    """One HyperLogLog sketch per month and key: (trip_month, rows, sk_<name>...).
    Sketches of some KB are what is shuffled, after a map-side merge."""
    return raw.groupBy(RAW_PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"sk_{n}") for n, c in SKETCHED])


def update_sketches(spark: SparkSession, raw_root: str, store: str, months: list[str]) -> None:
    """Read these file months alone and replace their sketches in ``store``."""
    raw = read_raw_trips(spark, raw_root, uniform=True, months=[f"{raw_root}/{RAW_PARTITION}={m}" for m in months])
    (month_sketches(raw).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RAW_PARTITION).parquet(store))


def sketched_cardinality(sketches: DataFrame) -> DataFrame:
    """(key, estimate) of all months together, from the stored sketches alone."""
    merged = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"sk_{n}")).alias(n) for n, _ in SKETCHED])
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in SKETCHED)
    return merged.selectExpr(f"stack({len(SKETCHED)}, {pairs}) AS (key, estimate)")


def sketch_accuracy(sketches: DataFrame, raw: DataFrame) -> DataFrame:
    """(key, distinct_values, within_bound): exact counts, and whether the
    merged sketches' estimate is within SKETCH_BOUND of them."""
    exact = raw.agg(*[F.count_distinct(c).alias(n) for n, c in SKETCHED])
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in SKETCHED)
    exact = exact.selectExpr(f"stack({len(SKETCHED)}, {pairs}) AS (key, distinct_values)")
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    return exact.join(sketched_cardinality(sketches), "key").select(
        "key", "distinct_values", (off <= F.lit(SKETCH_BOUND) * F.col("distinct_values")).alias("within_bound"))
