"""Fact build (D12-D16): clean -> de-duplicate -> key and derive -> denormalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cordon.config import PipelineConfig
from cordon.functions import date_key, month_label, ntz, trip_key, whole_minutes
from cordon.operators.broadcast import bounded

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# natural key of a trip and the deterministic order that picks the kept row
# (earliest dropoff first, then every remaining column, NULLs last)
NATURAL_KEY = ("VendorID", "pickup_ts", "PULocationID", "total_amount")
KEEP_ORDER = ("dropoff_ts", "trip_distance", "DOLocationID", "payment_type",
              "fare_amount", "tip_amount", "ratecode_id", "passenger_count",
              "tolls_amount")


def grain_rules(cfg: PipelineConfig) -> list[Column]:
    """The documented grain rules, one column per rule."""
    return [
        F.col("trip_distance") > 0,
        F.col("fare_amount") >= 0,
        F.col(DROPOFF) >= F.col(PICKUP),
        F.col(PICKUP) >= ntz(cfg.window_start),
        F.col(PICKUP) < ntz(cfg.window_end),
    ]


def grain_condition(cfg: PipelineConfig) -> Column:
    cond = None
    for r in grain_rules(cfg):
        cond = r if cond is None else (cond & r)
    return cond


def clean(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Rows meeting every grain rule (a NULL rule result drops the row);
    NULL rate code becomes the unknown code."""
    return raw.filter(grain_condition(cfg)).select(
        "VendorID",
        F.col(PICKUP).alias("pickup_ts"),
        F.col(DROPOFF).alias("dropoff_ts"),
        "passenger_count",
        "trip_distance",
        F.coalesce(F.col("RatecodeID"), F.lit(cfg.unknown_ratecode).cast("double")).alias("ratecode_id"),
        "PULocationID",
        "DOLocationID",
        "payment_type",
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        "total_amount",
    )


def exclusion_counts(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One pass over raw: how many rows each grain rule rejects.

    ``excluded_rows`` counts rows where NOT(all rules) is TRUE - the audit
    definition; rows where the conjunction is NULL are rejected by the
    cleaning too, but only counted in ``excluded_null_rows`` (trap T5)."""
    cond = grain_condition(cfg)
    d, f, o, lo, hi = grain_rules(cfg)

    def n(c: Column) -> Column:
        return F.count(F.when(c, 1))

    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        n(cond).alias("kept_rows"),
        n(~cond).alias("excluded_rows"),
        n(cond.isNull()).alias("excluded_null_rows"),
        n(~d).alias("nonpos_distance"),
        n(~f).alias("negative_fare"),
        n(~o).alias("dropoff_before_pickup"),
        n(~(lo & hi)).alias("outside_window"),
    )


#: Bits of the filter of repeated keys: a proven bound of what is broadcast
#: (a 64-bit word per 64 bits, 16 MB of rows at most).
FILTER_BITS = 1 << 24


def key_hash(keys=NATURAL_KEY) -> Column:
    return F.xxhash64(*keys)


def repeated_key_filter(rel: DataFrame, keys=NATURAL_KEY, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter (one hash) of the keys that occur more than once, as
    (word, bits) rows, at most ``bits`` / 64 of them.  Only the key columns are
    read, and a hash and a count are shuffled, after a map-side count."""
    again = rel.groupBy(key_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    pos = F.col("h").bitwiseAND(F.lit(bits - 1))
    return (again.select(F.shiftright(pos, 6).alias("word"), pos.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def dedup_candidates(rel: DataFrame, keys=NATURAL_KEY, order=KEEP_ORDER, bits: int = FILTER_BITS) -> DataFrame:
    """Keep one row per key, shuffling only rows whose key may occur again.

    Rows not in the filter of repeated keys are alone with their key and pass as
    they are; the rest takes the exact path of ``dedup``.  A false positive of
    the filter only sends a single row there, so the filter may be full and the
    result is the same."""
    words = bounded(repeated_key_filter(rel, keys, bits))
    pos = key_hash(keys).bitwiseAND(F.lit(bits - 1))
    marked = (rel.withColumn("_pos", pos).join(words, F.shiftright("_pos", 6) == F.col("word"), "left")
              .withColumn("_again", F.coalesce(F.expr("(shiftright(bits, CAST(_pos & 63L AS INT)) & 1L) = 1L"), F.lit(False))))
    alone = marked.filter(~F.col("_again")).select(*rel.columns)
    again = marked.filter("_again").select(*rel.columns)
    return alone.unionByName(dedup(again, keys, order, method="aggregate"))


def dedup(rel: DataFrame, keys=NATURAL_KEY, order=KEEP_ORDER,
          method: str = "candidates") -> DataFrame:
    """Keep one row per key: the first by ``order`` (NULLs last).

    ``candidates`` (default) shuffles only rows whose key may occur again, see
    ``dedup_candidates``.  ``aggregate`` groups by the key and keeps the ``min``
    of one struct holding the order columns (each preceded by its NULL flag, so
    NULLs sort last) followed by any remaining columns: the smallest struct
    is the first row by ``order``, ties broken by the remaining columns.  The
    map side combines copies before the shuffle, so even a key that holds a
    large share of the rows becomes one row per task, never one huge group,
    and each shuffled row carries its columns once.  ``window`` is the
    row_number form (all rows of a key meet in one task); all give the same
    rows.  NULL keys form one group in all.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in rel.columns if c not in keys]
    if method == "candidates":
        return dedup_candidates(rel, keys, order)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).asc_nulls_last() for c in order])
        return (rel.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") == 1).drop("_rn"))
    if method != "aggregate":
        raise ValueError(f"unknown dedup method {method!r}")
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(c)]
    fields += [F.col(c).alias(c) for c in rest if c not in order]
    kept = rel.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                         for c in rel.columns])


def key_and_derive(rel: DataFrame) -> DataFrame:
    """Surrogate key, dimension keys and derived measures, computed once."""
    tip_pct = F.when(F.col("fare_amount") > 0,
                     F.round(F.col("tip_amount") / F.col("fare_amount"), 4)
                     ).cast("decimal(16,4)")
    return rel.select(
        trip_key("VendorID", "pickup_ts", "PULocationID", "total_amount").alias("trip_key"),
        date_key("pickup_ts").alias("date_key"),
        F.hour("pickup_ts").cast("int").alias("time_key"),
        F.col("PULocationID").cast("int").alias("pu_zone_key"),
        F.col("DOLocationID").cast("int").alias("do_zone_key"),
        F.col("VendorID").cast("int").alias("vendor_key"),
        F.col("payment_type").cast("int").alias("payment_key"),
        F.col("ratecode_id").cast("int").alias("ratecode_key"),
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        "total_amount",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        whole_minutes("pickup_ts", "dropoff_ts").cast("int").alias("trip_duration_min"),
        tip_pct.alias("tip_pct"),
        month_label("pickup_ts").alias("year_month"),
    )


FACT_COLUMNS = (
    "trip_key", "date_key", "time_key", "pu_zone_key", "do_zone_key", "vendor_key",
    "payment_key", "ratecode_key", "trip_distance", "fare_amount", "tip_amount",
    "tolls_amount", "total_amount", "passenger_count", "trip_duration_min", "tip_pct",
    "pu_is_cbd", "year_month",
)


def denormalise(keyed: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Carry the pickup zone's treated flag on the fact (left join: an
    unknown zone keeps the trip with a NULL flag)."""
    z = dim_zone.select(F.col("zone_key"), F.col("is_cbd").alias("pu_is_cbd"))
    j = keyed.join(z, keyed.pu_zone_key == z.zone_key, "left")
    return j.select(*FACT_COLUMNS)
