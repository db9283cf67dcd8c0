"""Inference with few treated units: a permutation test of the DiD estimate.

The estimate is the mean change (post less pre) of the treated units less that
of the others.  Under the null hypothesis any set of as many units could have
been the treated one, so the share of sets whose estimate is at least as large
in size is the p-value.  All sets are enumerated where there are at most
``draws`` of them, otherwise ``draws`` sets are drawn by hashes with a fixed
seed (the treated set itself counts as one more).

Per unit, changes are integers (sums times the other period's days), so equal
sets compare equal exactly; a set is known by the sum of its units' changes.
The units come from the zone x day panel; all draws are one grouped aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.plans.scratch import scratch_path

DRAWS = 20_000
SEED = 20_250_105
SCHEMA = ("units long, treated_units long, did_estimate double, method string, sets long, at_least_as_large long, "
          "p_value double, warning string")


def unit_changes(panel: DataFrame, unit: str = "zone", y: str = "trips") -> DataFrame:
    """(unit, treated, change): change = post sum x pre days - pre sum x post
    days, with ``days`` = pre days x post days of the balanced panel."""
    post = F.col("post") == 1
    return panel.groupBy(F.col(unit).cast("string").alias("unit")).agg(
        F.max("treated").alias("treated"),
        F.sum(F.when(post, F.col(y))).cast("long").alias("post_sum"),
        F.sum(F.when(~post, F.col(y))).cast("long").alias("pre_sum"),
        F.count(F.when(post, 1)).alias("post_days"), F.count(F.when(~post, 1)).alias("pre_days")
    ).select("unit", "treated", (F.col("pre_days") * F.col("post_days")).alias("days"),
             (F.coalesce("post_sum", F.lit(0)) * F.col("pre_days")
              - F.coalesce("pre_sum", F.lit(0)) * F.col("post_days")).cast("decimal(38,0)").alias("change"))


def every_set(units: DataFrame, k: int) -> DataFrame:
    """(total) of every set of ``k`` units: sets grow by one larger unit a step."""
    own = units.select(F.col("unit").alias("last"), F.col("change").alias("total"))
    out = own
    for _ in range(k - 1):
        more = own.select(F.col("last").alias("next"), F.col("total").alias("more"))
        out = out.join(more, F.col("next") > F.col("last")).select(
            F.col("next").alias("last"), (F.col("total") + F.col("more")).cast("decimal(38,0)").alias("total"))
    return out.select("total")


def drawn_sets(units: DataFrame, k: int, draws: int, seed: int) -> DataFrame:
    """(total) of ``draws`` sets: of each, the k units with the smallest hashes."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("draw").cast("string"), F.col("unit")))
    drawn = units.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    first = F.slice(F.array_sort(F.collect_list(F.struct(order.alias("h"), "change"))), 1, k)
    return drawn.groupBy("draw").agg(first.alias("own")).select(
        F.aggregate("own", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x.change).cast("decimal(38,0)")).alias("total"))


def did_permutation(panel: DataFrame, unit: str = "zone", y: str = "trips", draws: int = DRAWS, seed: int = SEED) -> DataFrame:
    """One row.  Without treated units, without other ones, or without both
    periods the estimate and the p-value are NULL and ``warning`` says why."""
    spark = panel.sparkSession
    path = scratch_path(spark, "permutation_units")
    unit_changes(panel, unit, y).write.parquet(path)
    units = spark.read.parquet(path)
    r = units.agg(F.count("*").alias("n"), F.count(F.when(F.col("treated") == 1, 1)).alias("k"),
                  F.sum("change").alias("all"), F.sum(F.when(F.col("treated") == 1, F.col("change"))).alias("own"),
                  F.max("days").alias("days"), F.min("days").alias("least")).first()
    n, k = r.n, r.k
    why = ("no treated unit" if k == 0 else "no untreated unit" if k == n else "a period has no days" if not r.days
           else "the panel is not balanced" if r.days != r.least else None)
    if why:
        return spark.createDataFrame([(n, k, None, None, None, None, None, f"not identified: {why}")], SCHEMA)
    exact = math.comb(n, k) <= draws
    sets = every_set(units, k) if exact else drawn_sets(units, k, draws, seed)
    # total / k - (all - total) / (n - k), times k (n - k): total n - all k
    own = abs(int(r.own) * n - int(r.all) * k)
    size = F.abs(F.col("total") * F.lit(n) - F.lit(r.all) * F.lit(k))
    got = sets.agg(F.count("*").alias("sets"), F.count(F.when(size >= F.lit(own).cast("decimal(38,0)"), 1)).alias("hits"))
    more = 0 if exact else 1
    estimate = (int(r.own) * n - int(r.all) * k) / (k * (n - k)) / r.days
    return got.select(
        F.lit(n).cast("long").alias("units"), F.lit(k).cast("long").alias("treated_units"),
        F.lit(estimate).alias("did_estimate"), F.lit("exact" if exact else "drawn").alias("method"),
        (F.col("sets") + more).alias("sets"), (F.col("hits") + more).alias("at_least_as_large"),
        ((F.col("hits") + more) / (F.col("sets") + more)).alias("p_value"), F.lit(None).cast("string").alias("warning"))
