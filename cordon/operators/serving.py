"""Typed serving contract and load checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.schemas import FACT_PARTITION, SERVING_DIMS, SERVING_FACT, SERVING_STRING_WIDTHS


def to_serving(rel: DataFrame, contract=SERVING_FACT, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select the contract's columns by name (plus ``extra`` ones as they are)
    and cast each with ``try_cast`` - a value that does not fit becomes NULL
    instead of failing the job (ANSI mode).  Decimals are rounded half up to
    the contract's scale; ``contract_rounding`` counts the values this
    changes."""
    return rel.select(*[F.col(c).try_cast(t).alias(c) for c, t, _ in contract], *extra)


def _stacked(rel: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    agg = rel.agg(*[F.count(F.when(x, 1)).alias(n) for n, x in checks])
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in checks)
    return agg.selectExpr(f"stack({len(checks)}, {pairs}) AS (check_name, failures)")


def contract_violations(rel: DataFrame, contract=SERVING_FACT,
                        widths=SERVING_STRING_WIDTHS) -> DataFrame:
    """Per contract rule, rows of ``rel`` that would break it: a value lost by
    the cast, a NULL in a NOT NULL column, a string over its width."""
    checks: list[tuple[str, Column]] = []
    for c, t, nullable in contract:
        lost = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        checks.append((f"cast_{c}", lost))
        if not nullable:
            checks.append((f"not_null_{c}", F.col(c).isNull()))
    for c, w in widths.items():
        checks.append((f"width_{c}", F.length(F.col(c)) > w))
    return _stacked(rel, checks)


def contract_rounding(rel: DataFrame, contract=SERVING_FACT) -> DataFrame:
    """Per decimal column, the rows whose value the contract's scale rounds."""
    checks = []
    for c, t, _ in contract:
        if t.startswith("decimal"):
            checks.append((f"rounded_{c}", F.col(c).try_cast(t) != F.col(c)))
    return _stacked(rel, checks)


def dim_violations(dim: DataFrame, name: str) -> DataFrame:
    """Contract violations of a serving dimension, with key uniqueness."""
    table = SERVING_DIMS[name]
    repeated = (dim.groupBy(table.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(f"dim_{name}_unique_{table.key}").alias("check_name"), "failures"))
    rules = contract_violations(dim, table.columns, table.widths)
    return rules.withColumn("check_name", F.concat(F.lit(f"dim_{name}_"), "check_name")).unionByName(repeated)


def trips_per_period(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    return (per.join(dim_date, "date_key").groupBy("period")
            .agg(F.sum("n").cast("bigint").alias("trips")))


def orphan_zone_recheck(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """LEFT JOIN ... IS NULL form of the pickup-zone orphan count."""
    z = dim_zone.select(F.col("zone_key"))
    j = fact.join(z, fact.pu_zone_key == z.zone_key, "left")
    return j.agg(F.count(F.when(F.col("zone_key").isNull(), 1)).alias("orphan_zone_rows"))


def load_checks(loaded: DataFrame, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """What a load must show: as many rows as the fact has, no pickup zone
    without a zone, and trips in every period that the fact has trips in."""
    n = loaded.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("m")).unionByName(
        fact.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("m"))).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    rows = n.select(F.lit("load_rows").alias("check_name"), F.abs(F.col("n") - F.col("m")).alias("failures"),
                    F.concat(F.lit("loaded="), F.col("n").cast("string"), F.lit(", fact="), F.col("m").cast("string")).alias("detail"))
    orphans = orphan_zone_recheck(loaded, dims["zone"]).select(
        F.lit("load_orphan_zones").alias("check_name"), F.col("orphan_zone_rows").alias("failures"), F.lit("").alias("detail"))
    per = trips_per_period(loaded, dims["date"]).withColumnRenamed("trips", "loaded")
    lost = (trips_per_period(fact, dims["date"]).join(per, "period", "left")
            .filter(F.coalesce("loaded", F.lit(0)) != F.col("trips")))
    periods = lost.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("load_trips_per_period").alias("check_name"), "failures", F.lit("").alias("detail"))
    return rows.unionByName(orphans).unionByName(periods)


def post_period_trips(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Trips, revenue and mean distance per month and group after the cutoff,
    from the trips themselves.  The period is a column of the date dimension;
    joining on its month too lets Spark prune the fact's month folders by the
    dates that are left (dynamic partition pruning)."""
    post = dim_date.filter(F.col("period") == "post").select("date_key", FACT_PARTITION)
    return (fact.join(post, ["date_key", FACT_PARTITION]).groupBy(FACT_PARTITION, "pu_is_cbd")
            .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast("double").alias("revenue"),
                 (F.sum("trip_distance").cast("double") / F.count("trip_distance").cast("double")).alias("avg_distance")))
