"""Data-quality checks (D17-D22) and the gate.

Each check returns rows ``(check_name, failures)`` (DQ1 and DQ6 carry their
detail columns too).  ``gate_report`` fuses them: one pass over the fact
with broadcast joins to the (bounded) dimension keys answers reconciliation,
orphans, ranges, NULL keys, emptiness and month completeness together; the
duplicate-key check is a second scan and the one shuffle; raw is scanned once.
``observe_fact`` takes the figures of that fused pass while the fact is written,
so only the duplicate-key scan is left afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cordon.config import EXPECTED_RAW_COLUMNS, PipelineConfig
from cordon.operators.dims import inline_table
from cordon.operators.fact import exclusion_counts


class GateFailed(RuntimeError):
    """``failures``: (check, count); ``details``: per failing check, the
    figures behind it."""

    def __init__(self, failures: list[tuple[str, int]], details: dict[str, str] | None = None):
        self.failures = failures
        self.details = details or {}
        super().__init__("data-quality gate failed: " + ", ".join(
            f"{n}={v}" + (f" {self.details[n]}" if self.details.get(n) else "") for n, v in failures))


def _count_if(c: Column) -> Column:
    return F.count(F.when(c, 1))


# -- DQ1 -------------------------------------------------------------------------

def _one_row(*frames: DataFrame) -> DataFrame:
    """Side by side columns of several one-row aggregates, without a cross
    join: stack each to (name, value), union, fold back to one row."""
    longs = []
    names = []
    for f in frames:
        cols = f.columns
        names += cols
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in cols)
        longs.append(f.selectExpr(f"stack({len(cols)}, {pairs}) AS (k, v)"))
    u = longs[0]
    for x in longs[1:]:
        u = u.unionByName(x)
    return u.agg(*[F.max(F.when(F.col("k") == n, F.col("v"))).alias(n) for n in names])


def row_reconciliation(raw: DataFrame, fact: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """raw = fact + excluded + unexplained gap; fails when |gap| exceeds the
    tolerance share of raw.  The gap holds de-duplication removals and rows
    whose rule result is NULL; both are reported exactly."""
    ex = exclusion_counts(raw, cfg).select("raw_rows", "kept_rows", "excluded_rows",
                                           "excluded_null_rows")
    fr = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    r = _one_row(ex, fr)
    gap = F.col("raw_rows") - F.col("fact_rows") - F.col("excluded_rows")
    return r.select(
        F.lit("row_reconciliation").alias("check_name"),
        "raw_rows", "fact_rows", "excluded_rows", "excluded_null_rows",
        (F.col("kept_rows") - F.col("fact_rows")).alias("duplicates_removed"),
        gap.alias("unexplained_gap"),
        F.when(F.abs(gap) > F.lit(cfg.reconciliation_tolerance) * F.col("raw_rows"), 1)
         .otherwise(0).cast("bigint").alias("failures"))


# -- DQ2 -------------------------------------------------------------------------

# The names of the checks.
def _fk_specs(dims: dict[str, DataFrame]):
    """(check name, fact column, dimension, dimension key)."""
    return [
        ("orphan_pickup_zone", "pu_zone_key", dims["zone"], "zone_key"),
        ("orphan_dropoff_zone", "do_zone_key", dims["zone"], "zone_key"),
        ("orphan_payment", "payment_key", dims["payment"], "payment_key"),
        ("orphan_ratecode", "ratecode_key", dims["ratecode"], "ratecode_key"),
        ("orphan_vendor", "vendor_key", dims["vendor"], "vendor_key"),
        ("orphan_date", "date_key", dims["date"], "date_key"),
    ]


EXTRA_FK = ("orphan_time", "time_key", "time", "time_key")

# dimensions whose keys are unique by construction (spine, hours, decode
# tables); only the zone lookup is external and may repeat a key
UNIQUE_KEY_DIMS = ("date", "time", "payment", "ratecode", "vendor")


def _mark_orphans(fact: DataFrame, dims: dict[str, DataFrame], with_time: bool):
    """Left-join the fact to each dimension's distinct keys; a missing marker
    means orphan, including a NULL key.  The key sets are tiny, so the
    planner broadcasts them from their measured size and the fact streams
    through all joins in one stage; a large key set would fall back to a
    shuffle join instead of being forced into memory."""
    specs = _fk_specs(dims)
    if with_time:
        n, col, d, k = EXTRA_FK
        specs.append((n, col, dims[d], k))
    unique = {id(dims[d]) for d in UNIQUE_KEY_DIMS if d in dims}
    f = fact
    flags = []
    for i, (name, col, dim, key) in enumerate(specs):
        m = f"_m{i}"
        keys = dim.select(F.col(key).alias(f"_k{i}"))
        keys = (keys if id(dim) in unique else keys.distinct()).withColumn(m, F.lit(1))
        f = f.join(keys, f[col] == keys[f"_k{i}"], "left")
        flags.append((name, F.col(m).isNull()))
    return f, flags


def referential_integrity(fact: DataFrame, dims: dict[str, DataFrame],
                          with_time: bool = True) -> DataFrame:
    """Orphan counts per foreign key in one scan of the fact.  ``orphan_time``
    is an extra check beyond the six of the study."""
    f, flags = _mark_orphans(fact, dims, with_time)
    agg = f.agg(*[_count_if(c).alias(n) for n, c in flags])
    pairs = ", ".join(f"'{n}', `{n}`" for n, _ in flags)
    return agg.selectExpr(f"stack({len(flags)}, {pairs}) AS (check_name, failures)")


def referential_integrity_antijoin(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The same counts in the NOT EXISTS form (one anti join per key); kept
    to show the fused form equals it."""
    out = None
    for name, col, dim, key in _fk_specs(dims):
        d = dim.select(F.col(key).alias("_k"))
        n = (fact.join(d, fact[col] == d["_k"], "left_anti")
             .agg(F.count(F.lit(1)).alias("failures"))
             .select(F.lit(name).alias("check_name"), "failures"))
        out = n if out is None else out.unionByName(n)
    return out


# -- DQ3 -------------------------------------------------------------------------

def _range_violations(cfg: PipelineConfig) -> list[Column]:
    """One condition per bounded measure: under its lowest or over its highest
    value (a NULL measure violates nothing)."""
    b = cfg.bounds
    limits = {"trip_distance": b.distance_max, "fare_amount": b.fare_max, "total_amount": b.total_max,
              "trip_duration_min": b.minutes_max, "tip_pct": b.tip_pct_max}
    out = []
    for measure, high in limits.items():
        c = F.col(measure)
        low = c <= 0 if measure == "trip_distance" else c < 0  # a trip has a distance
        out.append(low | (c > high))
    return out


def _range_total(cfg: PipelineConfig) -> Column:
    total = None
    for c in _range_violations(cfg):
        n = _count_if(c)
        total = n if total is None else total + n
    return total


def range_assertions(fact: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Sum of the five range-violation counts (0 on an empty fact; the
    emptiness itself is ``fact_not_empty``)."""
    return fact.agg(_range_total(cfg).cast("bigint").alias("failures")).select(
        F.lit("range_assertions").alias("check_name"), "failures")


# -- DQ4 -------------------------------------------------------------------------

def duplicate_keys(fact: DataFrame) -> DataFrame:
    """Number of trip keys occurring more than once (NULL counts as a key).
    One scan and one shuffle of the keys as 16 bytes, counted map-side
    first."""
    d = (fact.groupBy(F.unhex("trip_key").alias("key")).agg(F.count(F.lit(1)).alias("n"))
         .filter(F.col("n") > 1))
    return d.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("duplicate_trip_keys").alias("check_name"), "failures")


# -- DQ5 -------------------------------------------------------------------------

def schema_drift(raw: DataFrame, expected=EXPECTED_RAW_COLUMNS) -> DataFrame:
    """Expected raw columns missing from the table (names, case-insensitive)."""
    spark = raw.sparkSession
    exp = inline_table(spark, [(c,) for c in expected], [("col", "string")])
    act = inline_table(spark, [(c.lower(),) for c in raw.columns], [("col", "string")])
    missing = exp.join(act, "col", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("schema_drift_missing_cols").alias("check_name"), "failures")


def schema_drift_table(spark, table: str, expected=EXPECTED_RAW_COLUMNS) -> DataFrame:
    """DQ5 against a catalog table's declared columns (information schema)."""
    cols = [c.name for c in spark.catalog.listColumns(table)]
    return schema_drift(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols)),
                        expected)


# -- DQ6 -------------------------------------------------------------------------

def month_completeness(fact: DataFrame, cfg: PipelineConfig) -> DataFrame:
    n = F.countDistinct("year_month")
    return fact.agg(n.alias("months_present")).select(
        F.lit("month_completeness").alias("check_name"),
        F.when(F.col("months_present") == cfg.expected_months, 0).otherwise(1)
         .cast("bigint").alias("failures"),
        F.col("months_present").cast("bigint").alias("months_present"))


# -- fused gate ------------------------------------------------------------------------

def _fused(cfg: PipelineConfig, flags: list[tuple[str, Column]]) -> list[Column]:
    """The figures of one pass over the fact with its orphan marks."""
    return [F.count(F.lit(1)).alias("fact_rows"), *[_count_if(c).alias(n) for n, c in flags],
            _range_total(cfg).alias("range_assertions"), _count_if(F.col("trip_key").isNull()).alias("null_trip_key")]


def _checks(one: DataFrame, names: list[str], cfg: PipelineConfig) -> DataFrame:
    """(check_name, failures, detail) from one row of figures."""
    gap = F.col("raw_rows") - F.col("fact_rows") - F.col("excluded_rows")
    checks = [
        ("row_reconciliation",
         F.when(F.abs(gap) > F.lit(cfg.reconciliation_tolerance) * F.col("raw_rows"), 1).otherwise(0)),
        *[(n, F.col(n)) for n in names],
        ("range_assertions", F.col("range_assertions")),
        ("month_completeness", F.when(F.col("months_present") == cfg.expected_months, 0).otherwise(1)),
        ("null_trip_key", F.col("null_trip_key")),
        ("fact_not_empty", F.when(F.col("fact_rows") == 0, 1).otherwise(0)),
    ]

    def text(*names: str) -> Column:
        return F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.col(n).cast("bigint").cast("string")) for n in names])

    one = one.withColumn("unexplained_gap", gap).withColumn("expected_months", F.lit(cfg.expected_months))
    details = {"row_reconciliation": text("raw_rows", "fact_rows", "excluded_rows", "unexplained_gap"),
               "month_completeness": text("months_present", "expected_months")}
    entries = F.array(*[F.struct(F.lit(n).alias("check_name"), c.cast("bigint").alias("failures"),
                                 details.get(n, F.lit("")).alias("detail")) for n, c in checks])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def gate_report(raw: DataFrame, fact: DataFrame, dims: dict[str, DataFrame],
                cfg: PipelineConfig) -> DataFrame:
    """Every check as (check_name, failures, detail), scanning the fact twice
    (one fused pass + the duplicate-key shuffle) and raw once.  ``detail``
    holds the figures behind a check (empty where the count says all)."""
    f, flags = _mark_orphans(fact, dims, with_time=True)
    fused = f.agg(*_fused(cfg, flags), F.countDistinct("year_month").alias("months_present"))
    one = _one_row(exclusion_counts(raw, cfg).select("raw_rows", "excluded_rows"), fused)
    none = F.lit("").alias("detail")
    return (_checks(one, [n for n, _ in flags], cfg)
            .unionByName(duplicate_keys(fact).select("*", none))
            .unionByName(schema_drift(raw).select("*", none)))


class FactObserver:
    """The figures of the gate's fused pass, taken from the rows on their way
    into the fact's files.

    ``mark`` belongs after the last shuffle of the write: the figures come from
    the tasks that write the files, which count once however often a stage
    before them or a task is run again.  ``report`` compares the observed rows
    with the rows in the written files' footers and, should they ever differ
    (files and figures from different attempts), scans the fact instead."""

    def __init__(self, dims: dict[str, DataFrame], cfg: PipelineConfig):
        self.dims, self.cfg, self.observation = dims, cfg, Observation()
        self.names: list[str] = []

    def mark(self, rows: DataFrame) -> DataFrame:
        f, flags = _mark_orphans(rows, self.dims, with_time=True)
        self.names = [n for n, _ in flags]
        # no distinct count can be observed; the months are a set of bounded size
        months = F.size(F.collect_set("year_month")).cast("bigint").alias("months_present")
        return f.observe(self.observation, *_fused(self.cfg, flags), months).select(*rows.columns)

    def report(self, raw: DataFrame, fact: DataFrame) -> DataFrame:
        """``gate_report`` of the written ``fact``, without its fused scan."""
        spark, seen = fact.sparkSession, self.observation.get
        if seen["fact_rows"] != fact.count():  # footers only
            return gate_report(raw, fact, self.dims, self.cfg)
        figures = spark.createDataFrame([tuple(seen.values())], ", ".join(f"{n} bigint" for n in seen))
        one = _one_row(exclusion_counts(raw, self.cfg).select("raw_rows", "excluded_rows"), figures)
        none = F.lit("").alias("detail")
        return (_checks(one, self.names, self.cfg)
                .unionByName(duplicate_keys(fact).select("*", none))
                .unionByName(schema_drift(raw).select("*", none)))


def enforce_all(reports: list[DataFrame]) -> list[tuple[str, int]]:
    """Collect every (small) report; raise ``GateFailed`` once with all failing
    checks of all of them."""
    rows: list[tuple[str, int, str]] = []
    for report in reports:
        rows += [(r["check_name"], int(r["failures"] or 0), r.asDict().get("detail", "")) for r in report.collect()]
    bad = [(n, v) for n, v, _ in rows if v > 0]
    if bad:
        raise GateFailed(bad, {n: d for n, v, d in rows if v > 0 and d})
    return [(n, v) for n, v, _ in rows]


def enforce(report: DataFrame) -> list[tuple[str, int]]:
    """Collect the (small) report; raise ``GateFailed`` with every failing
    check and its detail.  NULL failures count as 0."""
    return enforce_all([report])
