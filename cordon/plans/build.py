"""Write - audit - publish.

Every ``run_build`` writes into a folder of its own, ``<out_root>/runs/<id>``:
the dimensions, the fact and the typed serving tables.  The gate's figures are
observed while the fact is written; the gate, the serving contracts and the
checks of the loaded serving table are all evaluated, and one ``GateFailed``
names every failure with its details.  Only when every check passes are the
tables - untyped and typed, with statistics - published, as one switch
(``publish.py``): readers always see one whole run, and the folder of a run is
never written to again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cordon.operators import quality, serving
from cordon.plans.publish import Part, Publication
from cordon.plans.warehouse import Warehouse, read_fact, write_fact
from cordon.schemas import FACT_PARTITION, SERVING_DIMS, SERVING_FACT
from cordon.shuffles import shuffles_for


@dataclass
class BuildResult:
    run: str
    fact_path: str
    serving_path: str
    report: list[tuple[str, int]]
    dim_paths: dict[str, str] = field(default_factory=dict)
    serving_dim_paths: dict[str, str] = field(default_factory=dict)
    trips_per_period: dict[str, int] = field(default_factory=dict)


def contract_schema(contract) -> str:
    return ", ".join(f"{c} {t}" for c, t, _ in contract)


def _contract_struct(contract) -> T.StructType:
    return T.StructType.fromDDL(contract_schema(contract))


def publish_serving(fact: DataFrame, path: str, ordered: bool = False, rows: int | None = None) -> DataFrame:
    """Typed serving copy of the fact, laid out like the serving table's sort
    key: a folder per month, rows sorted by (date, pickup zone) inside, so a date
    range reads few folders and row groups.  A fact that ``write_fact`` wrote is
    ``ordered`` already: its files are date ranges, so every task sorts what it
    reads and no row is shuffled; otherwise rows are range-partitioned first,
    into partitions for about ``rows`` rows.
    The month is a folder only; the contract's columns are read back."""
    typed = serving.to_serving(fact, extra=(FACT_PARTITION,))
    keys = ["date_key", "pu_zone_key"]
    laid = typed if ordered else typed.repartitionByRange(*keys, "trip_key")
    order = [FACT_PARTITION, *keys] if ordered else keys
    with shuffles_for(fact.sparkSession, rows):
        laid.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(FACT_PARTITION).parquet(path)
    schema = contract_schema(SERVING_FACT) + f", {FACT_PARTITION} string"
    return fact.sparkSession.read.schema(schema).parquet(path).drop(FACT_PARTITION)


def publish_serving_dim(dim: DataFrame, name: str, path: str) -> DataFrame:
    """Typed serving copy of a dimension, read back with its contract."""
    contract = SERVING_DIMS[name].columns
    serving.to_serving(dim, contract).write.mode("overwrite").parquet(path)
    return dim.sparkSession.read.schema(contract_schema(contract)).parquet(path)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = True,
                   analyze: bool = True) -> None:
    """Point a catalog table at a written folder (S2, S4, S10).  ``name`` may
    be ``database.table``; the database is created when absent."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.', 1)[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    if analyze:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def add_partition(spark: SparkSession, table: str, column: str, value: str, path: str) -> None:
    """Register one partition folder explicitly (the alternative to
    discovering them)."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({column}='{value}') "
              f"LOCATION '{path}'")


def iterate_result(df: DataFrame) -> Iterator[dict]:
    """Rows of a result as dicts for a client (S15), one partition at a time:
    the driver never holds more than a partition of it."""
    for r in df.toLocalIterator():
        yield r.asDict()


def export_csv(results: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Persist small analysis results as CSV with a header (S16), one folder
    per result; returns the paths."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{root}/{name}"
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(paths[name])
    return paths


def month_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Month: folder of a table written by month."""
    months = spark.read.schema(f"{FACT_PARTITION} string").option("basePath", path).parquet(path).distinct().collect()
    return {r[0]: f"{path}/{FACT_PARTITION}={r[0]}" for r in months}


def run_build(wh: Warehouse, out_root: str, database: str | None = None,
              after: Callable[[str], None] = lambda step: None) -> BuildResult:
    """Build, audit and, with ``database``, publish once: ``fact_trips``,
    ``dim_<name>``, ``serving_fact_trips`` and ``serving_dim_<name>``.
    ``after`` is called with the name of every step that is done."""
    spark = wh.spark
    run = f"r{time.time_ns()}_{uuid.uuid4().hex[:8]}"
    home = f"{out_root}/runs/{run}"
    dim_paths, serving_dims = {}, {}
    for name, df in wh.dims.items():
        dim_paths[name] = f"{home}/dim_{name}"
        df.write.parquet(dim_paths[name])
    dims = {name: spark.read.schema(df.schema).parquet(dim_paths[name]) for name, df in wh.dims.items()}
    after("dimensions")
    fact_path, serving_path = f"{home}/fact_trips", f"{home}/serving/fact_trips"
    observer = quality.FactObserver(wh.dims, wh.cfg)
    write_fact(wh.fact_plan, fact_path, observer.mark, wh.raw_rows)
    fact = read_fact(spark, fact_path, wh.fact_plan.schema)
    after("fact")
    loaded = publish_serving(fact, serving_path, ordered=True)
    for name, df in dims.items():
        serving_dims[name] = f"{home}/serving/dim_{name}"
        publish_serving_dim(df, name, serving_dims[name])
    after("serving tables")
    reports = [observer.report(wh.raw, fact), serving.contract_violations(fact),
               *[serving.dim_violations(df, name) for name, df in dims.items()],
               serving.load_checks(loaded, fact, dims)]
    report = quality.enforce_all(reports)
    after("gate")
    periods = {r.period: r.trips for r in serving.trips_per_period(loaded, dims["date"]).collect()}
    if database:
        tables = {f"dim_{n}": Part(df.schema, dim_paths[n]) for n, df in dims.items()}
        tables |= {f"serving_dim_{n}": Part(_contract_struct(SERVING_DIMS[n].columns), p) for n, p in serving_dims.items()}
        tables["fact_trips"] = Part(fact.schema, months=month_folders(spark, fact_path))
        tables["serving_fact_trips"] = Part(_contract_struct(SERVING_FACT), months=month_folders(spark, serving_path))
        Publication(spark, database, after).publish(run, tables, out_root)
    return BuildResult(run, fact_path, serving_path, report, dim_paths, serving_dims, periods)
