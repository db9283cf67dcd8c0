"""The warehouse build: sources -> zone reference -> dimensions -> fact.

``Warehouse`` holds the lazily built frames of one source and config.  The
fact is the only large table; it is written once (partitioned by month,
sorted by date and zone inside each file) and every analysis reads the
written table, so lineage is cut and a lost executor costs a re-read, not a
rebuild.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.config import TPCH_TRIPS, PipelineConfig
from cordon.operators import dims as D
from cordon.operators import fact as FT
from cordon.operators import panel as panel_ops
from cordon.operators.broadcast import bounded
from cordon.operators.zones import classify_zones
from cordon.plans.scratch import scratch_path
from cordon.schemas import FACT_PARTITION
from cordon.shuffles import shuffles_for
from cordon.sources import tpch_raw_trips, tpch_trip_count, tpch_zone_lookup, write_raw_months


def write_fact(fact: DataFrame, path: str, mark: Callable[[DataFrame], DataFrame] | None = None,
               rows: int | None = None) -> None:
    """Partitioned fact sink (S6): one folder per month.

    Rows are range-partitioned on (date, pickup zone, trip key) and sorted
    the same way inside each task: every task writes one contiguous date
    range - one or two month folders instead of a file in every month - and
    Parquet row-group statistics prune date and zone ranges (the study's
    date/zone sort key).  The unique trip key as last range key lets the
    partitioner split even a single (date, zone) holding a large share of
    all trips across tasks.  ``mark`` is applied to the rows as they are
    written (an observer).  ``rows``: about how many rows go into ``fact``, for
    which all its shuffles are planned; AQE joins small partitions."""
    keys = ["date_key", "pu_zone_key", "trip_key"]
    # after de-duplication rows are unique on the natural key; when the trip
    # key is NULL (a NULL key part) these columns still tell rows apart, so
    # even a large group of NULL-key trips can be split between tasks
    ties = ["time_key", "vendor_key", "total_amount", "trip_duration_min", "do_zone_key"]
    laid = fact.repartitionByRange(*keys, *ties).sortWithinPartitions(*keys)
    with shuffles_for(fact.sparkSession, rows):
        ((mark(laid) if mark else laid)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(FACT_PARTITION)
            .parquet(path))


def read_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written fact with its declared schema (the month folder reads
    back as a string, never an inferred number)."""
    return spark.read.schema(schema).parquet(path)


@dataclass
class Warehouse:
    """``source_raw`` is the raw trip relation as delivered (files, or the
    adapter's derivation).  With ``materialize`` the raw rows are landed once
    as monthly Parquet (exact types kept) and the fact is written once; all
    reads then go to those files."""

    spark: SparkSession
    cfg: PipelineConfig
    source_raw: DataFrame
    lookup: DataFrame
    dedup_method: str = "candidates"
    materialize: bool = True
    # land the raw rows as files first; off when they already are files
    land_raw: bool = True
    # about how many rows ``source_raw`` has, for the shuffles that land them
    source_rows: Callable[[], int] | None = None
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False)

    @cached_property
    def raw_path(self) -> str | None:
        if not (self.materialize and self.land_raw):
            return None
        path = scratch_path(self.spark, "raw_trips")
        write_raw_months(self.source_raw, path, conform=False, rows=self.source_rows() if self.source_rows else None)
        return path

    @property
    def raw(self) -> DataFrame:
        if not (self.materialize and self.land_raw):
            return self.source_raw
        with self._lock:
            path = self.raw_path
        return self.spark.read.schema(self.source_raw.schema).parquet(path)

    @cached_property
    def raw_rows(self) -> int:
        """Rows of the raw files, from their footers."""
        return self.raw.count()

    # -- zone reference and dimensions --------------------------------------
    @cached_property
    def zone_ref(self) -> DataFrame:
        return classify_zones(self.lookup, self.cfg)

    @cached_property
    def dim_zone(self) -> DataFrame:
        """Zone dimension; the planner broadcasts it by its measured size."""
        return D.dim_zone(self.zone_ref)

    @cached_property
    def dim_date(self) -> DataFrame:
        return bounded(D.dim_date(self.spark, self.cfg))

    @cached_property
    def dim_time(self) -> DataFrame:
        return bounded(D.dim_time(self.spark))

    @cached_property
    def dim_payment(self) -> DataFrame:
        return bounded(D.dim_payment(self.spark, self.cfg))

    @cached_property
    def dim_ratecode(self) -> DataFrame:
        return bounded(D.dim_ratecode(self.spark, self.cfg))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return bounded(D.dim_vendor(self.spark, self.cfg))

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {"zone": self.dim_zone, "date": self.dim_date, "time": self.dim_time,
                "payment": self.dim_payment, "ratecode": self.dim_ratecode,
                "vendor": self.dim_vendor}

    # -- fact stages ----------------------------------------------------------
    @cached_property
    def cleaned(self) -> DataFrame:
        return FT.clean(self.raw, self.cfg)

    @cached_property
    def deduped(self) -> DataFrame:
        return FT.dedup(self.cleaned, method=self.dedup_method)

    @cached_property
    def keyed(self) -> DataFrame:
        return FT.key_and_derive(self.deduped)

    @cached_property
    def fact_plan(self) -> DataFrame:
        return FT.denormalise(self.keyed, self.dim_zone)

    @cached_property
    def fact_path(self) -> str | None:
        if not self.materialize:
            return None
        path = scratch_path(self.spark, "fact_trips")
        write_fact(self.fact_plan, path, rows=self.raw_rows)
        return path

    @property
    def fact(self) -> DataFrame:
        if not self.materialize:
            return self.fact_plan
        with self._lock:
            path = self.fact_path
        return read_fact(self.spark, path, self.fact_plan.schema)

    @cached_property
    def zone_day_path(self) -> str:
        path = scratch_path(self.spark, "zone_day")
        panel_ops.zone_day(self.fact, self.cfg.card_payment).write.mode("overwrite").parquet(path)
        return path

    @property
    def zone_day(self) -> DataFrame:
        """The fact collapsed to (pickup zone, date), written once; small."""
        if not self.materialize:
            return panel_ops.zone_day(self.fact, self.cfg.card_payment)
        with self._lock:
            path = self.zone_day_path
        return self.spark.read.parquet(path)

    def build(self) -> Warehouse:
        """Write the raw landing, the fact and the zone x day table now, as an
        explicit step; queries otherwise write them when first read."""
        _ = (self.raw, self.fact, self.zone_day)
        return self


_CACHE: dict = {}
_CACHE_LOCK = threading.Lock()


def taxi_warehouse(spark: SparkSession, raw_root: str, zone_csv: str,
                   cfg: PipelineConfig | None = None, **kw) -> Warehouse:
    """Warehouse over monthly raw trip files (``raw_root/trip_month=YYYY-MM/``)
    and the zone lookup CSV, with the study's values by default.  The raw
    files are read in place - by column name, cast to the declared types, so
    months whose files store different physical types still union - with no
    landing copy."""
    from cordon.config import TAXI
    from cordon.sources import read_raw_trips, read_zone_lookup
    kw.setdefault("land_raw", False)
    return Warehouse(spark, cfg or TAXI, read_raw_trips(spark, raw_root),
                     read_zone_lookup(spark, zone_csv), **kw)


def tpch_warehouse(spark: SparkSession, sf_dir: str,
                   cfg: PipelineConfig = TPCH_TRIPS, **kw) -> Warehouse:
    """Warehouse over the trips adapter of one test-table folder, shared by
    every query of the session (the fact is built and written once)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), cfg,
           tuple(sorted(kw.items())))
    with _CACHE_LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = Warehouse(spark, cfg, tpch_raw_trips(spark, sf_dir),
                           tpch_zone_lookup(spark, sf_dir),
                           source_rows=lambda: tpch_trip_count(spark, sf_dir), **kw)
            _CACHE[key] = wh
    return wh
