"""The fact kept up to date by months.

The natural key of a trip holds its pickup time, so copies of a trip always
share the pickup month and a month of pickups can be rebuilt alone.  A raw file
month may hold pickups of other months; an index of (file month, pickup month,
rows) says which file months a pickup month needs.  When file months arrive, or
are delivered again:

* the pickup months that the index has for them, before and now, are stale;
* each stale month is rebuilt from the file months that hold pickups of it;
* its folder goes to the folder of this run, the zone x day table likewise;
* all other months keep pointing at the folders they already have.

A run writes only into its own folder and returns month -> folder, so a broken
run leaves the state that was there; ``Fact.state`` is written last, as one
row per month.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.config import PipelineConfig
from cordon.functions import month_label
from cordon.operators import fact as FT
from cordon.operators import panel
from cordon.plans.warehouse import write_fact
from cordon.schemas import FACT_PARTITION, RAW_PARTITION, RAW_TRIPS
from cordon.shuffles import shuffles_for
from cordon.sources.raw import read_raw_trips

INDEX = f"{RAW_PARTITION} string, {FACT_PARTITION} string, rows long"


def pickup_index(raw: DataFrame) -> DataFrame:
    """(file month, pickup month, rows) of raw rows; a null pickup has a null month."""
    return raw.groupBy(RAW_PARTITION, month_label(FT.PICKUP).alias(FACT_PARTITION)).agg(F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class State:
    """``index``: file month -> pickup month -> rows; ``months``: pickup month ->
    fact folder and zone x day folder."""

    index: dict[str, dict[str, int]]
    months: dict[str, tuple[str, str]]


class MonthlyFact:
    """An incremental fact under ``root`` over the raw store ``raw_root``, whose
    files hold the columns of ``schema``."""

    def __init__(self, spark: SparkSession, raw_root: str, root: str, dim_zone: DataFrame, cfg: PipelineConfig,
                 schema: T.StructType = RAW_TRIPS):
        self.spark, self.raw_root, self.root, self.dim_zone, self.cfg = spark, raw_root, root, dim_zone, cfg
        self.schema = T.StructType([f for f in schema.fields if f.name != RAW_PARTITION])

    # -- state ---------------------------------------------------------------
    def _latest(self) -> str | None:
        try:
            row = self.spark.read.schema("run string").json(f"{self.root}/state/*/done").agg(F.max("run")).first()
        except AnalysisException as e:  # the first run
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row[0]

    def state(self) -> State:
        run = self._latest()
        if run is None:
            return State({}, {})
        index: dict[str, dict[str, int]] = {}
        for r in self.spark.read.schema(INDEX).parquet(f"{self.root}/state/{run}/index").collect():  # months squared
            index.setdefault(r[0], {})[r[1]] = r[2]
        rows = self.spark.read.parquet(f"{self.root}/state/{run}/months").collect()
        return State(index, {r.month: (r.fact, r.zone_day) for r in rows})

    def _save(self, state: State) -> None:
        n = 1 + (0 if (old := self._latest()) is None else int(old.split("-")[0]))
        run, spark = f"{n:08d}-{uuid.uuid4().hex[:8]}", self.spark
        rows = [(f, p, c) for f, own in state.index.items() for p, c in own.items()]
        spark.createDataFrame(rows, INDEX).coalesce(1).write.parquet(f"{self.root}/state/{run}/index")
        months = [(m, *paths) for m, paths in state.months.items()]
        spark.createDataFrame(months, "month string, fact string, zone_day string").coalesce(1).write.parquet(
            f"{self.root}/state/{run}/months")
        # the state counts from here on
        spark.createDataFrame([(run,)], "run string").coalesce(1).write.json(f"{self.root}/state/{run}/done")

    # -- one run -------------------------------------------------------------
    def _raw(self, files: list[str]) -> DataFrame:
        """Only the folders of these file months are opened."""
        paths = [f"{self.raw_root}/{RAW_PARTITION}={m}" for m in files]
        return read_raw_trips(self.spark, self.raw_root, self.schema, uniform=True, months=paths)

    def update(self, arrived: list[str], check: Callable[[DataFrame], None] = lambda rebuilt: None) -> list[str]:
        """Take the file months ``arrived`` (new or delivered again; one that is
        gone from the store takes its trips with it); returns the pickup months
        that were rebuilt or removed.  ``check`` gets the rebuilt months before
        they count; what it raises leaves the state as it was."""
        old = self.state()
        index = {f: own for f, own in old.index.items() if f not in arrived}
        there = [f for f in arrived if self._exists(f)]
        for f in there:
            index[f] = {}
        if there:
            for r in pickup_index(self._raw(there)).collect():  # months squared
                index[r[0]][r[1]] = r[2]
        low, high = self.cfg.window_start.strftime("%Y-%m"), self.cfg.last_window_date.strftime("%Y-%m")
        stale = {p for f in arrived for own in (old.index.get(f, {}), index.get(f, {})) for p in own}
        stale = sorted(p for p in stale if p is not None and low <= p <= high)
        files = sorted(f for f, own in index.items() if any(p in own for p in stale))
        months = {m: paths for m, paths in old.months.items() if m not in stale}
        if files:
            run = f"{self.root}/runs/{uuid.uuid4().hex}"
            raw = self._raw(files).filter(month_label(FT.PICKUP).isin(stale))
            rel = FT.denormalise(FT.key_and_derive(FT.dedup(FT.clean(raw, self.cfg))), self.dim_zone)
            rows = sum(n for f in files for p, n in index[f].items() if p in stale)
            write_fact(rel, f"{run}/fact", rows=rows)
            fact = self.spark.read.schema(rel.schema).parquet(f"{run}/fact")
            with shuffles_for(self.spark, rows):
                check(fact)
            (panel.zone_day(fact.withColumn("_m", F.col(FACT_PARTITION)), self.cfg.card_payment, "_m")
             .withColumnRenamed("_m", FACT_PARTITION).write.partitionBy(FACT_PARTITION).parquet(f"{run}/zone_day"))
            for r in fact.select(FACT_PARTITION).distinct().collect():
                months[r[0]] = (f"{run}/fact/{FACT_PARTITION}={r[0]}", f"{run}/zone_day/{FACT_PARTITION}={r[0]}")
        self._save(State(index, months))
        return stale

    def _exists(self, month: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.raw_root}/{RAW_PARTITION}={month}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    # -- reading -------------------------------------------------------------
    def _read(self, schema: T.StructType, which: int) -> DataFrame:
        """All months, a scan of every run that still has months; the month is
        part of the folder names below each run."""
        bases: dict[str, list[str]] = {}
        for paths in self.state().months.values():
            bases.setdefault(paths[which].rsplit("/", 1)[0], []).append(paths[which])
        out = None
        for base, paths in sorted(bases.items()):
            part = self.spark.read.schema(schema).option("basePath", base).parquet(*sorted(paths))
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None else out

    def fact(self) -> DataFrame:
        empty = FT.denormalise(FT.key_and_derive(FT.clean(self._raw([]), self.cfg)), self.dim_zone)
        return self._read(empty.schema, 0)

    def zone_day(self) -> DataFrame:
        shape = panel.zone_day(self.fact().withColumn("_m", F.col(FACT_PARTITION)), self.cfg.card_payment, "_m")
        return self._read(shape.withColumnRenamed("_m", FACT_PARTITION).schema, 1)
