"""Publishing a run's tables as one switch.

Every published table is kept for all runs in one partitioned catalog table
``<name>_runs`` whose first partition column is the run.  Readers use views:

* ``<name>``: the rows of ``<name>_runs`` of the run that ``published_run`` names;
* ``published_run``: one row, the run id.

A new run only adds partitions that no view shows yet; replacing the view
``published_run`` is the single step that readers can see, and it moves every
table at once.  A run that breaks before it changes nothing for readers, one
that breaks after it is complete.  A month that a run did not rewrite is a
partition that points at the folder of the run that did, so unchanged months are
shared, not copied, and no folder is ever written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cordon.schemas import FACT_PARTITION

RUN = "run_id"
SWITCH = "published_run"


@dataclass(frozen=True)
class Part:
    """A table of a run: its columns (without partition columns) and its folder,
    or a folder for every month."""

    schema: T.StructType
    path: str | None = None
    months: dict[str, str] | None = None


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Publication:
    """The published tables of one database.  ``after`` is called with the name
    of every step that is done (tests break the build there)."""

    def __init__(self, spark: SparkSession, database: str, after: Callable[[str], None] = lambda step: None):
        self.spark, self.database, self.after = spark, database, after

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def published_run(self) -> str | None:
        """The run that readers see."""
        if not self.spark.catalog.tableExists(f"{self.database}.{SWITCH}"):
            return None
        row = self.spark.table(f"{self.database}.{SWITCH}").first()
        return row[0] if row else None

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def months(self, name: str, run: str) -> list[str]:
        """The months of a monthly table that ``run`` has."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self._name(name + '_runs')} PARTITION ({RUN}={_quoted(run)})")
        return sorted(r[0].rsplit("=", 1)[1] for r in shown.collect())

    def month_paths(self, name: str, run: str) -> dict[str, str]:
        """Month: folder of a monthly table's partitions of ``run``."""
        out = {}
        for m in self.months(name, run):
            spec = f"{RUN}={_quoted(run)}, {FACT_PARTITION}={_quoted(m)}"
            about = self.spark.sql(f"DESCRIBE EXTENDED {self._name(name + '_runs')} PARTITION ({spec})").collect()
            out[m] = next(r.data_type for r in about if r.col_name == "Location")
        return out

    def publish(self, run: str, tables: dict[str, Part], home: str, analyze: bool = True) -> None:
        """Register ``tables`` as ``run`` and switch readers to it.  ``home`` is
        the folder in which tables without files of their own live."""
        sql = self.spark.sql
        sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        if self.published_run() is None:
            sql(f"CREATE OR REPLACE VIEW {self._name(SWITCH)} AS SELECT CAST(NULL AS STRING) AS {RUN}")
        self.after("database")
        for name, part in tables.items():
            self._add(run, name, part, home)
            self.after(f"partitions of {name}")
            if analyze:
                sql(f"ANALYZE TABLE {self._name(name + '_runs')} PARTITION ({RUN}={_quoted(run)}"
                    + (f", {FACT_PARTITION}" if part.months is not None else "") + ") COMPUTE STATISTICS")
                self.after(f"statistics of {name}")
            columns = ", ".join(f"`{f.name}`" for f in part.schema.fields)
            if part.months is not None and FACT_PARTITION not in part.schema.fieldNames():
                columns += f", {FACT_PARTITION}"
            if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
                sql(f"CREATE VIEW {self._name(name)} AS SELECT {columns} FROM {self._name(name + '_runs')} "
                    f"WHERE {RUN} = (SELECT {RUN} FROM {self._name(SWITCH)})")
            self.after(f"view of {name}")
        sql(f"CREATE OR REPLACE VIEW {self._name(SWITCH)} AS SELECT {_quoted(run)} AS {RUN}")
        self.after("switch")

    def _add(self, run: str, name: str, part: Part, home: str) -> None:
        sql, table = self.spark.sql, self._name(name + "_runs")
        monthly = part.months is not None
        own = T.StructType([f for f in part.schema.fields if not (monthly and f.name == FACT_PARTITION)])
        by = f"{RUN} STRING" + (f", {FACT_PARTITION} STRING" if monthly else "")
        keys = RUN + (f", {FACT_PARTITION}" if monthly else "")
        sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(own)}, {by}) USING parquet PARTITIONED BY ({keys}) "
            f"LOCATION {_quoted(f'{home}/tables/{name}')}")
        if not monthly:
            sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({RUN}={_quoted(run)}) LOCATION {_quoted(part.path)}")
            return
        specs = [f"PARTITION ({RUN}={_quoted(run)}, {FACT_PARTITION}={_quoted(m)}) LOCATION {_quoted(p)}"
                 for m, p in sorted(part.months.items())]
        for lo in range(0, len(specs), 100):
            sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(specs[lo:lo + 100]))
