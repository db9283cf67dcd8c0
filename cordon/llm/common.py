"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cordon
from cordon.plans.scratch import scratch_path

_SHIPPED: set[str] = set()

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(spark: SparkSession) -> None:
    """Give the executors this library's code, once per application: Python
    tasks import it, wherever the driver was started."""
    sc, root = spark.sparkContext, Path(cordon.__file__).parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    path = f"{tempfile.mkdtemp(prefix='cordon-code-')}/cordon.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"cordon/{f.relative_to(root)}")
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def grouped_pandas(grouped, spark: SparkSession, fn, schema) -> DataFrame:
    ship(spark)
    return grouped.applyInPandas(fn, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Hand Python tasks at most ``rows`` rows at a time meanwhile, where a row
    may hold very long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table under ``spark.checkpoint.dir``: cuts the
    lineage, survives lost executors, and gives the planner exact sizes (a
    side is broadcast only when its files are under Spark's threshold)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def row_key(text: Column) -> Column:
    """Beside doc_id, tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; keeps the left keys."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def crc32_mod(doc_id: Column, m: int) -> Column:
    """crc32 of doc_id as text, modulo ``m`` (NULL id: as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(m)
