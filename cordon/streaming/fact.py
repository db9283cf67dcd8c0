"""The fact as a stream of raw files, gated batch by batch.

Each micro-batch (``foreachBatch``) lands its rows in the raw store, in a folder
of its own batch and file month, and rebuilds the pickup months they touch
(``MonthlyFact``).  A batch that is run again after a restart overwrites the same
folders, so it counts once.  Copies of a trip always share the pickup month, so
copies that arrive in different batches, in whatever order, leave the same row
as one batch run over all files.

The months of a batch are checked before they count: orphans, ranges and
duplicate keys of the rebuilt months.  A failing batch raises ``GateFailed``,
leaves the fact as it was and is tried again by the next start.

Late rows: the watermark is the largest pickup time of all earlier batches less
``delay``.  Rows with an earlier pickup are late; they are taken like all others
(their month is rebuilt) and counted per batch in the ``batches`` table, so none
is dropped silently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.operators import quality
from cordon.operators.fact import PICKUP
from cordon.plans.incremental import MonthlyFact
from cordon.schemas import RAW_PARTITION

BATCHES = "batch long, rows long, late_rows long, months array<string>, watermark timestamp_ntz, top timestamp_ntz"


def batches(spark: SparkSession, root: str) -> DataFrame:
    """(batch, rows, late_rows, months, watermark, top) of the batches taken."""
    try:
        return spark.read.schema(BATCHES).option("recursiveFileLookup", "true").parquet(f"{root}/batches")
    except AnalysisException as e:  # the first batch
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BATCHES)


def stream_fact(spark: SparkSession, landing: str, fact: MonthlyFact, dims: dict[str, DataFrame], checkpoint: str,
                delay: dt.timedelta = dt.timedelta(days=40), max_files_per_trigger: int | None = None) -> DataFrame:
    """Take the new files of ``landing`` (folders ``trip_month=``, columns of
    ``fact.schema``) into ``fact``; returns ``batches``."""
    schema = T.StructType([*fact.schema.fields, T.StructField(RAW_PARTITION, T.StringType())])
    reader = spark.readStream.schema(schema).option("basePath", landing)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def gate(rows: DataFrame) -> None:
        quality.enforce_all([quality.referential_integrity(rows, dims), quality.range_assertions(rows, fact.cfg),
                             quality.duplicate_keys(rows)])

    def take(batch: DataFrame, number: int) -> None:
        (batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(RAW_PARTITION, "batch").parquet(fact.raw_root))
        top = batches(spark, fact.root).filter(F.col("batch") < number).agg(F.max("top")).first()[0]
        line = top - delay if top is not None else None
        seen = batch.agg(F.count(F.lit(1)).alias("rows"), F.max(PICKUP).alias("top"), F.collect_set(RAW_PARTITION).alias("files"),
                         F.count(F.when(F.col(PICKUP) < F.lit(line).cast("timestamp_ntz"), 1)).alias("late")).first()
        months = fact.update(sorted(seen.files), gate)
        row = (number, seen.rows, seen.late, months, line, max(x for x in (seen.top, top) if x is not None) if seen.top or top else None)
        spark.createDataFrame([row], BATCHES).coalesce(1).write.mode("overwrite").parquet(f"{fact.root}/batches/{number}")

    run = (reader.parquet(landing).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    return batches(spark, fact.root)
