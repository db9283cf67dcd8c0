"""Monthly ingest as a Structured Streaming job (streaming form of S11).

The landing folder is a file source; each run processes only files not yet
recorded in the checkpoint (``trigger(availableNow=True)``) and appends them
to the raw store through the file sink, which commits exactly once per
batch.  Running it again with the same checkpoint adds nothing, and a run
that dies mid-way resumes from the checkpoint - the streaming counterpart of
``ingest_pending``.

Months may store a column in different physical types; months of one physical
schema are one stream with a checkpoint and a folder of its own in the store,
and every stream casts to the declared types.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cordon.schemas import RAW_PARTITION, RAW_TRIPS
from cordon.sources.raw import conform_read, month_schemas, read_raw_trips


def stream_ingest(spark: SparkSession, landing: str, store: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Take the new files of ``landing``; returns all rows of its schemas that
    the store has."""
    out = None
    for own, months in month_schemas(spark, landing):
        schema = T.StructType([*own.fields, T.StructField(RAW_PARTITION, T.StringType())])
        name = hashlib.md5(own.json().encode()).hexdigest()[:12]
        reader = spark.readStream.schema(schema).option("basePath", landing)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        src = reader.parquet(f"{landing}/{RAW_PARTITION}={{{','.join(months)}}}")
        q = (conform_read(src, RAW_TRIPS)
             .writeStream
             .format("parquet")
             .option("checkpointLocation", f"{checkpoint}/{name}")
             .option("path", f"{store}/{name}")
             .partitionBy(RAW_PARTITION)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
        rows = read_raw_trips(spark, f"{store}/{name}", uniform=True)
        out = rows if out is None else out.unionByName(rows)
    return out
