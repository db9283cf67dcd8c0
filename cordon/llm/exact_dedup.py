"""Exact de-duplication as a stateful stream (DataFrame and Structured
Streaming only).

The documents flow through a streaming aggregation keyed by the SHA-256 of the
text.  Its state lives in RocksDB (on disk, under the stream's checkpoint in
``spark.checkpoint.dir``), has no watermark and never expires, and holds per
digest: the stable identifier that stays (largest doc_id, with the place of its
row), the number of copies and a content locator, the place of the row that
holds the bytes.  A place is a 64-bit hash of a row's file and its index there,
the same in the stream and in a later read of the table.  A restarted stream
goes on from its checkpoint; files that arrive later only add to it.
Afterwards the state is read back as a table.

A digest seen before is a hit.  Full bytes are checked on every hit: the
distinct texts under a digest (combined before the shuffle, so a digest that
holds a third of all rows is no hot task) are compared with the located one; a
text that is not found at the locator is a collision, and the rows of such a
digest are regrouped by the whole text.

Defined cases: a null text counts as empty; repeated rows are copies, and of
rows that repeat the largest doc_id one stays; among rows with a null doc_id
only, keep_id is null and one of them stays; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.llm.common import written
from cordon.plans.scratch import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Session settings of the state store while the stream runs: state on disk,
#: and no space allocated beforehand in its many small files.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: The place of a row: a hash of its file and its index in it.
PLACE = "xxhash64(_metadata.file_path, _metadata.row_index)"


def _keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.expr(PLACE).alias("place"), body.alias("text"), F.sha2(body, 256).alias("text_sha256"))


def _kept(rows):
    """The largest doc_id and the place of one of its rows."""
    return F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place"))).alias("keep")


def as_pattern(path: str) -> str:
    """A file pattern that matches exactly ``path``."""
    plain = "".join("\\" + c if c in "\\*?[]{}" else c for c in path[:-1])
    return f"{plain}[{path[-1]}]" if path[-1].isalnum() else f"{plain}\\{path[-1]}*"


def stream_state(spark: SparkSession, path: str, checkpoint: str | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """Run the keyed stream over the files at ``path`` until all are taken and
    return its state: (text_sha256, keep_id, keep_place, n, locator).
    ``checkpoint`` names the folder of an earlier run to go on from."""
    reader = spark.readStream.schema("doc_id long, text string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a pattern that matches the path itself: a table may be one file or a folder
    arriving = _keyed(reader.parquet(as_pattern(path)))
    state = arriving.groupBy("text_sha256").agg(
        _kept(arriving), F.count("*").alias("n"), F.min("place").alias("locator"))
    checkpoint = checkpoint or scratch_path(spark, "exact-dedup")
    before = {k: spark.conf.get(k, None) for k in STORE}
    try:
        for k, v in STORE.items():
            spark.conf.set(k, v)
        run = (state.writeStream.format("noop").outputMode("update")
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kept = spark.read.format("statestore").load(checkpoint)
    value = kept.schema["value"].dataType.names
    keep, n, locator = (F.col("value").getField(v) for v in value)
    return kept.select(F.col("key.text_sha256").alias("text_sha256"), keep.getField("keep_id").alias("keep_id"),
                       keep.getField("keep_place").alias("keep_place"), n.alias("n"), locator.alias("locator"))


def collided(keyed: DataFrame, state: DataFrame) -> DataFrame:
    """Digests under which a text differs from the located one: (text_sha256)."""
    hits = state.filter("n > 1").select("text_sha256", "locator")
    texts = (keyed.join(hits.select("text_sha256"), "text_sha256", "left_semi")
             .groupBy("text_sha256", "text").agg(F.min("place").alias("place")))
    return (texts.join(hits, "text_sha256").filter("place <> locator").select("text_sha256").distinct())


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """One row per row of the table at ``path``: doc_id, keep_id, group_size,
    kept, text_sha256."""
    d = _keyed(spark.read.schema("doc_id long, text string").parquet(as_pattern(path)))
    state = written(stream_state(spark, path, checkpoint, files_per_batch), "exact-dedup-state")
    bad = written(collided(d, state), "exact-dedup-collided")
    good = state.join(bad, "text_sha256", "left_anti")
    plain = (d.select("doc_id", "place", "text_sha256").join(good, "text_sha256")
             .select("doc_id", "place", "keep_id", "keep_place", F.col("n").alias("group_size"), "text_sha256"))
    apart = d.join(bad, "text_sha256", "left_semi")
    groups = apart.groupBy("text_sha256", "text").agg(_kept(apart), F.count("*").alias("group_size"))
    split = (apart.join(groups, ["text_sha256", "text"])
             .select("doc_id", "place", "keep.keep_id", "keep.keep_place", "group_size", "text_sha256"))
    return plain.unionByName(split).select(
        "doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
