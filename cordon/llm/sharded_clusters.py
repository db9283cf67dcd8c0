"""Centroid clustering by dimension-sharded Lloyd rounds, in exact integers.

Vectors are cut into column blocks.  A cell is the part of one chunk of vectors
that lies in one block; cells are written with a folder per block, so a task
reads the columns of its block only.  A round is one Spark job:

* block tasks compute the exact squared distances of their cells to the
  centroids' slices of that block;
* partial distances are reduced by chunk: the blocks are added up and the first
  least centroid is taken (a group is one chunk, its size is bounded by the
  chunk and the number of blocks, whatever the data);
* the assignments (one or two bytes a vector) go back to the cells, which add
  up their vectors per centroid, and every block's slice becomes the floors of
  its means.

The driver holds the centroids only.  Every round starts from the written
cells, so lineage does not grow and a lost executor costs one round's tasks.

Defined cases: vectors that are null, hold a null, NaN or infinite component or
have another number of components are dropped; rows that repeat a vec_id are
vectors of their own (as starts, the lesser vector first); a null vec_id is
clustered but never starts a centroid; with fewer vectors than centroids there
are fewer centroids, with none to start from an empty table results; further columns are
ignored; components of 2^27 / scale or more in size end the job with an error,
as 64 bits cannot hold their distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.llm.common import map_arrow, ship, written
from cordon.llm.vectors import finite, integers, squared_distances
from cordon.plans.scratch import scratch_path

CLUSTERS = 8
COMPONENTS = 64
ROUNDS = 10
SCALE = 1024
#: Columns of a block and vectors of a chunk.
BLOCK = 16
CHUNK = 4096
SALT = "3:"

CELLS = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("rows", T.IntegerType()),
                      T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType()),
                      T.StructField("block", T.IntegerType())])


def usable(vectors: DataFrame, vector: str, components: int) -> DataFrame:
    return vectors.filter(finite(vector) & (F.size(vector) == components)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def start(rows: DataFrame, clusters: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids."""
    seeds = (rows.filter("vec_id is not null")
             .orderBy(F.sha2(F.concat(F.lit(SALT), F.col("vec_id").cast("string")), 256), "vector")
             .select("vector").limit(clusters).collect())
    return integers(pa.array([r.vector for r in seeds], pa.list_(pa.float64())),
                    len(seeds[0].vector) if seeds else 1, scale)


def write_cells(rows: DataFrame, components: int, scale: int, block: int, chunk: int) -> DataFrame:
    """(chunk, rows, ids, data, block), a folder per block; ``ids`` are with the first block."""
    schema = pa.schema([("chunk", pa.int64()), ("rows", pa.int32()), ("ids", pa.list_(pa.int64())),
                        ("data", pa.binary()), ("block", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk):
                part = batch.slice(lo, chunk)
                x = integers(part.column("vector"), components, scale).astype("<i4")
                cuts = range(0, components, block)
                ids = [part.column("vec_id").to_pylist(), *[None] * (len(cuts) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made] * len(cuts)), pa.array([len(x)] * len(cuts), pa.int32()),
                     pa.array(ids, pa.list_(pa.int64())), pa.array([x[:, c:c + block].tobytes() for c in cuts], pa.binary()),
                     pa.array(range(len(cuts)), pa.int32())], schema=schema)
                made += 1

    path = scratch_path(rows.sparkSession, "cluster-cells")
    map_arrow(rows, run, CELLS).write.partitionBy("block").parquet(path)
    return rows.sparkSession.read.schema(CELLS).parquet(path)


def _slices(centroids: np.ndarray, block: int) -> list[np.ndarray]:
    return [centroids[:, c:c + block] for c in range(0, centroids.shape[1], block)]


def _cell(row_count: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(row_count, -1).astype(np.int64)


def partial_distances(cells: DataFrame, centroids: np.ndarray, block: int, with_ids: bool) -> DataFrame:
    """(chunk, rows, ids, part): distances of a cell's vectors to the slices of its block."""
    slices = _slices(centroids, block)
    schema = pa.schema([("chunk", pa.int64()), ("rows", pa.int32()), ("ids", pa.list_(pa.int64())), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                x = _cell(own.column("rows")[0].as_py(), own.column("data")[0].as_py())
                d = squared_distances(x, slices[own.column("block")[0].as_py()])
                small = "<i4" if not d.size or d.max() < 1 << 31 else "<i8"
                ids = own.column("ids") if with_ids else pa.nulls(1, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [own.column("chunk"), own.column("rows"), ids, pa.array([d.astype(small).tobytes()], pa.binary())],
                    schema=schema)

    need = cells if with_ids else cells.withColumn("ids", F.lit(None).cast("array<long>"))
    return map_arrow(need, run, "chunk long, rows int, ids array<long>, part binary")


def _added(table: pa.Table, clusters: int) -> np.ndarray:
    """Distances of one chunk, all blocks added."""
    rows = table.column("rows")[0].as_py()
    total = np.zeros((rows, clusters), np.int64)
    for part in table.column("part"):
        data = part.as_py()
        total += np.frombuffer(data, "<i4" if len(data) == 4 * total.size else "<i8").reshape(rows, clusters)
    return total


def assignments(parts: DataFrame, clusters: int) -> DataFrame:
    """(chunk, own): the nearest centroid of every vector of a chunk."""
    kind = "<u1" if clusters <= 256 else "<u4"

    def add(table: pa.Table) -> pa.Table:
        own = _added(table, clusters).argmin(1).astype(kind)
        return pa.table({"chunk": table.column("chunk")[:1], "own": pa.array([own.tobytes()], pa.binary())})

    ship(parts.sparkSession)
    return parts.groupBy("chunk").applyInArrow(add, "chunk long, own binary")


def next_centroids(cells: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """One round: assign every vector, then move the centroids that have vectors."""
    clusters, width = len(centroids), centroids.shape[1]
    own = assignments(partial_distances(cells, centroids, block, False), clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        n: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                x = _cell(r["rows"], r["data"])
                to = np.frombuffer(r["own"], "<u1" if clusters <= 256 else "<u4").astype(np.int64)
                b = r["block"]
                if b not in total:
                    total[b], n[b] = np.zeros((clusters, x.shape[1]), np.int64), np.zeros(clusters, np.int64)
                np.add.at(total[b], to, x)
                n[b] += np.bincount(to, minlength=clusters)
        for b, t in total.items():
            c = np.flatnonzero(n[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b] * len(c), pa.int32()), pa.array(c, pa.int32()), pa.array(n[b][c]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * t.shape[1]),
                                          pa.array(t[c].ravel()))], ["block", "cluster", "n", "total"])

    placed = cells.select("chunk", "rows", "data", "block").join(own, "chunk").drop("chunk")
    sums = (map_arrow(placed, run, "block int, cluster int, n long, total array<long>")
            .select("block", "cluster", "n", F.posexplode("total").alias("at", "v"))
            .groupBy("block", "cluster", "at")
            .agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("v")))
    moved = sums.select("block", "cluster", "at", F.expr("CAST((v - pmod(v, n)) div n AS BIGINT)").alias("c"))
    out = centroids.copy()
    for r in moved.collect():  # one number for each of the centroids
        out[r.cluster, r.block * block + r["at"]] = r.c
    assert out.shape == (clusters, width)
    return out


def placed_vectors(cells: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    clusters = len(centroids)

    def add(table: pa.Table) -> pa.Table:
        total = _added(table, clusters)
        own = total.argmin(1)
        ids = next(x.as_py() for x in table.column("ids") if x.is_valid)
        return pa.table({"vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(own, pa.int32()),
                         "distance": pa.array(total[np.arange(len(own)), own])})

    ship(cells.sparkSession)
    return (partial_distances(cells, centroids, block, True).groupBy("chunk")
            .applyInArrow(add, "vec_id long, cluster int, distance long"))


def cluster(vectors: DataFrame, vector: str = "embedding", clusters: int = CLUSTERS, components: int = COMPONENTS,
            rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256."""
    spark = vectors.sparkSession
    rows = usable(vectors, vector, components)
    centroids = start(rows, clusters, scale)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    cells = write_cells(rows, components, scale, block, chunk)
    for _ in range(rounds):
        centroids = next_centroids(cells, centroids, block)
    out = written(placed_vectors(cells, centroids, block), "clusters")
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # one for each centroid
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, s, sum(sums.values()), sha[c]) for c, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(clusters: int = CLUSTERS, components: int = COMPONENTS, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, one table for every round."""
    sql = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {components}
    AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
), c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, x
  FROM (SELECT sha256('{SALT}' || vec_id) AS h, x FROM v ORDER BY h LIMIT {clusters})
)"""
    for r in range(rounds + 1):
        sql += f""", a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(x) AS x, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT v.vec_id, v.x, c.c,
               list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM v, c{r} c) GROUP BY vec_id
)"""
        if r < rounds:
            sql += f""", m{r} AS (
  SELECT c, list(m ORDER BY i) AS x
  FROM (SELECT c, i, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
        FROM (SELECT best.c AS c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c
), c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (c)
)"""
    return sql + f"""
SELECT a.vec_id, c.c::INT AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY c.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best.c
"""


ORACLE = oracle()
