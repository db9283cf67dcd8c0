"""Vector code compression: product quantisation in exact integers by
limb-split matrix products.

Components become floor(scale * x); a vector is cut into ``parts`` equal parts.
A codebook of every part position starts as the parts of the ``entries``
smallest vec_ids.  A round is one pass over the vectors: each task computes the
squared distances of its parts to the codebook by exact limb-split products
(``vectors.exact_dot``), takes the first least one, and returns the sums and
counts of its parts per entry; Spark adds them up, and the driver gets the sums
of the codebook entries only (parts x entries x part width numbers) and makes
the floors of the means.  The last pass writes codes and errors.  Vectors are
never shuffled; the errors of a label are summed map-side first.

Defined cases: vectors that are null or hold a null, NaN or infinite component
are dropped; a vector whose length is no positive multiple of ``parts``, or not
that of the smallest vec_id that has such a length, has no code and no error
(both null) and its row stays; a null vec_id is coded but never starts an
entry; of rows that repeat a vec_id the lesser vector comes first as a start,
and all of them are coded; with fewer vectors than entries the codebook is
shorter; null labels count as one label, whose error is null where no row has
one; an empty table gives an empty table; further columns are ignored;
components of 2^27 / scale or more in size end the job with an error, as 64
bits cannot hold their distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.common import map_arrow, null_safe, written
from cordon.llm.vectors import finite, integers, squared_distances

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vector, label) of the finite vectors."""
    return vectors.filter(finite(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), "label")


def start(rows: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """The first codebooks (part, entry, position); None without a vector to cut."""
    cut = rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = cut.orderBy("vec_id", "vector").select(F.size("vector").alias("width")).first()
    if first is None:
        return None
    seeds = (cut.filter(F.size("vector") == first.width).orderBy("vec_id", "vector").select("vector")
             .limit(entries).collect())  # a codebook
    x = integers(pa.array([r.vector for r in seeds], pa.list_(pa.float64())), first.width, scale)
    return x.reshape(len(x), parts, -1).swapaxes(0, 1).copy()


def nearest(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every vector (rows) and part (columns)."""
    parts, _, width = codebooks.shape
    code = np.empty((len(x), parts), np.int64)
    error = np.empty((len(x), parts), np.int64)
    for p in range(parts):
        d = squared_distances(x[:, p * width:(p + 1) * width], codebooks[p])
        code[:, p] = d.argmin(1)  # the first of equal ones
        error[:, p] = d[np.arange(len(d)), code[:, p]]
    return code, error


def _sums(rows: DataFrame, codebooks: np.ndarray, scale: int) -> DataFrame:
    """(part, entry, n, total): per task, counts and sums of the parts of every entry."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), np.int64)
        n = np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = integers(batch.column("vector"), parts * width, scale)
            code, _ = nearest(x, codebooks)
            for p in range(parts):
                np.add.at(total[p], code[:, p], x[:, p * width:(p + 1) * width])
                n[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * width),
                                      pa.array(total[part, entry].ravel()))], ["part", "entry", "n", "total"])

    return map_arrow(rows.select("vector"), run, "part int, entry int, n long, total array<long>")


def next_codebooks(rows: DataFrame, codebooks: np.ndarray, scale: int) -> np.ndarray:
    """Every used entry becomes the floor of the mean of its parts."""
    summed = (_sums(rows, codebooks, scale).select("part", "entry", "n", F.posexplode("total").alias("at", "v"))
              .groupBy("part", "entry", "at")
              .agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("v")))
    out = codebooks.copy()
    for r in summed.collect():  # one number for each of the codebooks
        out[r.part, r.entry, r["at"]] = int(r.v) // int(r.n)
    return out


def encode(rows: DataFrame, codebooks: np.ndarray, scale: int) -> DataFrame:
    """(vec_id, label, code, error) of vectors of the codebooks' width."""
    parts, _, width = codebooks.shape
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = nearest(integers(batch.column("vector"), parts * width, scale), codebooks)
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error.sum(1))],
                ["vec_id", "label", "code", "error"])

    return map_arrow(rows, run, f"vec_id long, label {label}, code string, error long")


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per finite vector: vec_id, code (two hex digits a part), error,
    label_error, codebooks_sha256."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    if "label" not in vectors.columns:
        vectors = vectors.withColumn("label", F.lit(None).cast("int"))
    rows = usable(vectors, vector)
    books = start(rows, parts, entries, scale)
    if books is None:
        coded, sha = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                 F.lit(None).cast("long").alias("error")), codebooks_sha256(np.zeros(0, np.int64))
    else:
        fits = F.size("vector") == parts * books.shape[2]
        own = rows.filter(fits)
        for _ in range(rounds):
            books = next_codebooks(own, books, scale)
        other = rows.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                          F.lit(None).cast("long").alias("error"))
        coded, sha = encode(own, books, scale).unionByName(other), codebooks_sha256(books)
    coded = written(coded, "vector-codes")
    by_label = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("long")
                                                  .alias("label_error")), "vector-code-labels")
    return null_safe(coded, by_label, ["label"], "left").select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, one table for every round."""
    sql = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
), p AS (
  SELECT vec_id, label, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x
  FROM v, (SELECT unnest(generate_series(0, {parts - 1})) AS part)
), c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})
)"""
    for r in range(rounds + 1):
        sql += f""", a{r} AS MATERIALIZED (
  SELECT vec_id, part, any_value(label) AS label, any_value(x) AS x,
         min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT p.vec_id, p.part, p.label, p.x, c.entry,
               list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM p JOIN c{r} c USING (part)) GROUP BY vec_id, part
)"""
        if r < rounds:
            sql += f""", m{r} AS (
  SELECT part, entry, list(m ORDER BY i) AS x
  FROM (SELECT part, entry, i, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
        FROM (SELECT part, best.entry AS entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r})
        GROUP BY part, entry, i) GROUP BY part, entry
), c{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (part, entry)
)"""
    return sql + f""", e AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
         sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM e
"""


ORACLE = oracle()
