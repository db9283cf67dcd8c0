"""Token ids as packed binary matrices.

Whole texts are tokenised and closed by one end id; documents longer than a row
are split without loss.  Pieces are packed best fit decreasing: a segment tree
over the free capacities finds the tightest row that still holds a piece.  A
record is one matrix row: the ids (little-endian, two bytes where the vocabulary
allows it, padded to the row length), the cumulative segment lengths, and the
position at which the position ids restart for each segment, with each
segment's document and its place in it.

Rows are packed inside the task that reads them, from a buffer of bounded size,
so nothing is shuffled, memory is bounded, and a lost task is simply run again;
a row's id is made from the input partition and a count, so it is the same then.

Defined cases: null and empty texts are one id (the end id); repeated rows are
packed each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import map_arrow
from cordon.llm.tokens import largest_id, token_ids

CONTEXT = 2048
END_ID = 50256
BUFFER_TOKENS = 2_000_000
SCHEMA = ("sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "segment_doc_ids array<long>, segment_starts array<long>")


class CapacityTree:
    """How many open rows have each free capacity; finds the smallest capacity
    in use that is at least a given one."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, least: int) -> int:
        """-1 if no row has room."""
        count, i = self.count, least + self.size
        if count[i]:
            return least
        while i > 1:  # up to a right neighbour in use, then down its left edge
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, context: int) -> list[list[int]]:
    """Indexes of the pieces of every row."""
    tree, open_rows, rows = CapacityTree(context), [[] for _ in range(context + 1)], []
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        free = tree.tightest(n)
        if free < 0:
            rows.append([int(i)])
            r, free = len(rows) - 1, context
        else:
            tree.add(free, -1)
            r = open_rows[free].pop()
            rows[r].append(int(i))
        if free > n:
            open_rows[free - n].append(r)
            tree.add(free - n, 1)
    return rows


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def pack_token_ids(docs: DataFrame, context: int = CONTEXT, end_id: int = END_ID, vocabulary: str | None = None,
                   buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """The matrix rows of ``docs`` (schema ``SCHEMA``); padding repeats the end
    id.  The width of an id follows the largest id of the vocabulary and ``end_id``."""
    kind = id_type(max(largest_id(vocabulary), end_id) + 1)
    arrow = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()),
                       ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
                       ("segment_doc_ids", pa.list_(pa.int64())), ("segment_starts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = token_ids(vocabulary), np.array([end_id], "<u4").tobytes()
        base, made = TaskContext.get().partitionId() << 40, 0
        held: list[tuple] = []  # (doc, start, ids)
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held, n_held
            length = np.array([len(x[2]) for x in held])
            cols: list[list] = [[] for _ in arrow]
            for own in best_fit_decreasing(length, context):
                parts = [held[i] for i in own]
                ids = np.full(context, end_id, kind)
                ends = np.cumsum(length[own])
                ids[:ends[-1]] = np.concatenate([x[2] for x in parts])
                row = (base + made, int(ends[-1]), ids.tobytes(), [0, *ends], [0, *ends[:-1]],
                       [x[0] for x in parts], [x[1] for x in parts])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
                made += 1
            held, n_held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)],
                                              schema=arrow)

        for batch in batches:
            for part in tb.chunks(batch):
                ids = encoder.encode(part.column("text").to_pylist())
                for doc, body in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    own = np.frombuffer(body + end, "<u4").astype(kind)
                    for lo in range(0, len(own), context):
                        held.append((doc, lo, own[lo:lo + context]))
                    n_held += len(own)
                    if n_held >= buffer_tokens:
                        yield flush()
        if held:
            yield flush()

    return map_arrow(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), run, SCHEMA)


def write_matrices(rows: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write matrix rows as Parquet with the type of an id (``id_type``, for
    ``numpy.frombuffer``) in every row; returns the written table."""
    kind = id_type(max(largest_id(vocabulary), end_id) + 1)
    rows.withColumn("id_type", F.lit(kind)).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def read_matrix(ids: bytes, kind: str) -> np.ndarray:
    """The ids of one row."""
    return np.frombuffer(ids, kind)
