"""Quality scores by hashed word n-grams and logistic regression with
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text are the 1- and 2-grams of its tokens (runs of letters and
digits, runs of other signs; a word that repeats its predecessor becomes one
"again" token) and of the tokens' shapes, hashed into 2**bits weights; a value
is the feature's share of the text.  A score is one sparse dot product.

Fitting takes a bounded sample of labelled rows (``cap`` per label value, dealt
by hash over ``shards`` groups); each group runs FTRL over its rows in one
task, the weights are averaged, and the intercept is moved by the odds by which
the sample differs from all labelled rows.  Groups and model are bounded by these
parameters whatever the size of the corpus; scoring streams over all rows and
shuffles nothing.

Defined cases: null and empty texts have no features and get the score of the
intercept; without any labelled row the score is 0.5; rows that repeat are
scored each; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import crc32_mod, grouped_pandas, map_arrow
from cordon.llm.sampling import labelled_texts

BITS = 18
CAP = 4000
SHARDS = 4
EPOCHS = 3
HELD_OUT = (4, 2)  # rows whose crc32 of doc_id, modulo the first, is the second
THRESHOLD = 0.7
VALUE_SCALE = 16.0

_KIND = tb.class_table(2, space=(0, b" \t\n\r\x0b\x0c"), word=(1, bytes(
    [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])))
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature index, row, number of features per row) of every n-gram."""
    data, at = tb.text_bytes(column)
    kind = _KIND[data]
    start, end, row = tb.tokens(kind, at)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(column), np.int64)
    h = tb.SpanHash(tb.LOWER[data])(start, end)
    k = kind[start]
    same_row = row[1:] == row[:-1]
    again = np.zeros(len(h), bool)
    again[1:] = same_row & (h[1:] == h[:-1]) & (k[1:] == 1)
    ups = np.concatenate([[0], np.cumsum(_UPPER[data])])
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    n_up, n_dig, length = ups[end] - ups[start], digits[end] - digits[start], end - start
    shape = np.select([again, k == 2, n_dig == length, (n_up == length) & (length > 1), n_up > 0],
                      [1, 2 + np.minimum(length, 4), 7, 8, 9], 10).astype(np.uint64)
    h = np.where(again, np.uint64(1), h)

    def pair(x):
        return tb.mix(x[:-1] * np.uint64(3) + tb.mix(x[1:]))[same_row]

    hashed = [h, pair(h), tb.mix(shape + np.uint64(99)), pair(shape + np.uint64(999))]
    rows = [row, row[1:][same_row], row, row[1:][same_row]]
    index = (np.concatenate(hashed) >> np.uint64(64 - bits)).astype(np.int64)
    row = np.concatenate(rows)
    return index, row, np.bincount(row, minlength=len(column))


class Ftrl:
    """FTRL-proximal logistic regression; the last weight is the intercept."""

    def __init__(self, size: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.05):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _fit(rows: pd.DataFrame, bits: int, epochs: int) -> np.ndarray:
    rows = rows.sort_values("doc_id", kind="stable")
    model, vectors = Ftrl(1 << bits), []
    for lo in range(0, len(rows), 200):
        part = rows.iloc[lo:lo + 200]
        index, row, n = features(pa.array(part["text"], pa.large_string()), bits)
        order = np.argsort(row, kind="stable")
        for own, y in zip(np.split(index[order], np.cumsum(n)[:-1]), part["label"], strict=True):
            at, c = np.unique(own, return_counts=True)
            vectors.append((np.append(at, 1 << bits), np.append(VALUE_SCALE * c / max(len(own), 1), 1.0), float(y)))
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(vectors)):
            model.update(*vectors[i])
    return model.weights()


def train(docs: DataFrame, labels: DataFrame, cap: int = CAP, shards: int = SHARDS, bits: int = BITS,
          epochs: int = EPOCHS) -> np.ndarray | None:
    """The averaged weights, or None without labelled rows."""
    m, out = HELD_OUT
    rows, shift = labelled_texts(docs, labels, "quality", crc32_mod(F.col("doc_id"), m) != out, cap)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"w": [_fit(part, bits, epochs).astype(np.float32).tobytes()]})

    got = grouped_pandas(rows.groupBy("shard"), docs.sparkSession, fit, "w binary").collect()
    if not got:
        return None
    w = np.mean([np.frombuffer(r.w, np.float32) for r in got], axis=0)
    w[-1] += shift
    return w


def score(docs: DataFrame, weights: np.ndarray | None, bits: int = BITS) -> DataFrame:
    """(doc_id, score) of every row."""
    if weights is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            for part in tb.chunks(batch):
                index, row, n = features(part.column("text"), bits)
                total = np.bincount(row, w[index], minlength=part.num_rows)
                logit = w[-1] + VALUE_SCALE * total / np.maximum(n, 1)
                p = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    m, out = HELD_OUT
    s = score(docs, train(docs, labels))
    return s.select("doc_id", (crc32_mod(F.col("doc_id"), m) == out).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
