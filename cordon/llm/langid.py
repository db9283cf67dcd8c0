"""Language identification by prediction by partial matching (PPM).

Per language, a context tree over bytes (orders 0 to 3) holds how often each
byte followed each context.  Code lengths use method C escapes: in a context
seen n times with d distinct successors, a byte seen c times costs
-log2(c / (n + d)); an unseen byte pays the escape -log2(d / (n + d)) and is
coded in the next shorter context, at last among 256 equal bytes.  The
statistics are frozen, so the cost of every (context, byte, language) is known
beforehand, and the language with the shortest total code wins.

Counts come from a bounded sample (``cap`` documents per language), summed in
Spark.  The trees are stored sparsely and whole: one cost for every (context,
byte) that a language has seen, one escape cost for every context that it has
seen.  So the broadcast model grows with what the sample holds, not with the
number of languages times all contexts.  In a chunk of texts the costs of its
distinct (three bytes, byte) runs are worked out once, order by order, for all
languages; every byte of a text then takes its run's costs.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without training rows everything is ``und``; equal code lengths go to the
language first in order; rows that repeat are predicted each; empty tables give
empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import crc32_mod, map_arrow
from cordon.llm.sampling import bounded

CAP = 1500
HELD_OUT = (5, 0)
ORDER = 3
_PAD = "\n" * ORDER


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with the start context before every row, first byte, end) of rows."""
    column = column.fill_null("").cast(pa.large_string())
    data, at = tb.text_bytes(pc.binary_join_element_wise(pa.scalar(_PAD, pa.large_string()), column,
                                                         pa.scalar("", pa.large_string())))
    return data, at[:-1] + ORDER, at[1:]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): counts of (three context bytes, byte), packed in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch):
                lang = part.column("lang").to_pylist()
                data, lo, hi = _padded(part.column("text"))
                b = data.astype(np.int64)
                gram = np.zeros(len(b), np.int64)
                for k in range(ORDER + 1):
                    gram[ORDER:] |= b[k:len(b) - ORDER + k] << (8 * (ORDER - k))
                own = np.repeat(np.arange(len(lo)), hi - lo)
                body = np.ones(len(b), bool)
                for k in range(ORDER):
                    body[lo - ORDER + k] = False
                names = sorted(set(lang))
                code = np.array([names.index(x) for x in lang])[own]
                key, n = np.unique((code << 32) | gram[body], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[c] for c in key >> 32], pa.string()), pa.array(key & 0xFFFFFFFF), pa.array(n)],
                    ["lang", "gram", "n"])

    counted = map_arrow(docs.select("lang", "text"), run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Costs:
    """Sparse costs by key and language, in order of keys."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, cost: np.ndarray):
        order = np.lexsort((lang, key))
        self.keys, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key)).astype(np.int64)
        self.lang, self.cost = lang[order].astype(np.int32), cost[order].astype(np.float32)
        self.keys = self.keys.astype(np.uint32)

    def of(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in ``key``, language, cost) of all that is stored for them."""
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = np.flatnonzero(self.keys[at] == key) if len(self.keys) else np.zeros(0, np.int64)
        lo, n = self.first[at[known]], np.diff(self.first)[at[known]]
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(known, n), self.lang[entry], self.cost[entry]

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.keys, self.first, self.lang, self.cost))


class ContextTrees:
    """Frozen costs of all languages, by order: of the bytes seen after a
    context and of the escape from it."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        self.coded: list[_Costs] = []
        self.escaped: list[_Costs] = []
        lang, gram, n = lang.astype(np.int64), gram.astype(np.int64), n.astype(np.int64)
        for order in range(ORDER + 1):
            key = (lang << 32) | (gram & ((1 << (8 * (order + 1))) - 1))
            key, own = np.unique(key, return_inverse=True)
            count = np.bincount(own, n, len(key))
            context, of = np.unique((key >> 32 << 32) | ((key & 0xFFFFFFFF) >> 8), return_inverse=True)
            total, distinct = np.bincount(of, count, len(context)), np.bincount(of, minlength=len(context))
            self.coded.append(_Costs(key & 0xFFFFFFFF, key >> 32, np.log2((total + distinct)[of] / count)))
            self.escaped.append(_Costs(context & 0xFFFFFFFF, context >> 32, np.log2((total + distinct) / distinct)))

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (*self.coded, *self.escaped))

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of every run (three bytes, byte) under every language."""
        bits = np.full((len(gram), len(self.langs)), 8.0, np.float32)
        for order in range(ORDER + 1):
            key = gram & np.uint32((1 << (8 * (order + 1))) - 1)
            at, lang, cost = self.escaped[order].of(key >> np.uint32(8))
            bits[at, lang] += cost
            at, lang, cost = self.coded[order].of(key)
            bits[at, lang] = cost
        return bits

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits of every row under every language."""
        data, lo, hi = _padded(column)
        if len(data) <= ORDER:
            return np.zeros((len(column), len(self.langs)))
        b = data.astype(np.uint32)
        gram = np.zeros(len(b) - ORDER, np.uint32)
        for k in range(ORDER + 1):
            gram |= b[k:len(b) - ORDER + k] << np.uint32(8 * (ORDER - k))
        runs, at = np.unique(gram, return_inverse=True)
        return tb.row_sums(self.costs(runs)[at], lo - ORDER, hi - ORDER)


def train(docs: DataFrame, cap: int = CAP) -> ContextTrees | None:
    m, out = HELD_OUT
    rows = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
        & (crc32_mod(F.col("doc_id"), m) != out))
    got = gram_counts(bounded(rows, "lang", cap)).toPandas()
    if not len(got):
        return None
    langs = sorted(got["lang"].unique())
    code = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    return ContextTrees(langs, code, got["gram"].to_numpy(), got["n"].to_numpy())


def predict(docs: DataFrame, model: ContextTrees | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        names = np.array([*trees.langs, "und"], dtype=object)
        for batch in batches:
            for part in tb.chunks(batch, limit=1 << 18):
                bits = trees.code_lengths(part.column("text"))
                best = bits.argmin(1)
                weight = np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000.0))
                p = 1.0 / weight.sum(1)
                letters = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
                best, p = np.where(letters, best, len(trees.langs)), np.where(letters, p, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(p)],
                    ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    has = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    return map_arrow(docs.select("doc_id", "text", has), run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    m, out = HELD_OUT
    p = predict(docs, train(docs))
    return p.select("doc_id", (crc32_mod(F.col("doc_id"), m) == out).alias("held_out"), "lang_pred", "score")
