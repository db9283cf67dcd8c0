"""Toxicity by a linear-chain conditional random field (CRF).

The chain tags every token (a run of letters and digits) as ordinary or toxic.
A token's emission weight is the sum of hashed features (the word, its first
4 to 6 bytes, the word before, the word after); two by two transition weights
link neighbours.  Forward-backward gives each token its marginal probability.
A document's score is a logistic function of the log of its expected number of
toxic tokens (marginals under a floor left out), so length alone adds nothing;
neighbouring tokens with a marginal of one half or more form the offending
spans, given as character offsets.

Labelled tokens: labels mark documents only.  On the training sample, a word or
word beginning that is concentrated in toxic documents beyond chance (binomial
likelihood ratio) marks its tokens there as toxic; the CRF is fitted on these
token labels and generalises them by its other features.

Fitting takes a bounded sample of labelled rows (``cap`` per label value) in one
task, with features hashed into 2**BITS weights; both bounds are parameters and
do not grow with the corpus.  Rows are independent chains, so the fit goes over
the sample in chunks of bounded bytes and holds only 48 bytes of hashes a token,
later 24 of feature numbers.  Scoring streams over all rows, in such chunks too,
and shuffles nothing.  The recurrences of forward-backward run over many lanes
of the token stream at once; a first pass multiplies each lane's matrices, so
the result is exact whatever the lane borders.

Defined cases: texts without tokens (null, empty, only signs) have score 0 and
no spans; without labelled rows of both kinds every score is 0; rows that
repeat are scored each; empty tables give empty results; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import crc32_mod, grouped_pandas, map_arrow
from cordon.llm.sampling import labelled_texts

BITS = 18
CAP = 2000
EPOCHS = 20
HELD_OUT = (5, 0)
THRESHOLD = 0.5
BEGINNINGS = (4, 5, 6)
FLOOR = 0.2
LANES = 1024
SLICE_TOKENS = 1 << 17

_KIND = tb.class_table(0, word=(1, bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])))


def token_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features x tokens hashes, row, start byte, end byte)."""
    data, at = tb.text_bytes(column)
    start, end, row = tb.tokens(_KIND[data], at)
    h = tb.SpanHash(tb.LOWER[data])
    word = h(start, end, 1)
    own = [word, *[h(start, np.minimum(end, start + k), 10 + k) for k in BEGINNINGS]]
    before, after = np.zeros_like(word), np.zeros_like(word)
    if len(word):
        same = row[1:] == row[:-1]
        before[1:] = np.where(same, word[:-1], 0)
        after[:-1] = np.where(same, word[1:], 0)
    own += [tb.mix(before + np.uint64(101)), tb.mix(after + np.uint64(202))]
    return np.array(own, np.uint64).reshape(len(own), -1), row, start, end


def sample_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[slice, slice]]]:
    """(features x tokens hashes, row) of all texts, and the chunks of whole
    rows that they were made in, as slices of the tokens and of the rows."""
    chunks = [c.column("text") for c in tb.chunks(pa.RecordBatch.from_arrays([texts], ["text"]))]
    ends = [0]
    for data, at in map(tb.text_bytes, chunks):
        ends.append(ends[-1] + len(tb.tokens(_KIND[data], at)[0]))
    row_ends = np.cumsum([0, *map(len, chunks)]).tolist()
    parts = [(slice(*t), slice(*r)) for t, r in zip(pairwise(ends), pairwise(row_ends))]
    hashes, row = np.empty((3 + len(BEGINNINGS), ends[-1]), np.uint64), np.empty(ends[-1], np.int32)
    for chunk, (own, rows) in zip(chunks, parts):
        hashes[:, own], row[own] = token_features(chunk)[:2]
        row[own] += rows.start
    return hashes, row, parts


def _index(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _chain(odds: np.ndarray, reset: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Normalised forward vectors (tokens x 2) of the chain that starts anew
    at every ``reset``; ``odds`` are the emission odds of state 1."""
    n = len(odds)
    steps = -(-n // LANES)
    size = steps * LANES
    o = np.ones(size)
    o[:n] = odds
    r = np.zeros(size, bool)
    r[:n] = reset
    o, r = o.reshape(LANES, steps).T, r.reshape(LANES, steps).T
    # coefficients: next[j] = emission[j] * sum_i coef[i, j] * now[i]
    c = [[np.where(r, begin[j], trans[i, j]) for j in (0, 1)] for i in (0, 1)]
    # each lane's product of matrices, from both unit vectors
    u = [(np.ones(LANES), np.zeros(LANES)), (np.zeros(LANES), np.ones(LANES))]
    for t in range(steps):
        nxt = [(x * c[0][0][t] + y * c[1][0][t], (x * c[0][1][t] + y * c[1][1][t]) * o[t]) for x, y in u]
        scale = 1.0 / (nxt[0][0] + nxt[0][1] + nxt[1][0] + nxt[1][1])
        u = [(x * scale, y * scale) for x, y in nxt]
    x, y = np.empty(LANES), np.empty(LANES)
    a, b = 0.5, 0.5
    for lane in range(LANES):
        x[lane], y[lane] = a, b
        a, b = a * u[0][0][lane] + b * u[1][0][lane], a * u[0][1][lane] + b * u[1][1][lane]
        a, b = a / (a + b), b / (a + b)
    out = np.empty((2, steps, LANES))
    for t in range(steps):
        x, y = x * c[0][0][t] + y * c[1][0][t], (x * c[0][1][t] + y * c[1][1][t]) * o[t]
        scale = 1.0 / (x + y)
        x, y = x * scale, y * scale
        out[0, t], out[1, t] = x, y
    return out.transpose(2, 1, 0).reshape(size, 2)[:n]


def _first_of_row(row: np.ndarray) -> np.ndarray:
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return first


def marginals(emission: np.ndarray, row: np.ndarray, trans: np.ndarray, begin: np.ndarray,
              pairs: bool = False):
    """P(state 1) of every token; with ``pairs`` also the expected transitions
    (2 x 2 sums) and P(state 1) of first tokens."""
    n = len(emission)
    if not n:
        return (np.zeros(0), np.zeros((2, 2)), np.zeros(0)) if pairs else np.zeros(0)
    odds, e_trans, e_begin = np.exp(np.clip(emission, -30, 30)), np.exp(trans), np.exp(begin)
    first = _first_of_row(row)
    last = np.append(first[1:], True)
    alpha = _chain(odds, first, e_trans, e_begin)
    # backward: emission-weighted beta is the chain of the reversed stream
    back = _chain(odds[::-1], last[::-1], e_trans.T, np.ones(2))[::-1]  # ~ emission * beta
    beta = back / np.stack([np.ones(n), odds], 1)
    both = alpha * beta
    p = both[:, 1] / both.sum(1)
    if not pairs:
        return p
    link = ~last[:-1]
    joint = alpha[:-1, :, None] * e_trans[None] * back[1:, None, :]
    joint = joint[link]
    joint /= joint.sum((1, 2), keepdims=True)
    return p, joint.sum(0), p[first]


def _evidence(hashes: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which tokens count as labelled toxic (word and beginnings of the first
    rows of ``hashes``; ``toxic`` by row).  Values are taken in slices by their
    top bits, each with all its tokens, so that sorting needs little memory."""
    base = max(toxic.mean(), 1e-6)
    mark = np.zeros(len(row), bool)
    bits = np.uint64(max(1, (len(row) // SLICE_TOKENS).bit_length()))
    for own in hashes[:1 + len(BEGINNINGS)]:
        for top in range(1 << int(bits)):
            at = np.flatnonzero(own >> (np.uint64(64) - bits) == top)
            h = own[at]
            values, code = np.unique(h, return_inverse=True)
            # one vote per word before it: copies of a document are no new evidence
            _, one = np.unique(tb.mix(h + np.uint64(7)) ^ hashes[-2, at], return_index=True)
            hits = np.bincount(code[one], toxic[row[at[one]]], minlength=len(values))
            df = np.maximum(np.bincount(code[one], minlength=len(values)), 1)
            q = np.clip(hits / df, 1e-9, 1 - 1e-9)
            gain = hits * np.log(q / base) + (df - hits) * np.log((1 - q) / (1 - base))
            mark[at] |= ((q > 0.9) & (gain > 14.0))[code]
    return mark & toxic[row].astype(bool)


class ToxicityModel:
    def __init__(self):
        self.w = np.zeros(1 << BITS, np.float32)
        self.bias, self.trans, self.begin = -6.0, np.zeros((2, 2)), np.zeros(2)
        self.slope, self.offset = 1.0, 0.0

    def emission(self, index: np.ndarray) -> np.ndarray:
        total = np.full(index.shape[1], float(self.bias))
        for i in index:
            total += self.w[i]
        return total

    def token_probability(self, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
        return marginals(self.emission(_index(hashes)), row, self.trans, self.begin)

    def evidence(self, p: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        return np.log(0.01 + np.bincount(row, np.where(p >= FLOOR, p, 0.0), minlength=n_rows))

    def score(self, p: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        x = self.slope * self.evidence(p, row, n_rows) + self.offset
        has = np.bincount(row, minlength=n_rows) > 0
        return np.where(has, 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35))), 0.0)

    def fit(self, texts: pa.Array, toxic: np.ndarray, shift: float, epochs: int) -> ToxicityModel:
        hashes, row, parts = sample_features(texts)
        gold = _evidence(hashes, row, toxic)
        index = np.empty(hashes.shape, np.int32)
        for own, _ in parts:
            index[:, own] = _index(hashes[:, own])
        del hashes
        first = _first_of_row(row)
        link = ~first[1:]
        a, b = gold[:-1][link].astype(int), gold[1:][link].astype(int)
        gold_pairs = np.bincount(a * 2 + b, minlength=4).reshape(2, 2).astype(np.float64)
        weight, bias = np.zeros(1 << BITS), self.bias
        g2, b2, t2, s2 = np.full(1 << BITS, 1.0), 1.0, np.ones((2, 2)), np.ones(2)
        rate, decay = 1.0, 0.002
        for _ in range(epochs):  # Adagrad on the full likelihood
            self.w, self.bias = weight.astype(np.float32), bias
            miss, pair, p_first = np.empty(len(row)), np.zeros((2, 2)), 0.0
            for own, _ in parts:
                p, own_pair, own_first = marginals(self.emission(index[:, own]), row[own], self.trans, self.begin,
                                                   pairs=True)
                miss[own] = gold[own] - p
                pair += own_pair
                p_first += own_first.sum()
            grad = sum(np.bincount(i, miss, minlength=1 << BITS) for i in index) - decay * weight
            g2 += grad * grad
            weight += rate * grad / np.sqrt(g2)
            b2 += miss.sum() ** 2
            bias += rate * miss.sum() / np.sqrt(b2)
            gt = gold_pairs - pair - decay * self.trans
            t2 += gt * gt
            self.trans = self.trans + 0.3 * gt / np.sqrt(t2)
            gs = (gold[first].sum() - p_first) * np.array([-1.0, 1.0])
            s2 += gs * gs
            self.begin = self.begin + 0.3 * gs / np.sqrt(s2)
        self.w, self.bias = weight.astype(np.float32), bias
        x = np.empty(len(toxic))
        for own, rows in parts:
            p = marginals(self.emission(index[:, own]), row[own], self.trans, self.begin)
            x[rows] = self.evidence(p, row[own] - rows.start, rows.stop - rows.start)
        slope, offset = 1.0, 0.0
        for _ in range(200):  # logistic fit of two numbers, with a small ridge
            q = 1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -35, 35)))
            d = toxic - q
            v = np.maximum(q * (1 - q), 1e-9)
            hess = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
            step = np.linalg.solve(hess, [(d * x).sum() - (slope - 1.0), d.sum() - 1e-2 * offset])
            slope, offset = slope + step[0], offset + step[1]
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.offset = float(slope), float(offset + shift)
        return self


def train(docs: DataFrame, labels: DataFrame, cap: int = CAP, epochs: int = EPOCHS) -> ToxicityModel | None:
    m, out = HELD_OUT
    rows, shift = labelled_texts(docs, labels, "toxic", crc32_mod(F.col("doc_id"), m) != out, cap)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", kind="stable").drop_duplicates("text")
        y = part["label"].to_numpy(np.float64)
        if not 0 < y.mean() < 1:
            return pd.DataFrame({"w": [], "rest": []})
        t = ToxicityModel().fit(pa.array(part["text"], pa.large_string()), y, shift, epochs)
        rest = [t.bias, *t.trans.ravel(), *t.begin, t.slope, t.offset]
        return pd.DataFrame({"w": [t.w.tobytes()], "rest": [rest]})

    # one group: the sample is bounded by ``cap``
    one = rows.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(1)).alias("group"))
    got = grouped_pandas(one, docs.sparkSession, fit, "w binary, rest array<double>").collect()
    if not got:
        return None
    t, rest = ToxicityModel(), got[0].rest
    t.w = np.frombuffer(got[0].w, np.float32)
    t.bias, t.trans, t.begin = rest[0], np.array(rest[1:5]).reshape(2, 2), np.array(rest[5:7])
    t.slope, t.offset = rest[7:9]
    return t


SPANS = "array<struct<start:int,end:int,p:double>>"


def _spans(data, at, p, row, start, end, n_rows: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(n_rows)]
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return out
    # characters before a byte: bytes that begin a character
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    joins = np.ones(len(hot), bool)
    joins[1:] = (hot[1:] != hot[:-1] + 1) | (row[hot[1:]] != row[hot[:-1]])
    groups = np.split(hot, np.flatnonzero(joins)[1:])
    for g in groups:
        r = row[g[0]]
        base = chars[at[r]]
        out[r].append({"start": int(chars[start[g[0]]] - base), "end": int(chars[end[g[-1]]] - base),
                       "p": float(p[g].max())})
    return out


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """(doc_id, score, spans) of every row; spans are character offsets."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tb.chunks(batch):
                hashes, row, start, end = token_features(part.column("text"))
                p = model.token_probability(hashes, row)
                data, at = tb.text_bytes(part.column("text"))
                spans = _spans(data, at, p, row, start, end, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(p, row, part.num_rows)), pa.array(spans, kind)],
                    ["doc_id", "score", "spans"])

    k = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {k}, score double, spans {SPANS}")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, spans."""
    m, out = HELD_OUT
    s = score(docs, train(docs, labels))
    return s.select("doc_id", (crc32_mod(F.col("doc_id"), m) == out).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with a score under the threshold, all columns, scored in place
    (no join back, no shuffle of texts)."""
    model = train(docs, labels)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tb.chunks(batch):
                hashes, row, _, _ = token_features(part.column("text"))
                s = model.score(model.token_probability(hashes, row), row, part.num_rows)
                kept = part.filter(pa.array(s < THRESHOLD))
                if kept.num_rows:
                    yield kept

    return map_arrow(docs, run, docs.schema)
