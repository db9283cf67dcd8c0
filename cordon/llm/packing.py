"""Hierarchical packing of documents into sequences of several context sizes.

Every document is tokenised whole, closed by one end id and cut into pieces of
at most the longest context (only longer documents are cut).  A piece is routed
to the smallest tier (context size) that holds it.  Each tier packs its own
pieces, best fit first; gaps of the windows of longer tiers are filled with the
largest pieces of shorter tiers that fit.  Windows of shorter tiers that do not
come out full can be promoted: they are packed whole into windows of the
longest tier.  Sequences are then dealt to step groups of equal size so that
the groups' attention costs (sum of squared piece lengths) balance.

Only piece descriptions (ids' lengths and checksums, not the ids) are shuffled.
They are written once and dealt by hash into shards of about ``PIECES_PER_SHARD``
pieces, so the number of shards grows with the data, a shard fits one task and
no key is hot; each shard leaves at most a few windows unfilled.

Defined cases: null and empty texts are one piece of one id (the end id);
repeated rows are packed each; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import grouped_pandas, map_arrow, written
from cordon.llm.tokens import token_ids

TIERS = (128, 256, 512, 1024)
END_ID = 0
PIECES_PER_SHARD = 20_000
SEQUENCES_PER_STEP = 64


def pieces(docs: DataFrame, longest: int, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, nth) of every piece; nth
    counts within the task that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, nth = token_ids(vocabulary), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            for part in tb.chunks(batch):
                rows, ids = part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist())
                out: list[tuple] = []
                for doc, body in zip(rows, ids, strict=True):
                    body += end
                    n = len(body) // 4
                    for lo in range(0, n, longest):
                        own = body[4 * lo:4 * (lo + longest)]
                        out.append((doc, lo, len(own) // 4, zlib.crc32(own), n, nth))
                        nth += 1
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], part.schema.field("doc_id").type), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"])

    k = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), 
        run, f"doc_id {k}, start long, length long, ids_crc32 long, doc_tokens long, nth long")


class _Shelf:
    """Things by size, with the set of sizes in use as the bits of a number."""

    def __init__(self):
        self.bits, self.at = 0, {}

    def put(self, size: int, thing) -> None:
        self.at.setdefault(size, []).append(thing)
        self.bits |= 1 << size

    def take(self, size: int):
        own = self.at[size]
        thing = own.pop()
        if not own:
            self.bits ^= 1 << size
        return thing

    def largest_to(self, size: int) -> int:
        """The largest size in use that is at most ``size``; -1 if none is."""
        return (self.bits & ((2 << size) - 1)).bit_length() - 1

    def smallest_from(self, size: int) -> int:
        own = self.bits >> size
        return size + (own & -own).bit_length() - 1 if own else -1


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS, promote: bool = True) -> list[tuple[int, list[int]]]:
    """(tier, indexes of pieces) of every sequence."""
    longest = tiers[-1]
    shelves = {t: _Shelf() for t in tiers}
    for i in np.argsort(lengths, kind="stable"):
        n = int(lengths[i])
        shelves[next(t for t in tiers if n <= t)].put(n, int(i))
    done: list[tuple[int, list[int]]] = []
    short: list[tuple[int, list[int]]] = []  # windows of shorter tiers that are not full
    for k in range(len(tiers) - 1, -1, -1):
        tier, own = tiers[k], shelves[tiers[k]]
        windows, room = [], _Shelf()
        while own.bits:  # best fit, longest pieces first
            n = own.bits.bit_length() - 1
            i = own.take(n)
            gap = room.smallest_from(n)
            w = room.take(gap) if gap >= 0 else len(windows)
            if gap < 0:
                windows.append([])
                gap = tier
            windows[w].append(i)
            if gap > n:
                room.put(gap - n, w)
        while room.bits:  # fill the gaps from the shorter tiers, smallest gaps first
            gap = (room.bits & -room.bits).bit_length() - 1
            w = room.take(gap)
            for j in range(k - 1, -1, -1):
                while gap and (n := shelves[tiers[j]].largest_to(gap)) > 0:
                    windows[w].append(shelves[tiers[j]].take(n))
                    gap -= n
            if gap and tier < longest and promote:
                short.append((tier - gap, windows[w]))
                windows[w] = []
        done += [(tier, w) for w in windows if w]
    room = _Shelf()
    for n, own in sorted(short, key=lambda x: -x[0]):
        gap = room.smallest_from(n)
        if gap < 0:
            done.append((longest, []))
            w, gap = len(done) - 1, longest
        else:
            w = room.take(gap)
        done[w][1].extend(own)
        if gap > n:
            room.put(gap - n, w)
    return done


def step_groups(costs: list[float], size: int = SEQUENCES_PER_STEP) -> np.ndarray:
    """The step group of every sequence: dealt in order of cost, to and fro."""
    groups = max(1, -(-len(costs) // size))
    rank = np.empty(len(costs), np.int64)
    rank[np.argsort(-np.asarray(costs), kind="stable")] = np.arange(len(costs))
    lap, place = rank // groups, rank % groups
    return np.where(lap % 2 == 0, place, groups - 1 - place)


def pack_documents(docs: DataFrame, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, promote: bool = True,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step."""
    tiers = tuple(sorted(tiers))
    all_pieces = written(pieces(docs, tiers[-1], end_id, vocabulary), "packing-pieces")
    shards = max(1, -(-all_pieces.count() // PIECES_PER_SHARD))
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "nth"), F.lit(shards))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "start", "ids_crc32", "nth"], kind="stable").reset_index(drop=True)
        length = part["length"].to_numpy()
        packed = pack(length.tolist(), tiers, promote)
        steps = step_groups([float((length[w] ** 2).sum()) for _, w in packed])
        base = int(part["shard"].iloc[0]) << 32
        order = np.concatenate([w for _, w in packed])
        counts = [len(w) for _, w in packed]
        sequence = np.repeat(np.arange(len(packed)), counts)
        before = np.cumsum(length[order]) - length[order]
        first = np.repeat(before[np.cumsum(counts) - counts], counts)
        out = part.loc[order, columns].reset_index(drop=True)
        out["sequence_id"], out["offset"] = base + sequence, before - first
        out["tier"] = np.repeat([t for t, _ in packed], counts)
        out["step"] = base + np.repeat(steps, counts)
        return out

    k = docs.schema["doc_id"].dataType.simpleString()
    return grouped_pandas(all_pieces.withColumn("shard", shard).groupBy("shard"), docs.sparkSession, run,
                          f"doc_id {k}, start long, length long, ids_crc32 long, doc_tokens long, "
                          "sequence_id long, offset long, tier int, step long")
