"""Near-duplicate classes by an exact n-gram Jaccard join with token-combination
prefixes.

A text is the set of its distinct five-word shingles (64-bit hashes).  Texts
with equal sets are one class first; the smallest doc_id represents it.  The
tokens of a set (48 bits of its hashes) are ordered by the number of texts that
hold them, then by value.  With at most d = n - ceil(0.8 n) tokens of a set
missing from a partner:

* the first d + 1 tokens of two similar sets share a token; each *rare* one (in
  at most RARE texts) is indexed singly;
* a set whose d + 1 tokens reach into the *frequent* class is extended to
  d + g + 1 tokens, of which similar sets share g + 1.  The frequent tokens are
  dealt into g groups by hash, so two of the shared ones meet in a group: the
  2-token combinations within groups are indexed (about linear in n).  g depends
  on the size class of the smaller set, so a set indexes for its own class and
  the one below.

Counts.  Hash buckets summed over all documents find the *hot* tokens (their
bucket holds more than the mean, five standard deviations of a random filling
and HOT more); one bit per bucket is the proven bound of what is broadcast.  Hot
tokens come last in the order.  All other tokens are counted exactly: tasks send
their tokens, cut into slices by value, as packed blobs; a slice returns to each
text its tokens that occur elsewhere, with their counts.  A slice holds about
SLICE_TOKENS tokens, none of them hot, however many documents there are.  Most
texts have more than d tokens of their own and are done here: they index
nothing.

Sets that share an index entry are candidates.  First every member of an entry
is paired with the entry's smallest document and with the one that has most
shared tokens; parity sketches of about three bits a token (bits that differ are
at most the tokens that differ) cut these pairs, each text is verified against
its nearest partner, then the pairs still between components.  Links are
contracted into components.  Entries that still span several components are
compared in blocks of about BLOCK members (of the same or neighbouring size
classes), whose folded sketches are multiplied as matrices: only pairs of
different components that sizes and sketches allow leave a block, and are
verified in the same way.  Similar texts share many entries: a pair is left to a
smaller shared entry where the LOWEST smallest entries of both texts hold one,
and the smallest shared entry never leaves it to another.
So a link between components is never lost, and pairs inside one are not made.
Verification compares whole sets.

Defined cases: null texts and texts without words have the empty set, linked
with nothing; rows that repeat a doc_id are one node with the links of all
their texts; a null doc_id is in no component (component_id null); an empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm import textbytes as tb
from cordon.llm.common import grouped_pandas, map_arrow, row_key, ship, small_batches, written

WORDS = 5
PERCENT = 80
#: Tokens in more texts than this are indexed in combinations.
RARE = 256
#: Tokens in more texts than this (and the noise of their bucket) are not counted one by one.
HOT = 1000
BUCKETS = 1 << 22
SLICES = 32
#: Bits of a token that are counted and indexed.
BITS = 48
SLICE_TOKENS = 4_000_000
#: Bytes of a sketch at most where the members of an entry are compared.
SKETCH_BYTES = 64
#: Tokens that a task gathers before it sends them to their slices.
GATHERED = 4_000_000
#: Members of an entry that are compared at once.
BLOCK = 256
#: Smallest entries of a text that it carries, so that a pair leaves one block, not one per shared entry.
LOWEST = 16

_KIND = tb.class_table(1, space=(0, b" \t\n\x0b\x0c\r"))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Per row, the sorted distinct shingle hashes."""
    data, at = tb.text_bytes(column)
    data = tb.LOWER[data]
    start, end, row = tb.tokens(_KIND[data], at)
    word = tb.SpanHash(data)(start, end)
    first = np.searchsorted(row, np.arange(len(column) + 1))
    n = len(word)
    h = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        h = tb.mix(h * np.uint64(5) + word[k:n - WORDS + 1 + k]) if len(h) else h
    out = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= WORDS:
            s = np.sort(h[lo:hi - WORDS + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif hi > lo:  # fewer words: the whole sequence as one
            own = np.full(1, hi - lo, np.uint64)
            for w in word[lo:hi]:
                own = tb.mix(own * np.uint64(7) + w)
            out.append(own)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def missing(n: int) -> int:
    """Tokens of a set of n that a similar partner may lack."""
    return n - (PERCENT * n + 99) // 100


def _class_bounds() -> np.ndarray:
    b = [1]
    while b[-1] < 1 << 40:
        b.append(b[-1] * 100 // PERCENT + 1)
    return np.array(b)


#: Size classes such that a similar partner is in the same or a next class.
CLASSES = _class_bounds()


def _bucket(short_tokens: np.ndarray) -> np.ndarray:
    return (short_tokens >> np.uint64(BITS + 1 - BUCKETS.bit_length())).astype(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens per bit, two to four bits a token."""
    m = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(data: bytes, size: int) -> np.ndarray:
    """A sketch as ``size`` bytes; a longer one is folded, its bits keep their meaning."""
    a = np.frombuffer(data, np.uint8)
    while len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def sketches_allow(differ, n_a, n_b):
    """Whether so many differing bits allow a link of sets of these sizes (a
    link has (100 + P) o >= P (|x| + |y|), and |x| + |y| - 2 o tokens differ)."""
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (n_a + n_b)


def short(tokens: np.ndarray) -> np.ndarray:
    """The distinct BITS-bit tokens of sorted hashes, sorted."""
    t = tokens >> np.uint64(64 - BITS)
    keep = np.ones(len(t), bool)
    np.not_equal(t[1:], t[:-1], out=keep[1:])
    return t[keep]


def _groups(n: int) -> dict[int, int]:
    """Size class: number of groups, for the classes in which a set of n is indexed."""
    own = int(np.searchsorted(CLASSES, n, "right")) - 1
    return {c: max(1, int(CLASSES[c]) // 10) for c in {own, max(own - 1, 0)}}


def index_entries(n: int, alone: int, shared: np.ndarray, count: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The index entries of a set of ``n``: ``alone`` of its tokens are in no
    other text, ``shared`` ones in ``count`` texts, the first of the ``hot`` ones follow."""
    d = missing(n)
    if alone > d:
        return np.zeros(0, np.uint64)
    order = np.lexsort((shared, count))
    shared, often = shared[order], count[order] > RARE
    rare, many = shared[~often], np.concatenate([shared[often], hot])
    entries = [tb.mix(rare[:d + 1 - alone])]
    first = alone + len(rare)
    if first <= d and n > 1:
        for c, g in _groups(n).items():
            part = many[:d + g + 1 - first]
            group = (part >> np.uint64(7)) % np.uint64(g)
            order = np.argsort(group, kind="stable")
            part, group = part[order], group[order]
            for lag in range(1, len(part)):
                same = group[lag:] == group[:-lag]
                if not same.any():
                    break
                entries.append(tb.mix(part[:-lag][same] * np.uint64(3) + tb.mix(part[lag:][same] + np.uint64(c + 1))))
    return np.unique(np.concatenate(entries))


def hot_buckets(docs: DataFrame) -> np.ndarray:
    """A flag for every bucket: it holds hot tokens."""
    spark, width = docs.sparkSession, BUCKETS // SLICES
    schema = "slice int, part int, data binary"

    def packed(slices, parts, counts) -> dict:
        return {"slice": slices, "part": parts, "data": [zlib.compress(c.astype("<u8").tobytes(), 1) for c in counts]}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.uint32)
        for batch in batches:
            for part in tb.chunks(batch):
                own = np.concatenate([np.zeros(0, np.uint64), *map(short, shingle_sets(part.column("text")))])
                np.add.at(total, _bucket(own), np.uint32(1))
        if total.any():
            out = packed(range(SLICES), [TaskContext.get().partitionId() % 64] * SLICES, total.reshape(SLICES, width))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("slice", pa.int32()), ("part", pa.int32()),
                                                             ("data", pa.binary())]))

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.uint64)
        for data in rows["data"]:
            total += np.frombuffer(zlib.decompress(data), "<u8")
        return pd.DataFrame(packed([rows["slice"].iloc[0]], [0], [total]))

    # summed twice, so a group has the arrays of a sixty-fourth of the tasks
    parts = grouped_pandas(map_arrow(docs.select("text"), count, schema).groupBy("slice", "part"), spark, add, schema)
    counts = np.zeros((SLICES, width), np.uint64)
    for r in grouped_pandas(parts.groupBy("slice"), spark, add, schema).collect():  # BUCKETS numbers
        counts[r.slice] = np.frombuffer(zlib.decompress(r.data), "<u8")
    mean = counts.sum() / BUCKETS
    return counts.ravel() > mean + 5 * np.sqrt(mean) + HOT


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _key(digest: bytes) -> int:
    """Tells apart rows that repeat a doc_id."""
    return int.from_bytes(digest[:4], "little", signed=True)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int64), *[v.astype(np.int64) for v in values]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def describe(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(doc_id, n, digest, key, cls, plain, hot, sketch, small) of every row: the
    number of its tokens that are not hot, the hot ones that its prefix may
    reach, its sketch and the same folded to SKETCH_BYTES."""
    flags = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch):
                sets = shingle_sets(part.column("text"))
                plain, own = [], []
                for s in sets:
                    t = short(s)
                    h = t[flags.value[_bucket(t)]]
                    plain.append(len(t) - len(h))
                    reach = missing(len(s)) + max(_groups(len(s)).values()) + 1 if len(s) else 0
                    own.append(h[:max(reach - plain[-1], 0)])
                n = np.array([len(s) for s in sets], np.int64)
                digest, sketches = [_digest(s) for s in sets], [sketch(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(digest, pa.binary()), pa.array(map(_key, digest), pa.int32()),
                     pa.array((np.searchsorted(CLASSES, n, "right") - 1).astype(np.int32)), pa.array(plain, pa.int64()),
                     _lists(own, pa.int64()), pa.array(sketches, pa.binary()),
                     pa.array([folded(x, SKETCH_BYTES).tobytes() for x in sketches], pa.binary())],
                    ["doc_id", "n", "digest", "key", "cls", "plain", "hot", "sketch", "small"])

    return map_arrow(docs.select("doc_id", "text"), run,
                     "doc_id long, n long, digest binary, key int, cls int, plain long, hot array<long>, sketch binary, small binary")


def _packed(tokens: np.ndarray) -> bytes:
    """BITS / 8 bytes a token."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // BITS, 8), np.uint8)
    out[:, :BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    return out.view("<u8").ravel()


def sliced_tokens(docs: DataFrame, hot: np.ndarray, slices: int) -> DataFrame:
    """(slice, ids, keys, counts, tokens): the tokens that are not hot, of many
    texts at once; ``slices`` is a power of two."""
    flags = docs.sparkSession.sparkContext.broadcast(hot)
    schema = pa.schema([("slice", pa.int32())] + [(c, pa.binary()) for c in ("ids", "keys", "counts", "tokens")])
    shift = np.uint64(BITS - slices.bit_length() + 1)

    def blobs(held: list[tuple]) -> pa.RecordBatch:
        ids = np.array([x[0] for x in held], "<i8")
        keys = np.array([x[1] for x in held], "<i4")
        own = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
        t = np.concatenate([x[2] for x in held])
        to = (t >> shift).astype(np.int64) if slices > 1 else np.zeros(len(t), np.int64)
        order = np.argsort(to, kind="stable")
        t, own, to = t[order], own[order], to[order]
        at = np.searchsorted(to, np.arange(slices + 1))
        cols: list[list] = [[] for _ in schema]
        for k in range(slices):
            if at[k + 1] > at[k]:
                rows, counts = np.unique(own[at[k]:at[k + 1]], return_counts=True)
                for c, v in zip(cols, (k, ids[rows].tobytes(), keys[rows].tobytes(), counts.astype("<u4").tobytes(),
                                       _packed(t[at[k]:at[k + 1]])), strict=True):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, seen = [], 0, set()
        for batch in batches:
            for part in tb.chunks(batch):
                sets = shingle_sets(part.column("text"))
                for doc, s in zip(part.column("doc_id").to_pylist(), sets, strict=True):
                    key = _digest(s)
                    t = short(s)
                    t = t[~flags.value[_bucket(t)]]
                    if len(t) and (doc, key) not in seen:
                        seen.add((doc, key))
                        held.append((doc, _key(key), t))
                        many += len(t)
                if many >= GATHERED:
                    yield blobs(held)
                    held, many, seen = [], 0, set()
        if held:
            yield blobs(held)

    return map_arrow(docs.filter("doc_id is not null").select("doc_id", "text"), run,
                     "slice int, ids binary, keys binary, counts binary, tokens binary")


def shared_tokens(docs: DataFrame, hot: np.ndarray, tokens: int) -> DataFrame:
    """(doc_id, key, shared, count): the tokens of a text that are not hot and
    occur in other rows too, BITS / 8 bytes each, with the number of texts that
    hold them (two bytes, 65,535 at most)."""
    slices = SLICES
    while tokens > slices * SLICE_TOKENS:
        slices *= 2

    def count(table: pa.Table) -> pa.Table:
        def column(name, kind):
            return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])

        ids, keys, per = column("ids", "<i8"), column("keys", "<i4"), column("counts", "<u4")
        t = np.concatenate([_unpacked(x.as_py()) for x in table.column("tokens")])
        own = np.repeat(np.arange(len(ids), dtype=np.int64), per)
        # exact copies are one text: of a token, count different digests (eight bits of them)
        mark = (t << np.uint64(8)) | (keys[own] & 255).astype(np.uint64)
        order = np.argsort(mark, kind="stable")
        mark = mark[order]
        t = mark >> np.uint64(8)
        new = np.ones(len(t), bool)
        np.not_equal(t[1:], t[:-1], out=new[1:])
        other = np.ones(len(t), bool)
        np.not_equal(mark[1:], mark[:-1], out=other[1:])
        start = np.flatnonzero(new)
        rows = np.diff(np.append(start, len(t)))
        texts = np.add.reduceat(other.astype(np.int64), start) if len(t) else rows
        again = np.repeat(rows > 1, rows)
        t, texts, own = t[again], np.repeat(texts, rows)[again], own[order][again]
        order = np.argsort(own, kind="stable")
        t, texts, own = t[order], texts[order], own[order]
        doc, at = np.unique(own, return_index=True)
        ends = np.append(at, len(own))

        def packed(data: bytes, width: int) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((ends * width).astype(np.int32)),
                                                                 pa.py_buffer(data)])

        return pa.table({"doc_id": pa.array(ids[doc]), "key": pa.array(keys[doc]),
                         "shared": packed(_packed(t), BITS // 8),
                         "count": packed(np.minimum(texts, 65_535).astype("<u2").tobytes(), 2)})

    ship(docs.sparkSession)
    return sliced_tokens(docs, hot, slices).groupBy("slice").applyInArrow(
        count, "doc_id long, key int, shared binary, count binary")


def postings(reps: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc, entry, weight) of the texts ``reps``; weight: their shared tokens."""
    got = shared.groupBy("doc_id", "key").agg(F.collect_list(F.struct("shared", "count")).alias("parts"))
    own = reps.select("doc_id", "key", "n", "plain", "hot").join(got, ["doc_id", "key"], "left")
    own = own.filter("parts is not null or size(hot) > 0").select(
        "doc_id", "n", "plain", "hot", "parts.shared", "parts.count")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(column):
            return [b"".join(x) if x else b"" for x in column.to_pylist()]

        for batch in batches:
            if not batch.num_rows:
                continue
            found, weight = [], []
            for n, plain, hot, tokens, count in zip(
                    batch.column("n").to_pylist(), batch.column("plain").to_pylist(), batch.column("hot").to_pylist(),
                    parts(batch.column("shared")), parts(batch.column("count")), strict=True):
                hot, tokens = np.array(hot, np.int64).astype(np.uint64), _unpacked(tokens)
                count = np.frombuffer(count, "<u2").astype(np.int64)
                found.append(index_entries(n, plain - len(tokens), tokens, count, hot))
                weight.append(len(tokens) + len(hot))
            per = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("doc_id").to_numpy(), per)),
                 pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(weight, per))], ["doc", "entry", "weight"])

    return map_arrow(own, run, "doc long, entry long, weight long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of similar sets; ``texts``: (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                # a leader comes with many partners: one set for each text
                both = pa.concat_arrays([part.column("text_a"), part.column("text_b")]).fill_null("")
                both = both.dictionary_encode()
                sets = shingle_sets(both.dictionary)
                at = both.indices.to_numpy().reshape(2, -1)
                keep = []
                for a, b in at.T.tolist():
                    x, y = sets[a], sets[b]
                    n = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * n >= PERCENT * (len(x) + len(y) - n))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    t = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    u = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    return map_arrow(pairs.join(u, "b").join(t, "a").select("a", "b", "text_a", "text_b"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of a link."""
    both = written(links.union(links.select("b", "a")).toDF("a", "b").distinct(), "jaccard-links")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("comp")), "jaccard-labels")
    while True:
        near = (both.join(label.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        hooked = label.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("was"))
        # follow the label's own label
        up = label.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = written(hooked.join(up, "comp", "left").select(
            "node", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "was"), "jaccard-labels")
        label = new.select("node", "comp")
        if new.filter("comp <> was").isEmpty():
            return label


def plausible(pairs: DataFrame, size: DataFrame) -> DataFrame:
    """(a, b, differ): the pairs whose sizes and sketches allow a link, with the
    bits that differ (0 without a sketch)."""
    for c in "ab":
        pairs = pairs.join(size.select(F.col("doc").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("lo", "hi", "sketch")]), c)
    fit = (100 * F.col("hi_a") >= PERCENT * F.col("lo_b")) & (100 * F.col("hi_b") >= PERCENT * F.col("lo_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = []
            for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True):
                size = 0 if x is None or y is None else min(len(x), len(y))
                differ.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) if size else 0)
            differ = np.array(differ, np.int64)
            keep = sketches_allow(differ, batch.column("hi_a").to_numpy(), batch.column("hi_b").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(differ)],
                                             ["a", "b", "differ"]).filter(pa.array(keep))

    return map_arrow(pairs.filter(fit).select("a", "b", "hi_a", "hi_b", "sketch_a", "sketch_b"), run,
                     "a long, b long, differ long")


def left_to_smaller(entry: int, x: list[list[int]], y: list[list[int]]) -> np.ndarray:
    """A flag for every pair of rows of ``x`` and ``y`` (the smallest entries of a
    text each): both hold the same entry below ``entry``."""
    low = np.array(sorted({e for side in (x, y) for own in side for e in own if e < entry}), np.int64)

    def held(side: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(side), len(low)), np.float32)
        row = np.repeat(np.arange(len(side)), [len(own) for own in side])
        flat = np.array([e for own in side for e in own], np.int64)
        row, flat = row[flat < entry], flat[flat < entry]
        out[row, np.searchsorted(low, flat)] = 1
        return out

    return held(x) @ held(y).T > 0


def block_pairs(member: DataFrame, size: DataFrame) -> DataFrame:
    """(a, b): pairs of different components that share an entry of ``member``
    (entry, doc, comp) and that sizes and sketches allow.  The members of an
    entry are one block; of more than BLOCK members, each size class is cut into
    blocks, and blocks of the same and of neighbouring classes meet."""
    m = member.join(size.select("doc", "cls_lo", "cls_hi"), "doc")
    m = m.join(member.groupBy("entry").agg(F.count("*").alias("c")), "entry")
    few = F.col("c") <= BLOCK
    m = m.withColumn("cls", F.explode(F.when(few, F.array(F.lit(-1))).otherwise(F.sequence("cls_lo", "cls_hi"))))
    per = m.groupBy("entry", "cls").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    m = m.join(per, ["entry", "cls"]).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc"), F.col("blocks")).cast("int"))
    # what is compared joins last: the joins above move ids only
    lowest = member.groupBy("doc").agg(F.slice(F.sort_array(F.collect_set("entry")), 1, LOWEST).alias("lowest"))
    compared = written(size.select("doc", "lo", "hi", "small").join(lowest, "doc"), "jaccard-compared")
    m = m.select("entry", "cls", "block", "doc", "comp").join(compared, "doc")
    block = written(m.groupBy("entry", "cls", "block")
                    .agg(F.collect_list(F.struct("doc", "comp", "lo", "hi", "small", "lowest")).alias("x")), "jaccard-blocks")
    many = block.filter("cls >= 0")
    own = many.withColumn("near", F.explode(F.array(F.col("cls"), F.col("cls") + 1)))
    other = many.select("entry", F.col("cls").alias("near"), F.col("block").alias("other"), F.col("x").alias("y"))
    across = own.join(other, ["entry", "near"]).filter("near > cls or other > block").select("entry", "x", "y")
    none = F.slice("x", 1, 0)

    def bits(rows: list[dict], size: int) -> np.ndarray:
        none = np.zeros(size, np.uint8)
        data = np.stack([none if r["small"] is None else folded(r["small"], size) for r in rows])
        return np.unpackbits(data, axis=1).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for both in batch.to_pylist():
                x, y = both["x"], both["y"] or both["x"]  # a block with itself
                comp, hi, lo, doc = ([np.array([r[c] for r in side]) for side in (x, y)] for c in ("comp", "hi", "lo", "doc"))
                ok = ((comp[0][:, None] != comp[1][None]) & (doc[0][:, None] != doc[1][None])
                      & (100 * hi[0][:, None] >= PERCENT * lo[1][None]) & (100 * hi[1][None] >= PERCENT * lo[0][:, None]))
                if not both["y"]:
                    ok &= doc[0][:, None] < doc[1][None]
                if not ok.any():
                    continue
                width = min((len(r["small"]) for r in (*x, *y) if r["small"] is not None), default=8)
                p, q = bits(x, width), bits(y, width)
                differ = p.sum(1)[:, None] + q.sum(1)[None] - 2 * (p @ q.T)
                known = np.outer([r["small"] is not None for r in x], [r["small"] is not None for r in y])
                ok &= ~known | sketches_allow(differ, hi[0][:, None], hi[1][None])
                i, j = np.nonzero(ok)
                if not len(i):
                    continue
                rows, cols = np.unique(i), np.unique(j)
                later = left_to_smaller(both["entry"], [x[k]["lowest"] for k in rows], [y[k]["lowest"] for k in cols])
                stay = ~later[np.searchsorted(rows, i), np.searchsorted(cols, j)]
                a, b = doc[0][i[stay]], doc[1][j[stay]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return map_arrow(block.select("entry", "x", none.alias("y")).unionByName(across), run, "a long, b long").distinct()


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    with small_batches(docs.sparkSession, 200):  # a row may be a pair of long texts
        return _near_duplicates(docs)


def _linked(links: DataFrame, pairs: DataFrame, texts: DataFrame, comp: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(links, components) with the links among the written ``pairs`` (a, b,
    differ) added: each text's nearest partner first, then what is between
    components.  ``comp``: the components of ``links``, if known."""
    if comp is not None and pairs.isEmpty():
        return links, comp
    near = (pairs.groupBy(F.col("a").alias("x")).agg(F.min_by("b", F.struct("differ", "b")).alias("y"))
            .union(pairs.groupBy(F.col("b").alias("x")).agg(F.min_by("a", F.struct("differ", "a")).alias("y"))))
    near = _ordered(near, "x", "y").distinct()
    links = written(links.union(verified(near, texts)).distinct(), "jaccard-links")
    comp = components(links)
    rest = pairs.select("a", "b")
    for c in "ab":
        rest = rest.join(comp.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")), c, "left")
    rest = rest.filter(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")
    more = written(verified(rest, texts), "jaccard-links")
    if more.isEmpty():
        return links, comp
    links = written(links.union(more).distinct(), "jaccard-links")
    return links, components(links)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hot = hot_buckets(docs)
    sets = written(describe(docs, hot), "jaccard-sets")
    usable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    same = sets.filter(usable).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    groups = written(same.filter("copies > 1").select("digest", "rep"), "jaccard-copies")
    rows = written(sets.select("doc_id", "n", "digest").join(groups, "digest", "left")
                   .select("doc_id", "n", "digest", F.when(usable, F.coalesce("rep", "doc_id")).alias("rep")), "jaccard-rows")
    # a doc_id with several texts links their classes
    links = _ordered(rows.filter("rep is not null").groupBy("doc_id")
                     .agg(F.min("rep").alias("x"), F.collect_set("rep").alias("ys")).filter(F.size("ys") > 1)
                     .select("x", F.explode("ys").alias("y")), "x", "y").filter("a < b")
    # only the copied text leaves the index, not the other texts of its doc_id; repeated rows are one text
    reps = rows.filter("rep = doc_id").select("doc_id", "digest").distinct()
    reps = sets.join(reps, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    tokens = sets.agg(F.sum("plain")).first()[0] or 0
    posting = written(postings(reps, shared_tokens(docs, hot, tokens)), "jaccard-postings")
    entry = (posting.groupBy("entry").agg(F.min("doc").alias("lead"), F.max("doc").alias("last"),
                                          F.max_by("doc", F.struct("weight", "doc")).alias("middle"))
             .filter("lead < last").drop("last"))
    member = written(posting.join(entry, "entry").select("entry", "doc", "lead", "middle").distinct(), "jaccard-members")
    ids = written(member.select(F.col("doc").alias("doc_id")).distinct(), "jaccard-ids")
    # of a doc_id with several texts, the sketch says nothing
    size = written(reps.join(ids, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("doc"))
                   .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("cls").alias("cls_lo"),
                        F.max("cls").alias("cls_hi"), F.when(F.count("*") == 1, F.first("sketch")).alias("sketch"),
                        F.when(F.count("*") == 1, F.first("small")).alias("small")), "jaccard-sizes")
    texts = written(docs.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text").distinct(),
                    "jaccard-texts")
    pairs = _ordered(member, "lead", "doc").union(_ordered(member, "middle", "doc")).filter("a < b").distinct()
    links, comp = _linked(links, written(plausible(pairs, size), "jaccard-pairs"), texts, None)
    placed = (member.join(comp.withColumnRenamed("node", "doc"), "doc", "left")
              .select("entry", "doc", F.coalesce("comp", "doc").alias("comp")))
    apart = placed.groupBy("entry").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
    member = written(placed.join(apart.select("entry"), "entry"), "jaccard-members")
    pairs = written(plausible(block_pairs(member, size), size), "jaccard-pairs")
    _, comp = _linked(links, pairs, texts, comp)
    out = rows.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("comp", "rep", "doc_id").alias("component_id"))


def one_per_class(docs: DataFrame) -> DataFrame:
    """The rows that are the smallest doc_id of their class (of rows that repeat
    that doc_id one stays; rows with a null doc_id stay), all columns."""
    found = written(near_duplicates(docs).select("doc_id", "component_id"), "jaccard-classes")
    losers = written(found.filter("component_id < doc_id").select("doc_id").distinct(), "jaccard-losers")
    kept = docs.join(losers, "doc_id", "left_anti").select(docs.columns)
    again = written(found.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1")
                    .select("doc_id"), "jaccard-repeated")
    if again.isEmpty():
        return kept
    one = (kept.join(again, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("__id"))
           .agg(F.min_by(F.struct(*[F.col(c) for c in docs.columns]), row_key(F.col("text"))).alias("row")).select("row.*"))
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, ws[p : p + 4] AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS p FROM d WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT o.a, o.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y USING (g)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) o
  JOIN n na ON na.doc_id = o.a JOIN n nb ON nb.doc_id = o.b WHERE 100 * o.o >= 80 * (na.n + nb.n - o.o)
), reach AS (
  SELECT doc_id AS a, doc_id AS c FROM d
  UNION
  SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(c) AS c FROM reach GROUP BY a) r USING (doc_id)
"""
