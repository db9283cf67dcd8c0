"""Benchmark decontamination by winnowing (DataFrame only).

Words of a text (A-Z lower-cased, runs outside ASCII punctuation and space) are
hashed.  Of every run of ``w`` consecutive k-word hashes, the smallest is kept
as a fingerprint; a shared span of k + w - 1 words always shares one.  Items
have windows of 13 words (k = w = 7), shorter items one window of all their
words (k and w from that length), so every window that occurs in a document
shares a fingerprint with it.  Fingerprints of documents and of the benchmark
are joined; the documents that hit are extended: all their windows of that
length, known by two independent 64-bit hashes, are joined to the item windows,
and the covered words are merged.

The benchmark tables are written first, so the planner knows their exact size
and broadcasts them only under its threshold; beyond it the joins shuffle.

Defined cases: a null or empty text has no words, no hits and is not
contaminated; items without words have no windows; repeated items count once by
item_id; items with a null item_id have windows and hits like any other, count
together as one item in n_items, and are not in ``items``; rows that repeat a doc_id with another text are judged apart; empty
tables give no hits; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.common import ascii_lower, null_safe, row_key, written

WINDOW = 13
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20


def words(text):
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_A_WORD, -1), lambda x: x != "")


def _hashed(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.transform("ws", lambda x: F.xxhash64(x)).alias("a"),
                     F.transform("ws", lambda x: F.xxhash64(F.lit("second"), x)).alias("b"))


def _grams(col: str, k: int):
    """Hashes of every k consecutive words (none if there are fewer)."""
    return F.when(F.size(col) >= k, F.transform(
        F.sequence(F.lit(0), F.size(col) - k),
        lambda i: F.xxhash64(*[F.get(F.col(col), i + j) for j in range(k)]))).otherwise(
            F.array().cast("array<bigint>"))


def guarantee(span: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = span."""
    k = (span + 1) // 2
    return k, span - k + 1


def fingerprints(df: DataFrame, span: int, *keys: str) -> DataFrame:
    """(keys, fp): winnowed fingerprints of the word hashes ``a``; any shared run
    of ``span`` words shares at least one."""
    k, w = guarantee(span)
    g = df.filter(F.size("a") >= span).select(*keys, _grams("a", k).alias("g"))
    kept = F.transform(F.sequence(F.lit(1), F.size("g") - (w - 1)), lambda i: F.array_min(F.slice(F.col("g"), i, w)))
    return g.select(*keys, F.explode(F.array_distinct(kept)).alias("fp"))


def _spans(df: DataFrame, span: int, *keys: str) -> DataFrame:
    """(keys, pos, a, b): every window of ``span`` words."""
    return (df.filter(F.size("a") >= span)
            .select(*keys, F.posexplode(F.arrays_zip(_grams("a", span).alias("a"), _grams("b", span).alias("b"))))
            .select(*keys, "pos", F.col("col.a").alias("a"), F.col("col.b").alias("b")))


def benchmark_tables(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Written (span, fp) and (span, a, b, items, unnamed), and the window lengths in use
    (1 to 13)."""
    items = (benchmark
             .select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0))
    items = written(items.withColumn("span", F.least(F.lit(WINDOW), F.size("ws"))), "decon-items")
    spans = sorted(r.span for r in items.select("span").distinct().collect())
    if not spans:
        return items, items, []
    h = _hashed(items, "item_id", "span")
    fps = wins = None
    for s in spans:
        own = h.filter(F.col("span") == s)
        f = fingerprints(own, s, "span").distinct()
        w = (_spans(own, s, "item_id", "span").groupBy("span", "a", "b")
             .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"),  # takes no nulls
                  F.max(F.col("item_id").isNull()).alias("unnamed")))
        fps, wins = (f, w) if fps is None else (fps.unionByName(f), wins.unionByName(w))
    return written(fps, "decon-fingerprints"), written(wins, "decon-windows"), spans


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, rk, n_words, n_hit, n_items, items (sorted
    as text), contaminated."""
    fps, wins, spans = benchmark_tables(benchmark)
    d = docs.select("doc_id", "text", row_key(F.col("text")).alias("rk"))
    counted = d.select("doc_id", "rk", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if not spans:
        return counted.select("*", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                              none.alias("items"), F.lit(False).alias("contaminated"))
    hashed = d.select("doc_id", "rk", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("a"))
    suspects = None
    for s in spans:
        own = fps.filter(F.col("span") == s).select("fp")
        hit = fingerprints(hashed, s, "doc_id", "rk").join(own, "fp", "left_semi").select("doc_id", "rk").distinct()
        suspects = hit if suspects is None else suspects.unionByName(hit)
    suspects = written(suspects.distinct(), "decon-suspects")
    near = null_safe(d, suspects, ["doc_id", "rk"], "left_semi").select("doc_id", "rk", words(F.col("text")).alias("ws"))
    near = _hashed(near, "doc_id", "rk")
    found = None
    for s in spans:
        own = wins.filter(F.col("span") == s).select("a", "b", "items", "unnamed")
        f = (_spans(near, s, "doc_id", "rk").join(own, ["a", "b"])
             .select("doc_id", "rk", F.sequence("pos", F.col("pos") + (s - 1)).alias("at"), "items", "unnamed"))
        found = f if found is None else found.unionByName(f)
    hits = found.groupBy("doc_id", "rk").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max("unnamed").cast("long").alias("unnamed"))
    out = null_safe(counted, hits, ["doc_id", "rk"], "left").select(
        "doc_id", "rk", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("unnamed", F.lit(0).cast("long")).alias("unnamed"))
    return out.select("doc_id", "rk", "n_words", "n_hit",
                      (F.size("items") + F.col("unnamed")).cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns."""
    bad = written(contamination(docs, benchmark).filter("contaminated").select("doc_id", "rk").distinct(),
                  "decon-contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", row_key(F.col("text")).alias("rk"))
    return null_safe(rows, bad, ["doc_id", "rk"], "left_anti").select("row.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), win AS (
  SELECT item_id, least(13, len(ws)) AS n, ws[p : p + least(13, len(ws)) - 1] AS gram
  FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS p
        FROM iw WHERE len(ws) > 0)
), spans AS (SELECT DISTINCT n FROM win
), dwin AS (
  SELECT doc_id, p, n, ws[p : p + n - 1] AS gram
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS p
        FROM dw, spans WHERE len(ws) >= n)
), hit AS (
  SELECT doc_id, p, n, item_id FROM dwin JOIN win USING (n, gram)
), pos AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hit))
  GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
