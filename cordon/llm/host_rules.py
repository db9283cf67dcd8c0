"""Host-level quality rules (DataFrame only).

Every text is measured (words, their characters, symbols, repeated lines, words
in repeated three-word windows) and judged by simple rules.  Failures are
counted per host, here the ``source`` of a document, and each host's failure
rate is shrunk towards the others: a beta prior is fitted to the rates of all
hosts by moments, and the posterior mean decides.  A host that fails as a whole
takes its documents with it; a host seen a few times cannot fail by chance.
The verdicts are joined back to the documents.

Texts are read once; the measures (some numbers a document) are written, so the
count per host (combined map-side, one host may hold most rows) and the join
work on narrow rows.  The join is left to the planner, which splits a hot host.

Rules: fewer than MIN_WORDS words, or more than half of the words in repeated
windows (base); more symbols than one for SYMBOL_WORDS words; more than
LINE_PERCENT % repeated lines; words shorter or longer on average than WORD_CHARS.

Defined cases: null and empty texts have no words and fail the base rule; a
document without a host is judged by the base rule alone; rows that repeat count
each; an empty table gives an empty table; further columns are ignored.  Windows
are told apart by a 64-bit hash within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.common import written

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_WORDS = 10
LINE_PERCENT = 30
WORD_CHARS = (2, 12)
#: A host whose shrunk failure rate is above this loses its documents.
HOST_RATE = 0.5
#: Weight of the prior, in documents: bounds of the fit by moments.
PRIOR = (2.0, 1_000_000.0)


def _sorted_windows(h: Column) -> Column:
    """The windows ``h`` as (h, p) ordered by hash, none if all differ."""
    at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.slice(at, 1, 0)).otherwise(at)


def _repeated_words(at: Column) -> Column:
    """Words in windows that the text holds twice or more; ``at`` as ordered above."""
    def same(i: Column, x: Column) -> Column:
        return F.coalesce(F.get(at, i).getField("h") == x.h, F.lit(False))

    twice = F.filter(at, lambda x, i: same(i - 1, x) | same(i + 1, x))
    return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x.p, x.p + 1, x.p + 2)))))


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    body = F.coalesce(F.col("text"), F.lit(""))
    word = F.transform(F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.translate(x, SPACE, "") != "")
    solid = F.translate(body, SPACE, "")
    d = docs.select(*keep, word.alias("ws"), lines.alias("lines"), F.length(solid).cast("long").alias("word_chars"),
                    (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    windows = F.when(F.size("ws") >= 3, F.transform(F.sequence(F.lit(0), F.size("ws") - 3), lambda i: F.xxhash64(
        F.get(F.col("ws"), i), F.get(F.col("ws"), i + 1), F.get(F.col("ws"), i + 2)))).otherwise(
            F.array().cast("array<bigint>"))
    numbers = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    d = d.select(*keep, "word_chars", "n_symbols", F.size("ws").cast("long").alias("n_words"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("h"))
    return (d.select(*keep, *numbers, _sorted_windows(F.col("h")).alias("at"))
            .select(*keep, *numbers, _repeated_words(F.col("at")).cast("long").alias("n_repeat_words")))


def base_rule() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def any_rule() -> Column:
    """The base rule or another one."""
    low, high = WORD_CHARS
    return (base_rule() | (SYMBOL_WORDS * F.col("n_symbols") > F.col("n_words"))
            | (100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines"))
            | (F.col("word_chars") < low * F.col("n_words")) | (F.col("word_chars") > high * F.col("n_words")))


def host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_kept) from (host, failed)."""
    per = written(judged.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("host_docs"), F.count(F.when(F.col("failed"), 1)).alias("host_failed")), "host-counts")
    rate = F.col("host_failed") / F.col("host_docs")
    prior = per.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, spread = prior.m or 0.0, prior.v or 0.0
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR[1]
    weight = min(max(weight, PRIOR[0]), PRIOR[1])
    shrunk = (F.col("host_failed") + F.lit(mean * weight)) / (F.col("host_docs") + F.lit(weight))
    return per.select(host, "host_docs", "host_failed", shrunk.alias("host_rate"), (shrunk <= HOST_RATE).alias("host_kept"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, host_docs,
    host_failed, kept."""
    d = docs.select("doc_id", F.col(host).alias("source"), "text")
    d = measures(d, "doc_id", "source").withColumn("base_failed", base_rule()).withColumn("failed", any_rule())
    d = written(d, "host-measures")
    out = d.join(host_verdicts(d), "source", "left")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("host_docs", F.lit(0).cast("long")).alias("host_docs"),
        F.coalesce("host_failed", F.lit(0).cast("long")).alias("host_failed"),
        (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT doc_id, p, ws[p : p + 2] AS gram FROM (
    SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS p FROM w WHERE len(ws) >= 3)
), r AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS q
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1) GROUP BY doc_id
), m AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, len(ls) AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m
), f AS (
  SELECT *, base_failed OR {SYMBOL_WORDS} * n_symbols > n_words OR 100 * n_dup_lines > {LINE_PERCENT} * n_lines
    OR word_chars < {WORD_CHARS[0]} * n_words OR word_chars > {WORD_CHARS[1]} * n_words AS failed FROM b
), h AS (
  SELECT source, count(*) AS host_docs, count(*) FILTER (failed) AS host_failed FROM f WHERE source IS NOT NULL GROUP BY source
), p AS (
  SELECT m, greatest({PRIOR[0]}, least({PRIOR[1]}, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE {PRIOR[1]} END)) AS s
  FROM (SELECT avg(host_failed / host_docs) AS m, var_pop(host_failed / host_docs) AS v FROM h)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(host_docs, 0)::BIGINT AS host_docs, coalesce(host_failed, 0)::BIGINT AS host_failed,
       NOT base_failed AND coalesce((host_failed + m * s) / (host_docs + s) <= {HOST_RATE}, true) AS kept
FROM f LEFT JOIN h USING (source), p
"""
