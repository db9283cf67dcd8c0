"""Line de-duplication by overlapping three-line windows (DataFrame only).

A text is split at ``\\n``.  Every run of three consecutive lines is a window,
known by two independent 64-bit hashes.  Windows that occur more than once in
the whole table are found with one map-side combined aggregation; of each, the
occurrence smallest by (doc_id, row key, position) stays and every later one
marks its three lines.  The marked positions of a document are merged and its
text is rebuilt from the other lines.

With ``passages``, runs of one and of two lines are windows too where they hold
more than PASSAGE_WORDS words, so a long paragraph is found alone, in short and
in long texts.  The pipeline does this; ``op1_line_dedup`` keeps to windows of
three lines, which its SQL twin defines.

No passage is lost: a removed line is covered by a window that also occurs at
an earlier place, and that order is well founded.

Defined cases: a null text stays null (no lines); texts of fewer than three
lines have no window of three and stay as they are without ``passages``; windows of three blank lines
(white space only, carriage returns and tabs included) are no evidence and are
never counted; rows that repeat doc_id and text are one
occurrence, so all of them get the same result; rows that repeat a doc_id with
another text are told apart by a hash of the text; an empty table gives an
empty table; further columns pass through.  A document whose lines all go
keeps its row with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.common import null_safe, row_key

WINDOW_LINES = 3
#: With ``passages``, shorter windows count if they hold more words than this.
PASSAGE_WORDS = 50


#: White space; a line of nothing else is blank.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def _lines(col):
    return F.split(F.coalesce(col, F.lit("")), "\n", -1)


def line_windows(docs: DataFrame, text: str = "text", key: str = "doc_id", passages: bool = False) -> DataFrame:
    """(doc, rk, pos, lines, w1, w2): one row per window."""
    d = docs.select(F.col(key).alias("doc"), row_key(F.col(text)).alias("rk"), _lines(F.col(text)).alias("ls"))
    shortest = 1 if passages else WINDOW_LINES
    d = d.filter(F.size("ls") >= shortest).select(
        "doc", "rk",
        F.transform("ls", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("ls", lambda x: F.xxhash64(F.lit("second"), x)).alias("b"),
        F.transform("ls", lambda x: F.translate(x, SPACE, "") != "").alias("full"),
        *([F.transform("ls", lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda v: v != ""))).alias("words")]
          if passages else []))

    def windows(n):
        def window(i):
            at = [i + k for k in range(n)]
            if n == WINDOW_LINES:
                counts = F.get(F.col("full"), at[0]) | F.get(F.col("full"), at[1]) | F.get(F.col("full"), at[2])
            else:
                counts = sum((F.get(F.col("words"), j) for j in at), F.lit(0)) > PASSAGE_WORDS
            return F.struct(
                i.alias("pos"),
                F.lit(n).alias("lines"),
                F.xxhash64(*[F.get(F.col("a"), j) for j in at]).alias("w1"),
                F.xxhash64(*[F.get(F.col("b"), j) for j in at]).alias("w2"),
                counts.alias("full"))

        found = F.transform(F.sequence(F.lit(0), F.size("a") - n), window)
        return found if n == shortest else F.when(F.size("a") >= n, found).otherwise(F.slice(windows(shortest), 1, 0))

    every = [windows(n) for n in range(shortest, WINDOW_LINES + 1)]
    w = d.select("doc", "rk", F.explode(F.concat(*every)).alias("w"))
    return w.filter("w.full").select("doc", "rk", "w.pos", "w.lines", "w.w1", "w.w2")


def removed_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", passages: bool = False) -> DataFrame:
    """(doc, rk, gone): the merged positions of lines that later occurrences cover."""
    w = line_windows(docs, text, key, passages)
    first = (w.groupBy("lines", "w1", "w2")
             .agg(F.min(F.struct("doc", "rk", "pos")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    later = w.join(first, ["lines", "w1", "w2"]).filter(F.struct("doc", "rk", "pos") > F.col("first"))
    return later.groupBy("doc", "rk").agg(F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("pos", "lines")), lambda p: F.sequence(p.pos, p.pos + p.lines - 1)))).alias("gone"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", passages: bool = False) -> DataFrame:
    """``docs`` with ``text`` rebuilt, plus n_lines and n_removed (names already
    taken by the input are replaced)."""
    taken = {"n_lines", "n_removed"}
    keep = [c for c in docs.columns if c not in taken]
    d = docs.select(F.struct(*keep).alias("row"), F.col(key).alias("doc"), row_key(F.col(text)).alias("rk"))
    j = null_safe(d, removed_lines(docs, text, key, passages), ["doc", "rk"], "left")
    body = F.col("row").getField(text)
    j = j.withColumn("ls", _lines(body))
    left = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), F.col("gone"))
    rebuilt = F.array_join(F.transform(left, lambda i: F.get(F.col("ls"), i)), "\n")
    out = [F.when(F.col("gone").isNull(), body).otherwise(rebuilt).alias(c) if c == text
           else F.col("row").getField(c).alias(c) for c in keep]
    return j.select(*out,
                    F.when(body.isNull(), F.lit(0)).otherwise(F.size("ls")).cast("long").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), w AS (
  SELECT doc_id, p AS pos, ls[p:p+2] AS win
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls) - 2)) AS p FROM l WHERE len(ls) >= 3)
  WHERE regexp_matches(ls[p] || ls[p+1] || ls[p+2], '[^\x20\x09-\x0D]')
), later AS (
  SELECT doc_id, pos FROM w
  QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT doc_id, list_distinct(flatten(list([pos, pos + 1, pos + 2]))) AS g FROM later GROUP BY doc_id
)
SELECT d.doc_id,
  CASE WHEN gone.g IS NULL THEN d.text
       ELSE array_to_string(list_transform(list_filter(generate_series(1, len(l.ls)),
              lambda i: NOT list_contains(gone.g, i)), lambda i: l.ls[i]), chr(10)) END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(l.ls) END::BIGINT AS n_lines,
  coalesce(len(gone.g), 0)::BIGINT AS n_removed
FROM documents d JOIN l USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
