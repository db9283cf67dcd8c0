"""License scan by canonical digest lookup.

A text is brought to canonical form - lower case, copyright lines dropped,
equivalent spellings unified, punctuation and white space collapsed - and the
SHA-256 of the *entire* canonical text is looked up among the digests of known
licence texts.  Documents carry licences in two ways, so two kinds of entire
text are looked up: the whole document, and each of its lines (a one-line
notice).  The known texts are a parameter; the built-in ones are well-known
public notices, short licences and the full texts in ``licenses/``, each with
and without its heading, its appendix and its numbering.

The known digests are one small table (one row per known text, written by hand
or given by the caller); the join is left to the planner.  Where every known
form has a hint word, texts and lines are first cut down to those with such a
word or a spelling of it, which drops nothing: each word of a canonical form
stands in the raw text as it is or as another spelling.  Otherwise every text
and line is looked up.  The SQL twin has the same rules and texts and no such
first cut.

Defined cases: null and empty texts match nothing; a canonical form without
words matches nothing; several known texts with one digest give their smallest
licence id; repeated rows are reported each; empty tables give empty results;
further columns are ignored.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.llm.common import null_safe, row_key, written

# Wordings of public licences and notices.
MIT = (
    "MIT License\nCopyright (c) <year> <holder>\n"
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
ISC = (
    "ISC License\nCopyright (c) <year> <holder>\n"
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
    "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
    "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
#: Names that one-line notices give a licence.
NOTICES = [
    ("Apache-2.0", "the Apache License, Version 2.0"), ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC0-1.0", "CC0 1.0"), ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"), ("ISC", "the ISC License"), ("MIT", "the MIT License"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
]
#: How a notice begins.
BEGINNINGS = ["Licensed under", "Released under", "Distributed under", "This work is licensed under",
              "This software is licensed under", "This program is licensed under"]
KNOWN_LICENSES: list[tuple[str, str]] = [
    *[(i, f"{verb} {name}.") for i, name in NOTICES for verb in BEGINNINGS],
    *[(i, f"SPDX-License-Identifier: {i}") for i, _ in NOTICES],
    ("ISC", ISC), ("MIT", MIT),
]
#: Spellings that count as equal (from, to), on single words.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("favour", "favor"), ("judgement", "judgment"), ("acknowledgement", "acknowledgment"),
    ("noncommercial", "nc"), ("ver", "version"), ("v", "version"), ("https", "http"),
]
#: Words without weight in a notice.
FILLERS = ("the", "version")
#: Words after "copyright" and "(c)" in the prose of a licence, not in a copyright statement.
PROSE = (r"notices?|holders?|owners?|licen[cs](?:e[sd]?|ing)|statements?|permissions?|laws?|interests?|rights?|protections?|"
         r"ownership|disclaimers?|doctrines?|treat(?:y|ies)|and|or|in|on|of|to|is|are|as|if|that|which|for|with|under|"
         r"the\s+(?:software|program|work)")
POINT = r"you|under|any|each|if|in|to|for|it|that|this|such|where|when|no|must"
#: A line that begins so, after marks of a comment, states a copyright ...
STATEMENT = r"^[\x20\x09-\x0D*#/;-]*(copyright[^\p{L}\p{N}_-]*[\x20\x09-\x0D(]|copyright[^\p{L}\p{N}_-]+$|\(c\)|©|all rights reserved)"
#: ... unless it goes on as the prose of a licence does.
SPOKEN = (r"^[\x20\x09-\x0D*#/;-]*(copyright[\x20\x09-\x0D]+(" + PROSE.replace(r"\s", r"[\x20\x09-\x0D]") + r")\b"
          r"|copyright[\x20\x09-\x0D]*[,;.][\x20\x09-\x0D]*\p{L}|copyright[\x20\x09-\x0D]*$"
          r"|\(c\)[\x20\x09-\x0D]*(" + POINT + r")\b)")
#: A text that holds none of these words (nor a spelling of one) is no known licence, if all known ones hold one.
HINTS = r"licen[cs]|permission|spdx|redistribution"
#: Full texts in ``licenses/``, and the headings that may be missing.
FULL_TEXTS = {"Apache-2.0": "", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
              "CC0-1.0": "Creative Commons Legal Code", "GPL-2.0": "", "GPL-3.0": "", "MPL-2.0": ""}
APPENDIX = "END OF TERMS AND CONDITIONS"


def full_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the full licences, in the forms they come in."""
    out = [("ISC", ISC.removeprefix("ISC License\n")), ("MIT", MIT.removeprefix("MIT License\n"))]
    for name, heading in FULL_TEXTS.items():
        text = resources.files("cordon.llm").joinpath("licenses", f"{name}.txt").read_text("utf-8")
        forms = {text, text.removeprefix(heading)}
        if APPENDIX in text:
            body = text[:text.index(APPENDIX)]
            forms |= {body, body + APPENDIX}
        if name.startswith("BSD"):
            forms |= {re.sub(r"(?m)^\d\. ", "* ", t) for t in forms}
        out += [(name, t) for t in sorted(forms)]
    return out


def canonical(text: Column) -> Column:
    """The canonical form of an entire text."""
    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n", -1),
                     lambda x: ~x.rlike(STATEMENT) | x.rlike(SPOKEN))
    t = F.trim(F.regexp_replace(F.array_join(lines, " "), r"[^\p{L}\p{N}]+", " "))
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS for x in pair])
    ws = F.transform(F.split(t, " "), lambda w: F.coalesce(F.try_element_at(same, w), w))
    return F.array_join(F.filter(ws, lambda w: ~w.isin(*FILLERS)), " ")


def known_forms(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(form, license_id) of the known texts (license_id, text)."""
    if known is None:
        known = spark.createDataFrame(KNOWN_LICENSES + full_texts(), "license_id string, text string")
    return known.select("license_id", canonical(F.col("text")).alias("form")).filter("form <> ''")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, whole_text_license (NULL if none),
    license_ids (distinct, sorted), n_license_lines."""
    forms = written(known_forms(docs.sparkSession, known), "licence-forms")
    look = forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))
    hinted = forms.filter(~F.col("form").rlike(HINTS)).isEmpty()

    def worth(column: str) -> Column:
        return F.lower(column).rlike(HINTS) if hinted else F.col(column).isNotNull()

    d = docs.select("doc_id", "text", row_key(F.col("text")).alias("rk"))
    cand = d.filter(worth("text"))
    whole = (cand.select("doc_id", "rk", F.sha2(canonical(F.col("text")), 256).alias("digest"))
             .join(look, "digest").select("doc_id", "rk", F.col("license_id").alias("whole"),
                                          F.lit(None).cast("string").alias("line")))
    line = F.explode(F.split("text", "\n", -1))
    lines = (cand.select("doc_id", "rk", line.alias("line")).filter(worth("line"))
             .select("doc_id", "rk", F.sha2(canonical(F.col("line")), 256).alias("digest"))
             .join(look, "digest").select("doc_id", "rk", F.lit(None).cast("string").alias("whole"),
                                          F.col("license_id").alias("line")))
    # rows that repeat doc_id and text would add up; count each text once
    rows = d.groupBy("doc_id", "rk").agg(F.count("*").alias("copies"))
    found = whole.unionByName(lines).groupBy("doc_id", "rk").agg(
        F.min("whole").alias("whole_text_license"), F.count("line").alias("n"),
        F.array_sort(F.array_union(F.collect_set("whole"), F.collect_set("line"))).alias("license_ids"))
    out = null_safe(rows, found, ["doc_id", "rk"], "left")
    out = out.select("doc_id", "whole_text_license", F.array_join("license_ids", ",").alias("license_ids"),
                     F.coalesce(F.col("n") / F.col("copies"), F.lit(0)).cast("long").alias("n_license_lines"), "copies")
    return out.select("doc_id", "whole_text_license", F.coalesce("license_ids", F.lit("")).alias("license_ids"),
                      "n_license_lines", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("one")).drop("one")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(col: str) -> str:
    lines = (f"list_filter(string_split(lower(coalesce({col}, '')), chr(10)), lambda x: "
             f"NOT regexp_matches(x, {_sql_text(STATEMENT)}) OR regexp_matches(x, {_sql_text(SPOKEN)}))")
    base = rf"trim(regexp_replace(array_to_string({lines}, ' '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    same = "MAP {" + ", ".join(f"{_sql_text(a)}: {_sql_text(b)}" for a, b in SPELLINGS) + "}"
    drop = ", ".join(_sql_text(w) for w in FILLERS)
    return (f"array_to_string(list_filter(list_transform(string_split({base}, ' '), "
            f"lambda w: coalesce({same}[w], w)), lambda w: w NOT IN ({drop})), ' ')")


ORACLE = f"""
WITH known AS (
  SELECT sha256(form) AS digest, min(i) AS license_id FROM (SELECT i, {_sql_canonical('t')} AS form
  FROM (VALUES {', '.join(f'({_sql_text(i)}, {_sql_text(t)})' for i, t in KNOWN_LICENSES + full_texts())}) AS k(i, t))
  WHERE form <> '' GROUP BY 1
), whole AS (
  SELECT doc_id, license_id FROM (SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM documents)
  JOIN known USING (digest)
), line AS (
  SELECT doc_id, license_id FROM (
    SELECT doc_id, sha256({_sql_canonical('ln')}) AS digest
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS ln FROM documents)) JOIN known USING (digest)
), ids AS (
  SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS s
  FROM (SELECT * FROM whole UNION SELECT * FROM line) GROUP BY doc_id
)
SELECT d.doc_id, whole.license_id AS whole_text_license, coalesce(ids.s, '') AS license_ids,
       coalesce(c.n, 0)::BIGINT AS n_license_lines
FROM documents d LEFT JOIN whole USING (doc_id) LEFT JOIN ids USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM line GROUP BY doc_id) c USING (doc_id)
"""
