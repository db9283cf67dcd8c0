"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.common import written

_SPAN = float(1 << 63)


def unit_hash(doc_id: Column) -> Column:
    """A fixed number in [0, 1) for a doc_id."""
    return F.xxhash64(F.lit("sample"), doc_id).bitwiseAND(F.lit((1 << 63) - 1)) / F.lit(_SPAN)


def bounded(rows: DataFrame, label: str, cap: int) -> DataFrame:
    """About ``cap`` rows of each label value at most, chosen by a hash of
    doc_id at a rate computed from the counts of all rows."""
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    rate = written(counts.select(F.col(label), F.least(F.lit(1.0), F.lit(float(cap)) / F.col("__n")).alias("__rate")),
                   f"rate-{label}")
    return (rows.join(rate, label).filter(unit_hash(F.col("doc_id")) < F.col("__rate")).drop("__rate"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                   cap: int) -> tuple[DataFrame, float]:
    """(doc_id, text, label) of a bounded sample of the labelled rows that are
    ``usable`` (a doc_id labelled twice counts by its largest label), and the
    log-odds by which the sample favours label 0 over all usable rows."""
    own = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).filter(usable))
    few = written(bounded(own, "label", cap), f"sample-{label}")
    shift = 0.0
    for rows, sign in ((own, 1.0), (few, -1.0)):
        for r in rows.groupBy("label").count().collect():  # two rows
            shift += sign * (1 if r.label else -1) * math.log(r["count"])
    texts = (docs.select("doc_id", "text").join(few, "doc_id")
             .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label"))
    return texts, shift
