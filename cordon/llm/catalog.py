"""The named queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cordon.llm import (decontamination, exact_dedup, host_rules, langid, license_scan, line_dedup, ngram_jaccard, packing, quality,
                        sharded_clusters, token_binary, toxicity, vector_codes)
from cordon.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


@query("op1_line_dedup", line_dedup.ORACLE)
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@query("op2_packing")
def op2(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_toxicity")
def op4(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_token_binary")
def op5(spark, sf_dir):
    return token_binary.pack_token_ids(table(spark, sf_dir, "documents"))


@query("op6_ngram_jaccard", ngram_jaccard.ORACLE)
def op6(spark, sf_dir):
    return ngram_jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_decontamination", decontamination.ORACLE)
def op7(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_exact_dedup", exact_dedup.ORACLE)
def op8(spark, sf_dir):
    return exact_dedup.exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


@query("op9_license_scan", license_scan.ORACLE)
def op9(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op10_langid")
def op10(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op11_vector_codes", vector_codes.ORACLE)
def op11(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query("op12_sharded_clusters", sharded_clusters.ORACLE)
def op12(spark, sf_dir):
    return sharded_clusters.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_host_rules", host_rules.ORACLE)
def op13(spark, sf_dir):
    return host_rules.judge(table(spark, sf_dir, "documents"))
