"""Every query of the package against its SQL twin, or against brute force."""

import zlib

import numpy as np
import pytest
from conftest import SF001, SF01
from oracle_check import duck
from pyspark.sql import functions as F

from cordon.llm import catalog

WITH_SQL = sorted(catalog.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql_twin(spark, name):
    df = catalog.queries()[name](spark, SF001)
    rel = duck(SF001).sql(catalog.oracle_sql()[name])
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == want


def whole_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: t.encode(x or "", add_special_tokens=False).ids for d, x in texts}


@pytest.fixture(scope="module")
def ids(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    return whole_ids([(r.doc_id, r.text) for r in rows])


def test_op2_packs_every_id_once(spark, ids):
    p = catalog.queries()["op2_packing"](spark, SF001).toPandas()
    assert set(p.doc_id) == set(ids)
    for d, g in p.sort_values("start").groupby("doc_id"):
        own = np.array([*ids[d], 0], "<u4")
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]]
        assert g.length.sum() == len(own) and (g.doc_tokens == len(own)).all()
        for r in g.itertuples():
            assert zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    padding = 0
    for _, g in p.sort_values("offset").groupby("sequence_id"):
        n = g.length.sum()
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and n <= 1024
        padding += 0 if n & (n - 1) == 0 else 1024 - n
    assert padding < 0.02 * p.length.sum()


def test_op5_round_trip(spark, ids):
    q = catalog.queries()["op5_token_binary"](spark, SF001).toPandas()
    assert q.sequence_id.is_unique
    parts = {}
    for r in q.itertuples():
        a = np.frombuffer(r.ids, "<u2")
        assert len(a) == 2048 and r.cu_seqlens[-1] == r.n_tokens
        assert list(r.position_resets) == list(r.cu_seqlens[:-1])
        assert (a[r.n_tokens:] == 50256).all()
        for i, (d, s) in enumerate(zip(r.segment_doc_ids, r.segment_starts)):
            parts.setdefault(d, []).append((s, a[r.cu_seqlens[i]:r.cu_seqlens[i + 1]].tolist()))
    whole = {d: [x for _, part in sorted(v) for x in part] for d, v in parts.items()}
    assert whole == {d: [*v, 50256] for d, v in ids.items()}


def accuracy(spark, name, label):
    got = catalog.queries()[name](spark, SF01)
    want = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = got.join(want, "doc_id").filter("held_out").select("score", "predicted", "y").toPandas()
    assert rows.score.between(0, 1).all()
    return (rows.predicted == rows.y).mean(), rows


def test_op3_held_out_accuracy(spark):
    right, rows = accuracy(spark, "op3_quality", "quality")
    assert len(rows) > 50 and right > 0.9


def test_op4_held_out_accuracy(spark):
    right, rows = accuracy(spark, "op4_toxicity", "toxic")
    assert len(rows) > 50 and right > 0.9


def test_op10_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = catalog.queries()["op10_langid"](spark, SF01).join(docs, "doc_id").filter("held_out").toPandas()
    assert len(rows) > 150 and (rows.lang == rows.lang_pred).mean() > 0.95
    assert rows.score.between(0, 1).all()


def test_held_out_rows_are_the_agreed_ones(spark):
    from cordon.llm.common import crc32_mod
    d = spark.range(50).select(F.col("id").alias("doc_id"), crc32_mod(F.col("id"), 5).alias("m"))
    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 5 for r in d.collect())


def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = docs
    for _, stage in cp.STAGES[:-1]:
        n, cols = kept.count(), kept.columns
        kept = spark.createDataFrame(
            stage(spark, kept, SF001).collect(), docs.schema)
        assert kept.columns == cols and 0 < kept.count() <= n
    want = cp.STAGES[-1][1](spark, kept, SF001)
    got = cp.run(spark, SF001)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
