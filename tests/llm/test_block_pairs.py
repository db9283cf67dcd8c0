"""A pair of texts that share many index entries leaves one block."""

import numpy as np

from cordon.llm import ngram_jaccard


def rows_and_pairs(spark, monkeypatch, members):
    made = []
    plain = ngram_jaccard.map_arrow

    def counted(df, run, schema):
        out = plain(df, run, schema)
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_jaccard, "map_arrow", counted)
    docs = sorted({d for _, d, _ in members})
    member = spark.createDataFrame(members, "entry long, doc long, comp long")
    size = spark.createDataFrame([(d, 100, 100, 20, 20, None) for d in docs],
                                 "doc long, lo long, hi long, cls_lo int, cls_hi int, small binary")
    pairs = {tuple(r) for r in ngram_jaccard.block_pairs(member, size).collect()}
    return made, pairs


def test_pair_leaves_its_smallest_shared_entry_only(spark, monkeypatch):
    members = [(e, d, d) for e in range(-25, 25) for d in range(20)]
    made, pairs = rows_and_pairs(spark, monkeypatch, members)
    assert pairs == {(a, b) for a in range(20) for b in range(a + 1, 20)}
    assert made == [190]  # not 190 for each of the 50 entries


def test_no_pair_is_lost_when_lowest_entries_differ(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "LOWEST", 2)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 3)
    rng = np.random.default_rng(7)
    members = sorted({(int(e), int(d), int(d) % 9) for e, d in zip(rng.integers(-40, 40, 400), rng.integers(0, 30, 400), strict=True)})
    made, pairs = rows_and_pairs(spark, monkeypatch, members)
    comp = {d: c for _, d, c in members}
    by_entry = {}
    for e, d, _ in members:
        by_entry.setdefault(e, []).append(d)
    want = {(a, b) for own in by_entry.values() for a in own for b in own if a < b and comp[a] != comp[b]}
    assert pairs == want
    assert made[0] >= len(want)
