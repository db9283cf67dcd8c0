"""Nulls, empty and long texts, ties, repeated rows, clashing columns."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cordon.llm import (decontamination, exact_dedup, langid, license_scan, line_dedup, ngram_jaccard, packing, quality,
                        token_binary, toxicity)
from cordon.llm.tokens import token_ids

LONG = "word and more text here, " * 4000
SCHEMA = "doc_id long, text string, lang string, n string, score string, ws string, row string"
ROWS = [(1, None), (2, ""), (3, "a"), (4, LONG), (5, "The same text\nwith three\nlines here"),
        (6, "The same text\nwith three\nlines here"), (7, " \n\t\n"), (None, "no id"), (None, None),
        (8, "twice"), (8, "twice"), (9, "one id, a text"), (9, "one id, another text of it"), (10, "\x00ß中文😀 ..")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, "en", "x", "y", "z", "r") for d, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, 1, 0), (6, 1, None), (5, 1, 0), (None, 0, 1), (99, 0, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "word and more text here " * 4), (4, "three lines here"),
                                  (None, "no item")], "item_id long, text string")


def test_line_dedup(spark, odd, none):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_removed"] and got.count() == len(ROWS)
    by = {(r.doc_id, r.text) for r in got.collect()}
    assert (5, "The same text\nwith three\nlines here") in by and (6, "") in by
    assert {(d, t) for d, t in ROWS if d != 6} <= by  # nulls, blanks and repeats are left alone
    assert line_dedup.dedup_lines(none).count() == 0


def brute_lines(docs):
    first, gone = {}, {}
    for d, t in sorted(docs):
        ls = t.split("\n")
        for i in range(len(ls) - 2):
            w = tuple(ls[i:i + 3])
            if any(x.strip(" ") for x in w) and first.setdefault(w, (d, i)) != (d, i):
                gone.setdefault(d, set()).update(range(i, i + 3))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in docs}


def test_line_dedup_keeps_blank_lines_of_any_space(spark):
    rows = [(1, "a\r\n\r\n\r\n\r\nb\r"), (2, "c\r\n\r\n\r\n\r\nd\r"), (3, "e\n\t\n \n\x0b\nf"), (4, "g\n\t\n \n\x0b\nh")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == rows and all(r.n_removed == 0 for r in got)


def test_line_dedup_brute_force(spark):
    rng = np.random.default_rng(5)
    docs = [(i, "\n".join(rng.choice(list("abc ")) for _ in range(rng.integers(1, 12)))) for i in range(60)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(docs)


def test_line_dedup_long_passages(spark):
    """Paragraphs of over 50 words in texts of one or two lines and alone inside longer texts."""
    para, half = " ".join(f"w{i}" for i in range(51)), " ".join(f"h{i}" for i in range(30))
    docs = [(1, f"a\n{para}\nb\nc"), (2, para), (3, f"{para}\nown"), (4, f"d\ne\n{para}\nf"), (5, f"{half}\n{half}x"),
            (6, f"g\n{half}\n{half}x\ni"), (7, half), (8, "short"), (9, "short"), (10, f"{para}\n{para}"), (11, None),
            (12, "x\ny\nz"), (13, "x\ny\nz\nq")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, passages=True).collect()}
    want = dict(docs) | {2: "", 3: "own", 4: "d\ne\nf", 6: "g\ni", 10: "", 13: "q"}
    assert got == want
    import corpus_pipeline
    df = df.selectExpr("doc_id", "text", "length(text) as n_chars")
    assert {r.doc_id: r.text for r in corpus_pipeline.stage_line_dedup(spark, df, "").collect()} == want


def test_decontamination(odd, none, bench):
    got = decontamination.contamination(odd, bench).collect()
    assert len(got) == len(ROWS)
    hit = {(r.doc_id, r.n_words): r for r in got}
    assert hit[3, 1].contaminated and hit[3, 1].items == ["1"]
    assert hit[4, 20000].contaminated and "4" in hit[4, 20000].items
    assert hit[6, 7].n_hit == 3 and not hit[1, 0].contaminated and not hit[2, 0].contaminated
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(odd, bench.filter("false")).filter("n_hit > 0").count() == 0
    assert decontamination.drop_contaminated(odd, bench).columns == odd.columns


def test_decontamination_items_without_id(spark, bench, tmp_dir):
    from oracle_check import duck
    docs = spark.createDataFrame([(1, "no item"), (2, "there is no item, a thing"), (3, "nothing"), (4, None)],
                                 "doc_id long, text string")
    more = bench.unionByName(spark.createDataFrame([(None, "is no"), (None, "")], bench.schema))
    got = {r.doc_id: r for r in decontamination.contamination(docs, more).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1]["items"], got[1].contaminated) == (2, 1, [], True)
    assert (got[2].n_hit, got[2].n_items, got[2]["items"], got[2].contaminated) == (4, 2, ["1"], True)
    assert got[3].n_hit == got[3].n_items == got[4].n_hit == 0 and not got[3].contaminated
    assert {r.doc_id for r in decontamination.drop_contaminated(docs, more).collect()} == {3, 4}
    con = duck(SF001)
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM (VALUES (1, 'no item'), "
                "(2, 'there is no item, a thing'), (3, 'nothing'), (4, NULL)) t(doc_id, text)")
    con.execute("CREATE OR REPLACE TEMP VIEW benchmark AS SELECT * FROM (VALUES (1, 'a'), (2, NULL), (3, ''), "
                "(4, 'three lines here'), (NULL, 'no item'), (NULL, 'is no')) t(item_id, text)")
    rel = con.sql(decontamination.ORACLE)
    rows = decontamination.report(docs, more).select(rel.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(rel.fetchall())


def brute_hits(words, items):
    hit, found = set(), set()
    for k, it in items.items():
        n = min(13, len(it))
        grams = {tuple(it[i:i + n]) for i in range(len(it) - n + 1)} if n else set()
        for p in range(len(words) - n + 1):
            if n and tuple(words[p:p + n]) in grams:
                hit.update(range(p, p + n))
                found.add(str(k))
    return len(hit), sorted(found)


def test_decontamination_brute_force(spark):
    rng = np.random.default_rng(2)
    items = {i: [f"w{x}" for x in rng.integers(0, 40, n)] for i, n in enumerate([1, 5, 12, 13, 14, 30, 30, 40])}
    docs = {}
    for d in range(80):
        ws = [f"w{x}" for x in rng.integers(0, 40, rng.integers(0, 60))]
        it = items[int(rng.integers(2, 8))]
        lo = int(rng.integers(0, len(it)))
        at = int(rng.integers(0, len(ws) + 1))
        docs[d] = ws[:at] + it[lo:lo + int(rng.integers(5, 30))] + ws[at:]
    got = decontamination.contamination(
        spark.createDataFrame([(d, ", ".join(w).upper()) for d, w in docs.items()], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")).collect()
    for r in got:
        assert (r.n_hit, r["items"]) == brute_hits(docs[r.doc_id], items) and r.n_words == len(docs[r.doc_id])


def test_exact_dedup(spark, odd, none, tmp_dir):
    odd.repartition(4).write.parquet(f"{tmp_dir}/d.parquet")
    none.write.parquet(f"{tmp_dir}/n.parquet")
    got = exact_dedup.exact_dedup(spark, f"{tmp_dir}/d.parquet", files_per_batch=1).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.text_sha256): r for r in got}
    empty = [r for r in got if r.group_size == 3]
    assert {r.doc_id for r in empty} == {1, 2, None} and {r.keep_id for r in empty} == {2}
    assert sum(r.group_size == 2 for r in got) == 4 and len(by) == len(ROWS) - 1
    # of every text one row stays, of repeated rows too
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert [r.kept for r in got if r.doc_id == 8].count(True) == 1 and not any(r.kept for r in empty if r.doc_id is None)
    assert exact_dedup.exact_dedup(spark, f"{tmp_dir}/n.parquet").count() == 0


def test_exact_dedup_goes_on_from_its_state(spark, tmp_dir):
    path, ck = f"{tmp_dir}/d.parquet", f"{tmp_dir}/ck"
    spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string").coalesce(1).write.parquet(path)
    assert exact_dedup.stream_state(spark, path, ck).count() == 2
    spark.createDataFrame([(5, "x")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    place = {r.doc_id: r.place for r in exact_dedup._keyed(spark.read.parquet(path)).collect()}
    got = {(r.keep_id, r.keep_place, r.n) for r in exact_dedup.stream_state(spark, path, ck).collect()}
    assert got == {(5, place[5], 2), (2, place[2], 1)}
    assert {r.locator for r in exact_dedup.stream_state(spark, path, ck).collect()} == {min(place[1], place[5]), place[2]}


def test_exact_dedup_splits_collisions(spark, tmp_dir, monkeypatch):
    """A digest under which different texts meet: each text is its own group."""
    path = f"{tmp_dir}/odd [name]"
    rows = [(1, "x"), (2, "x"), (3, "y"), (None, "y"), (None, "z"), (None, "z"), (7, "x"), (7, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    original = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda d: original(d).withColumn("text_sha256", F.lit("same")))
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(spark, path).collect()), key=repr)
    one = {(1, 7, 4, False), (2, 7, 4, False), (7, 7, 4, True), (7, 7, 4, False), (3, 3, 2, True), (None, 3, 2, False),
           (None, None, 2, True), (None, None, 2, False)}
    assert got == sorted(one, key=repr)


def test_license_scan(spark, odd, none):
    extra = [(20, license_scan.MIT.replace("<year> <holder>", "2020 A. Person").upper(), None),
             (21, "Prose.\nreleased under the MIT LICENCE\nLicensed under CC BY-NC 4.0", None)]
    docs = odd.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert got[20].whole_text_license == "MIT" and got[21].license_ids == "CC-BY-NC-4.0,MIT"
    assert got[21].n_license_lines == 2 and got[1].license_ids == "" and got[4].n_license_lines == 0
    assert license_scan.scan_licenses(docs).count() == len(ROWS) + 2
    assert license_scan.scan_licenses(none).count() == 0


def test_license_scan_spellings_of_hint_words(spark):
    """Against every text and line in canonical form, without a prefilter."""
    texts = ["Released under CC BY 4.0.", "Prose.\nDistributed under CC0 1.0.\nmore", "distributed under CC BY-SA 4.0",
             "Distributed under the Apache Licence, ver 2.0", "Released on Monday.", "CC BY 4.0", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = {r.form: r.license_id for r in spark.createDataFrame(license_scan.KNOWN_LICENSES, "license_id string, text string")
             .select("license_id", license_scan.canonical(F.col("text")).alias("form")).collect()}
    forms = docs.select("doc_id", license_scan.canonical(F.col("text")).alias("whole"), F.transform(
        F.split("text", "\n"), license_scan.canonical).alias("lines")).collect()
    want = {r.doc_id: (known.get(r.whole), ",".join(sorted({known[x] for x in [r.whole, *(r["lines"] or [])] if x in known})))
            for r in forms}
    assert want[0] == ("CC-BY-4.0", "CC-BY-4.0") and want[1] == (None, "CC0-1.0") and want[4] == (None, "")
    got = license_scan.scan_licenses(docs).collect()
    assert {r.doc_id: (r.whole_text_license, r.license_ids) for r in got} == want


def test_license_scan_equals_its_twin_on_every_rule(spark, tmp_dir):
    """Copyright lines and prose, spellings, punctuation, full texts in pieces; both definitions on the same rows."""
    import duckdb
    texts = ["Released under the MIT Licence.", "distributed under CC0 1.0", "Licensed under the Apache License, ver 2.0!",
             "Copyright (c) 2020 A\nLicensed under CC BY 4.0.", "(c) you\nLicensed under CC BY 4.0.", "copyright\nspdx",
             "// Copyright 2021 B. Person\n# SPDX-License-Identifier: MPL-2.0", "© 2022\nThis program is licensed under the MIT license",
             "Copyright notice\nLicensed under CC BY 4.0.", "copyright, all\nLicensed under CC BY 4.0.", "CC BY 4.0", "", None,
             "all rights reserved\r\nReleased under the ISC License.\r", "work is licensed under CC0 1.0", license_scan.MIT,
             license_scan.MIT.upper().replace("LICENSE", "LICENCE"), "licensed under cc by-noncommercial 4.0", " Copyrighted\nx"]
    texts += [t for _, t in license_scan.full_texts()] + [t.replace("\n", "\r\n") for _, t in license_scan.full_texts()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_dir}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/d/*.parquet')")
    want = {r[0]: tuple(r[1:]) for r in con.execute(license_scan.ORACLE).fetchall()}
    got = {r[0]: tuple(r)[1:] for r in license_scan.scan_licenses(docs).select(
        "doc_id", "whole_text_license", "license_ids", "n_license_lines").collect()}
    assert got == want
    assert got[3][0] == "CC-BY-4.0" and got[4][0] is None and got[6][0] == "MPL-2.0" and got[14][0] is None and got[0][0] == "MIT"


def test_license_scan_takes_texts_without_hint_words(spark):
    known = spark.createDataFrame([("WTF", "Do what you want to.")], "license_id string, text string")
    docs = spark.createDataFrame([(1, "DO WHAT you want to"), (2, "x\ndo what you want to!"), (3, "other")], "doc_id long, text string")
    got = {r.doc_id: (r.whole_text_license, r.n_license_lines) for r in license_scan.scan_licenses(docs, known).collect()}
    assert got == {1: ("WTF", 1), 2: (None, 1), 3: (None, 0)}


def test_license_scan_full_texts(spark):
    """Full licences, in other line wraps, with a copyright statement and no heading."""
    import re
    import textwrap
    by = "Copyright (c) 2020 A. Person\nAll rights reserved."
    want, texts = {}, []

    def add(name, text):
        want[len(texts)] = name
        texts.append((len(texts), text))

    for name, text in license_scan.full_texts():
        add(name, text)
        for width in (45, 66, 90, 110):
            paragraphs = re.split(r"\n\s*\n", text)
            add(name, "\n\n".join(p if re.search(r"(?i)copyright (\(c\)|\[|<)", p) else
                                  textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in paragraphs))
    isc = license_scan.ISC.replace("Copyright (c) <year> <holder>", "Copyright 2020 A. Person")
    add("ISC", isc.replace("above copyright notice", "above\ncopyright notice"))
    bsd = dict(license_scan.full_texts())["BSD-3-Clause"]
    add("BSD-3-Clause", re.sub(r"(?s)Copyright \(c\).*?reserved\.", by, bsd))
    add("BSD-3-Clause", re.sub(r"(?s)Copyright \(c\).*?reserved\.", "(c) The Regents\nCopyright The Authors", bsd))
    docs = spark.createDataFrame([*texts, (len(texts), by)], "doc_id long, text string")
    got = {r.doc_id: r.whole_text_license for r in license_scan.scan_licenses(docs).collect()}
    assert {k: (v, texts[k][1][:200]) for k, v in got.items() if k in want and v != want[k]} == {}
    assert got[len(texts)] is None and {x for x, _ in license_scan.full_texts()} >= set(license_scan.FULL_TEXTS)


def test_quality(odd, none, labels):
    got = quality.quality(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(ROWS)
    assert got.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality.quality(none, labels).count() == 0
    assert {r.score for r in quality.quality(odd, labels.filter("false")).collect()} == {0.5}


def test_toxicity(odd, none, labels):
    assert toxicity.toxicity(odd, labels).count() == len(ROWS)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_toxic_spans_are_character_offsets(spark):
    texts = [(i, f"ß{'é' * (i % 7)} calm w{i % 90}{' idiot' if i % 2 else ''} {chr(97 + i % 20)}x{i}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, lab).collect()
    text = dict(texts)
    assert all((r.predicted == 1) == (r.doc_id % 2 == 1) for r in got)
    assert {text[r.doc_id][s.start:s.end] for r in got for s in r.spans} == {"idiot"}


def test_marginals_equal_brute_force():
    rng = np.random.default_rng(0)
    n = 33
    emission, row = rng.normal(0, 2, n), np.sort(rng.integers(0, 5, n))
    trans, begin = rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    p, pairs, _ = toxicity.marginals(emission, row, trans, begin, pairs=True)
    want, want_pairs = np.zeros(n), np.zeros((2, 2))
    for r in np.unique(row):
        at = np.flatnonzero(row == r)
        total, m, pr = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=len(at)):
            w = np.exp(begin[tags[0]] + sum(emission[i] * t for i, t in zip(at, tags))
                       + sum(trans[a, b] for a, b in zip(tags, tags[1:])))
            total, m = total + w, m + w * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                pr[a, b] += w
        want[at], want_pairs = m / total, want_pairs + pr / total
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs)


def test_langid(odd, none, spark):
    got = langid.identify(odd)
    assert got.count() == len(ROWS)
    assert {r.lang_pred for r in got.filter("doc_id in (1, 2, 7)").collect()} == {"und"}
    assert langid.identify(none).count() == 0
    no_lang = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(no_lang).collect()} == {"und"}


def brute_bits(train, text):
    """Code length of ``text`` in bits by plain dictionaries."""
    count = {}
    for t in train:
        b = b"\n\n\n" + t.encode()
        for i in range(3, len(b)):
            for k in range(4):
                count.setdefault(b[i - k:i], {}).setdefault(b[i], 0)
                count[b[i - k:i]][b[i]] += 1
    bits, b = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(b)):
        for k in (3, 2, 1, 0, -1):
            if k < 0:
                bits += 8
                break
            seen = count.get(b[i - k:i])
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if b[i] in seen:
                bits -= np.log2(seen[b[i]] / (n + d))
                break
            bits -= np.log2(d / (n + d))
    return bits


def test_code_lengths_equal_brute_force(spark):
    train = {"aa": ["abracadabra abra", "cab", ""], "bb": ["bonbon ñandú", "nobody"]}
    docs = spark.createDataFrame([(x, t) for x, ts in train.items() for t in ts], "lang string, text string")
    got = langid.gram_counts(docs).toPandas()
    model = langid.ContextTrees(["aa", "bb"], got.lang.map({"aa": 0, "bb": 1}).to_numpy(), got.gram.to_numpy(),
                                got.n.to_numpy())
    texts = ["abra", "bonñ nobody", "zzz q", "", "cab\nñ😀"]
    bits = model.code_lengths(pa.array(texts))
    want = [[brute_bits(train[x], t) for x in ("aa", "bb")] for t in texts]
    assert np.allclose(bits, want, atol=1e-3)


def test_trees_of_a_hundred_languages_are_whole_and_small():
    """Every context that a language has seen is kept, also of the smallest one."""
    rng = np.random.default_rng(1)
    langs, lang, gram, n = [f"l{i:03}" for i in range(100)], [], [], []
    for i in range(100):
        letters = rng.integers(97, 123, 4000 if i else 30)
        g = sum(letters[k:len(letters) - 3 + k].astype(np.int64) << (8 * (3 - k)) for k in range(4))
        g, c = np.unique(g, return_counts=True)
        lang, gram, n = [*lang, np.full(len(g), i)], [*gram, g], [*n, c]
    model = langid.ContextTrees(langs, *map(np.concatenate, (lang, gram, n)))
    assert len(model.coded[3].cost) == sum(map(len, gram)) and model.nbytes < 60e6
    small = (model.escaped[3].lang == 0).sum()
    assert small == len(np.unique(gram[0] >> 8))


def brute_classes(docs):
    import re
    sets = {}
    for d, t in docs:
        ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(ws[i:i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("rare, hot, slice_tokens", [(0, -1, 100), (2, 3, 4_000_000), (256, 1000, 300), (1, 1000, 4_000_000)])
def test_jaccard_brute_force(spark, monkeypatch, rare, hot, slice_tokens):
    monkeypatch.setattr(ngram_jaccard, "RARE", rare)
    monkeypatch.setattr(ngram_jaccard, "HOT", hot)
    monkeypatch.setattr(ngram_jaccard, "SLICE_TOKENS", slice_tokens)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 3)
    rng = np.random.default_rng(4)
    shared = [f"s{i}" for i in range(30)]
    docs, d = [(900, None), (901, ""), (902, " \n")], 0
    for g in range(14):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(1, 90)))]
        for _ in range(int(rng.integers(1, 14))):
            ws = list(base)
            for _ in range(int(rng.integers(0, 5))):
                ws[int(rng.integers(0, len(ws)))] = f"x{rng.integers(0, 9)}"
            if rng.random() < 0.4:
                at = int(rng.integers(0, len(ws) + 1))
                ws = ws[:at] + shared + ws[at:]
            docs.append((d, " ".join(ws)))
            d += 1
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(docs)


def test_jaccard_long_near_copies(spark):
    """Many edited copies of texts of 600 to 3,000 words, around the threshold; against brute force."""
    rng = np.random.default_rng(7)
    docs = []
    for g, n in enumerate((600, 900, 1500, 3000)):
        base = [f"g{g}w{i}" for i in range(n)]
        for _ in range(22):
            ws = list(base)
            for at in rng.choice(n, int(rng.integers(0, n // 40)), replace=False):
                ws[at] = f"x{rng.integers(0, 10 ** 6)}"
            docs.append((len(docs), " ".join(ws)))
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_classes(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 8


def test_jaccard_repeated_ids_with_copies(spark):
    """Of a doc_id with several texts only the copied one leaves the index; against brute force over rows."""
    def text(tag, changed=()):
        return " ".join(f"{tag}{'x' if i in changed else ''}{i}" for i in range(60))

    rows = [(3, text("a")), (10, text("a")), (10, text("b")), (15, text("b")), (20, text("b", {59})),
            (30, text("c")), (31, text("c")), (31, text("d", {0})), (32, text("d")), (31, text("e")), (33, text("e", {59})),
            (40, text("f")), (41, text("f")), (42, text("f", {0})), (50, text("g")), (50, text("g")), (51, None)]
    flat = brute_classes([(i, t) for i, (_, t) in enumerate(rows)])
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, c) in flat.items():
        a, b = sorted((find(rows[i][0]), find(rows[c][0])))
        root[b] = a
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted((d, flat[i][0], find(d)) for i, (d, _) in enumerate(rows))
    assert find(20) == 3 and find(33) == 30 and find(42) == 40


def test_jaccard_edges(odd, none):
    got = ngram_jaccard.near_duplicates(odd)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got.collect()}
    assert got.count() == len(ROWS) and by[6, 3] == 5 and by[1, 0] == 1 and by[None, 1] is None
    assert ngram_jaccard.near_duplicates(none).count() == 0
    kept = ngram_jaccard.one_per_class(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and sorted(x for x in ids if x) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert ids.count(None) == 2


def test_packing_and_matrices(odd, none):
    p = packing.pack_documents(odd).toPandas()
    assert len(p[p.doc_tokens == 1]) == 3 and p.length.max() <= 1024
    assert packing.pack_documents(none).count() == 0
    q = token_binary.pack_token_ids(odd, context=64, buffer_tokens=500).toPandas()
    assert q.n_tokens.sum() == p.length.sum() and q.sequence_id.is_unique
    assert token_binary.pack_token_ids(none).count() == 0


def test_matrices_follow_the_vocabulary(spark, tmp_dir):
    """Width of the ids by the vocabulary's largest id; written and read back."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    big = {f"w{i}": i for i in range(70_000)}
    t = Tokenizer(models.WordLevel({**big, "?": 70_000}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(f"{tmp_dir}/big.json")
    docs = spark.createDataFrame([(1, "w3 w69999 w66000"), (2, None), (3, "zzz")], "doc_id long, text string").coalesce(1)
    rows = token_binary.pack_token_ids(docs, context=8, end_id=5, vocabulary=f"{tmp_dir}/big.json")
    (row,) = token_binary.write_matrices(rows, f"{tmp_dir}/m", f"{tmp_dir}/big.json", 5).collect()
    ids = token_binary.read_matrix(row.ids, row.id_type).tolist()
    assert row.id_type == "<u4" and sorted(ids) == sorted([3, 69999, 66000, 5, 5, 70_000, 5, 5])
    small = token_binary.write_matrices(token_binary.pack_token_ids(docs), f"{tmp_dir}/s")
    assert {r.id_type for r in small.collect()} == {"<u2"} and small.count() == 1


def naive_best_fit(lengths, context):
    rows = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        free = [context - sum(lengths[j] for j in r) for r in rows]
        fit = [f for f in free if f >= lengths[i]]
        if fit:
            rows[len(free) - 1 - free[::-1].index(min(fit))].append(i)
        else:
            rows.append([i])
    return rows


@given(st.lists(st.integers(1, 16), min_size=1, max_size=40))
@settings(max_examples=80, deadline=None)
def test_best_fit_equals_a_naive_one(lengths):
    got = token_binary.best_fit_decreasing(np.array(lengths), 16)
    free = sorted(16 - sum(lengths[i] for i in r) for r in got)
    assert free == sorted(16 - sum(lengths[i] for i in r) for r in naive_best_fit(lengths, 16))
    assert sorted(i for r in got for i in r) == list(range(len(lengths)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_packers_keep_every_piece(lengths):
    for rows in (token_binary.best_fit_decreasing(np.array(lengths, int), 64),
                 [w for _, w in packing.pack(lengths, (16, 32, 64))],
                 [w for _, w in packing.pack(lengths, (16, 32, 64), promote=False)]):
        assert sorted(i for w in rows for i in w) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in w) <= 64 for w in rows)
    for tier, w in packing.pack(lengths, (16, 32, 64), promote=False):
        assert sum(lengths[i] for i in w) <= tier


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", " \n", "\t", "'s", "é", "中文", "<|endoftext|>", "123", "!!",
                                 "　", "\x85", "\x1c", "\xa0", ".", "😀", "\r\n"]), max_size=14))
def test_pieces_encode_like_the_whole_text(parts):
    import public_tokenizers
    from tokenizers import Tokenizer
    text = "".join(parts)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_ids().encode([text])[0], "<u4").tolist() == whole
