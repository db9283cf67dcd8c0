"""Vector code compression, sharded clusters and host rules against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cordon.llm import host_rules, sharded_clusters, vector_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, code string, cluster int, vector int, distance string"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, 2, "d") for i, v, lab in rows], SCHEMA).repartition(3)


def odd_vectors(width, n=150, seed=1, size=1.0):
    rnd = random.Random(seed)
    rows = [(10 * i, [rnd.choice([-size, 0.0, size, rnd.uniform(-size, size)]) for _ in range(width)], rnd.choice([1, 2, None]))
            for i in range(n)]
    rows += [rows[1], rows[1], (10_001, rows[2][1], 2)]  # repeated rows, equal vectors
    v = [0.5] * width
    return rows, [(1, None, 1), (2, [None, *v[1:]], 1), (3, [NAN, *v[1:]], 1), (4, [INF, *v[1:]], 2), (5, [-INF, *v[1:]], None)]


@given(st.integers(1, 70), st.integers(1, 9), st.integers(1, 5), st.integers(0, 2 ** 32))
@settings(max_examples=60, deadline=None)
def test_exact_products(inner, n, m, seed):
    rnd = np.random.default_rng(seed)
    for size in (3, 1 << 20, vectors.LIMIT):
        a, b = rnd.integers(-size, size, (n, inner)), rnd.integers(-size, size, (m, inner))
        if size < vectors.LIMIT or inner <= 64:
            assert (vectors.exact_dot(a, b) == a @ b.T).all()
    bits = vectors.limb_bits(inner)
    assert inner * (2 ** bits) ** 2 <= 2 ** 53
    parts = vectors.limbs(a, bits)
    assert (sum(x.astype(np.int64) << (bits * i) for i, x in enumerate(parts)) == a).all()


def floor32(x, scale):
    return math.floor(float(np.float32(x)) * scale)


def brute_codes(rows, scale=4096, rounds=6):
    ints = [(i, [floor32(x, scale) for x in v], lab) for i, v, lab in rows]
    w = len(ints[0][1]) // 8
    first = sorted((x for x in ints if x[0] is not None), key=lambda x: x[:2])[:16]
    books = [[x[1][p * w:(p + 1) * w] for x in first] for p in range(8)]

    def assign():
        out = []
        for _, x, _ in ints:
            own = []
            for p in range(8):
                d = [sum((a - b) ** 2 for a, b in zip(x[p * w:(p + 1) * w], e)) for e in books[p]]
                own.append((d.index(min(d)), min(d)))
            out.append(own)
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(8):
            for e in range(len(books[p])):
                own = [x[1][p * w:(p + 1) * w] for x, g in zip(ints, got) if g[p][0] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    by_label = Counter()
    for (_, _, lab), g in zip(ints, got):
        by_label[lab] += sum(d for _, d in g)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{e:02x}" for e, _ in g), sum(d for _, d in g), by_label[lab], sha)
                  for (i, _, lab), g in zip(ints, got))


@pytest.mark.parametrize("width,size", [(16, 1.0), (24, 30000.0)])
def test_vector_codes_brute_force(spark, width, size):
    rows, bad = odd_vectors(width, size=size)
    got = vector_codes.compress(frame(spark, rows + bad))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == brute_codes(rows)


def test_vector_codes_edges(spark):
    rows, bad = odd_vectors(16, n=5)
    few = vector_codes.compress(frame(spark, rows)).collect()  # fewer vectors than entries
    assert sorted(map(tuple, few)) == brute_codes(rows)
    none = vector_codes.compress(frame(spark, rows).filter("false"))
    assert none.count() == 0 and vector_codes.compress(frame(spark, bad)).count() == 0
    other = [(None, rows[0][1], 1), (700, [1.0] * 8, 1), (701, [], 1), (702, [1.0] * 9, 9)]
    got = {r.vec_id: r for r in vector_codes.compress(frame(spark, rows + other)).collect()}
    assert got[None].code is not None and got[700].code is None and got[701].error is None
    assert got[702].label_error is None and got[700].label_error == got[None].label_error
    assert vector_codes.compress(frame(spark, rows).drop("label")).count() == len(rows)
    with pytest.raises(Exception, match="do not fit 64 bits"):
        vector_codes.compress(frame(spark, [(1, [1e30] * 16, 1)])).count()


def brute_clusters(rows, scale=1024, rounds=10):
    ints = [(i, [floor32(x, scale) for x in v]) for i, v, _ in rows]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in ints if i is not None)[:8]
    cent = [x for _, x in seeds]

    def assign():
        out = []
        for _, x in ints:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cent]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for k in range(len(cent)):
            own = [x for (_, x), (c, _) in zip(ints, got) if c == k]
            if own:
                cent[k] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    per = Counter()
    for c, d in got:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i if i is not None else -1), c, d, per[c], sum(per.values()), sha[c]) for (i, _), (c, d) in zip(ints, got))


def plain(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in map(tuple, df.collect()))


@pytest.mark.parametrize("block,chunk,size", [(16, 4096, 1.0), (7, 20, 1.0), (64, 50, 5000.0)])
def test_clusters_brute_force(spark, block, chunk, size):
    rows, bad = odd_vectors(64, n=120, size=size)
    rows.append((None, rows[3][1], 1))
    got = sharded_clusters.cluster(frame(spark, rows + bad + [(900, [1.0] * 63, 1), (901, [], 1)]), block=block, chunk=chunk)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert plain(got) == brute_clusters(rows)


def test_clusters_edges(spark):
    rows, bad = odd_vectors(64, n=3)
    assert plain(sharded_clusters.cluster(frame(spark, rows))) == brute_clusters(rows)
    assert sharded_clusters.cluster(frame(spark, rows).filter("false")).count() == 0
    assert sharded_clusters.cluster(frame(spark, [(None, rows[0][1], 1)])).count() == 0
    with pytest.raises(Exception, match="do not fit 64 bits"):
        sharded_clusters.cluster(frame(spark, [(1, [1e30] * 64, 1)])).count()


def brute_measures(text):
    import re
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, covered = defaultdict(list), set()
    for p in range(len(ws) - 2):
        seen[tuple(ws[p:p + 3])].append(p)
    for at in seen.values():
        if len(at) > 1:
            covered |= {q for p in at for q in (p, p + 1, p + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t\r\n", "a", "a a a a", "x y z x y z\nx y z", "# $$ ünï 😀😀 |", "same\nsame\n\nsame\r\nother", "  nbsp x",
         "long words and more of them " * 4000, " ".join(f"w{i}" for i in range(60)), "a b c d " * 14]


def test_host_measures_brute_force(spark):
    rows = [(i, t, f"h{i % 2}", 7, "x") for i, t in enumerate(TEXTS)] + [(3, "a", None, 7, "x"), (None, "a", "h1", 7, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, failed string")
    got = host_rules.judge(docs)
    out = got.collect()
    assert len(out) == len(rows) and host_rules.judge(docs.filter("false")).count() == 0
    want = Counter((d, *brute_measures(t)) for d, t, *_ in rows)
    assert Counter(tuple(r)[:6] for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert {r.host_docs for r in out} == {0, 6, 8}


def test_bad_hosts_take_their_documents(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), "junk " * 90
    rows = [(i, good if i % 10 else bad, f"h{i % 7}") for i in range(700)]
    rows += [(1000 + i, bad if i % 20 else good, "spam") for i in range(200)]
    rows += [(2000, bad, "seen once"), (2001, good, "seen once")]
    got = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for d, t, h in rows:
        assert got[d].kept == (t == good and h != "spam"), (d, h)
    assert got[1000].host_docs == 200 and got[1000].host_failed == 190
