"""Randomised check: both de-duplication forms equal a brute-force pick of
the first row per key (order columns ascending, NULLs last, then the rest)."""

import random

from cordon.operators.fact import dedup

KEYS = ("k1", "k2")
ORDER = ("o1", "o2")


def brute(rows):
    best = {}

    def sort_key(r):
        out = []
        for c in ORDER + ("x",):
            out += [r[c] is None, r[c] if r[c] is not None else 0]
        return out

    for r in rows:
        k = (r["k1"], r["k2"])
        if k not in best or sort_key(r) < sort_key(best[k]):
            best[k] = r
    return sorted(repr(tuple(r[c] for c in ("k1", "k2", "o1", "o2", "x"))) for r in best.values())


def test_dedup_forms_match_brute_force(spark):
    rnd = random.Random(11)
    for trial in range(6):
        rows = []
        for _ in range(rnd.randint(1, 300)):
            r = {"k1": rnd.choice([None, 1, 2, 3]), "k2": rnd.choice([None, "a", "b"]),
                 "o1": rnd.choice([None, 1, 2]), "o2": rnd.choice([None, 0.5, 1.5]),
                 "x": rnd.choice([None, 7, 8])}
            rows.append(r)
            if rnd.random() < 0.2:
                rows.append(dict(r))            # exact copy
        df = spark.createDataFrame([tuple(r.values()) for r in rows],
                                   "k1 int, k2 string, o1 int, o2 double, x int")
        df = df.repartition(rnd.randint(1, 5))
        want = brute(rows)
        for method in ("aggregate", "window"):
            got = dedup(df, KEYS, ORDER + ("x",), method=method).collect()
            assert sorted(repr(tuple(r)) for r in got) == want, (trial, method)
