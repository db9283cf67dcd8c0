import datetime as dt

import pytest
from pyspark.sql import functions as F

from cordon.config import TAXI
from cordon.functions import daypart, iso_dow, trip_key, whole_minutes
from cordon.operators import dims


def test_dim_date_taxi_window(spark):
    d = dims.dim_date(spark, TAXI)
    r = d.agg(F.count("*").alias("n"), F.count(F.when(F.col("period") == "post", 1)).alias("post"),
              F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).first()
    assert (r.n, r.post, r.lo, r.hi) == (456, 86, 20240101, 20250331)
    sun = d.filter(F.col("date") == F.lit(dt.date(2024, 1, 7))).first()
    assert sun.dow == 7 and sun.is_weekend == 1 and sun.year_month == "2024-01"
    assert TAXI.expected_months == 15


def test_dim_time_dayparts(spark):
    t = {r.hour: r.daypart for r in dims.dim_time(spark).collect()}
    assert len(t) == 24
    assert t[5] == "Overnight" and t[6] == "AM peak" and t[9] == "AM peak"
    assert t[10] == "Midday" and t[16] == "PM peak" and t[20] == "Evening" and t[23] == "Evening"


def test_decode_tables(spark):
    assert dims.dim_payment(spark, TAXI).count() == 6
    assert {r.ratecode_key for r in dims.dim_ratecode(spark, TAXI).collect()} == {1, 2, 3, 4, 5, 6, 99}
    assert {r.vendor_key for r in dims.dim_vendor(spark, TAXI).collect()} == {1, 2, 6, 7}


def test_scalar_functions(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-01-01 00:00:50' a, timestamp_ntz'2024-01-01 00:01:10' b,
                             date'2024-01-07' d, 7 h""")
    r = df.select(whole_minutes("a", "b").alias("m"), iso_dow("d").alias("w"),
                  daypart(F.col("h")).alias("p"),
                  trip_key(F.lit(1), "a", F.lit(161), F.lit(12.5)).alias("k"),
                  trip_key(F.lit(None), "a", F.lit(161), F.lit(12.5)).alias("nk")).first()
    import hashlib
    assert r.m == 0 and r.w == 7 and r.p == "AM peak"
    assert r.k == hashlib.md5(b"1|2024-01-01 00:00:50.000000|161|12.5").hexdigest().upper()
    assert r.nk is None


def test_trip_keys_differ_where_amounts_differ(spark):
    rows = spark.sql("""SELECT timestamp_ntz'2024-01-01 00:00:50' a, CAST(v AS DECIMAL(14,4)) v
                        FROM VALUES ('10.001'), ('10.004') t(v)""")
    keys = {r.k for r in rows.select(trip_key(F.lit(1), "a", F.lit(161), "v").alias("k")).collect()}
    late = rows.select(trip_key(F.lit(1), F.expr("a + INTERVAL '0.000001' SECOND"), F.lit(161), "v").alias("k"))
    assert len(keys | {r.k for r in late.collect()}) == 4


def test_inline_table_quoting(spark):
    from cordon.operators.dims import inline_table
    rows = [(1, "O'Hare"), (2, "back\\slash"), (3, None)]
    df = inline_table(spark, rows, [("k", "int"), ("v", "string")])
    assert sorted(tuple(r) for r in df.collect()) == rows
    assert inline_table(spark, [], [("k", "int")]).count() == 0


def test_checkpoint_root_reads_setting_or_falls_back():
    """The session's spark.checkpoint.dir is used when set; otherwise a
    private folder is registered with the context (the setting itself is not
    modifiable at run time)."""
    from cordon.plans import scratch

    class Conf:
        def __init__(self, v):
            self.v = v

        def get(self, k, d=None):
            return self.v if k == "spark.checkpoint.dir" else d

    class SC:
        def __init__(self, app, v, master="local[2]"):
            self.applicationId, self._conf, self.dirs, self.master = app, Conf(v), [], master

        def getConf(self):
            return self._conf

        def setCheckpointDir(self, d):
            self.dirs.append(d)

    class S:
        def __init__(self, sc):
            self.sparkContext = sc

    shared = SC("app-shared", "hdfs://cluster/ckpt/")
    assert scratch.checkpoint_root(S(shared)) == "hdfs://cluster/ckpt"
    assert shared.dirs == ["hdfs://cluster/ckpt"]
    local = SC("app-local", None)
    root = scratch.checkpoint_root(S(local))
    assert "cordon-ckpt-" in root and local.dirs == [root]
    assert scratch.checkpoint_root(S(local)) == root and len(local.dirs) == 1
    assert scratch.scratch_path(S(local), "t").startswith(root + "/cordon/app-local/t-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.checkpoint_root(S(SC(f"app-{master}", None, master)))
