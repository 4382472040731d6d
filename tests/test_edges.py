"""Empty inputs and nulls through the operators."""

import datetime as dt

from pyspark.sql import functions as F

from martlet.operators import joins as J
from martlet.operators import stats
from martlet.operators import transforms as tf
from martlet.operators.ranking import global_ntile, global_row_number
from martlet.operators.scan import running


def _empty(spark, schema="g string, o long, x double"):
    return spark.createDataFrame([], schema)


def test_empty_inputs_do_not_fail(spark):
    e = _empty(spark)
    assert global_row_number(e, ["o"]).count() == 0
    assert global_ntile(e, 4, ["o"]).count() == 0
    assert running(e, {"s": ("sum", "x")}, ["g"], ["o"]).count() == 0
    assert stats.bin_(e, "x").count() == 0
    assert stats.density(e, "x", groupby=["g"]).count() == 0
    assert tf.aggregate(e, {"n": ("count",), "m": ("median", "x")}, ["g"]).count() == 0
    assert tf.window(e, {"rn": ("row_number",)}, sort=["o"], groupby=["g"]).count() == 0
    assert tf.window(e, {"rn": ("row_number",), "c": ("sum", "x")}, sort=["o"], groupby=["g"],
                     ignore_peers=True, distributed=True).count() == 0
    s = spark.createDataFrame([], "occurrence timestamp_ntz")
    ev = spark.createDataFrame([(1, dt.datetime(2020, 1, 1))], "id int, ts timestamp_ntz")
    assert J.asof(ev, "ts", s, as_="prev").first().prev is None


def test_nulls_are_kept_and_skipped(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), (None, 4, 4.0)],
                               "g string, o long, x double")
    agg = {r.g: r for r in tf.aggregate(df, {"n": ("count",), "v": ("valid", "x"), "s": ("sum", "x")},
                                        ["g"]).collect()}
    assert agg["a"].n == 3 and agg["a"].v == 2 and agg["a"].s == 4.0 and agg[None].n == 1
    b = stats.bin_(df, "x", maxbins=4)
    assert b.filter(F.col("x").isNull()).first()["bin_x"] is None
    r = {row.o: row.s for row in running(df, {"s": ("sum", "x")}, ["g"], ["o"]).collect()}
    assert r[1] == 1.0 and r[2] == 1.0 and r[3] == 4.0 and r[4] == 4.0
    j = tf.joinaggregate(df, {"m": ("max", "x")}, ["g"])
    assert {row.o: row.m for row in j.collect()} == {1: 3.0, 2: 3.0, 3: 3.0, 4: 4.0}


def test_single_row_groups(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 7.0)], "g string, o long, x double")
    w = tf.window(df, {"pr": ("percent_rank",), "cd": ("cume_dist",), "nt": ("ntile", None, 3),
                       "lag": ("lag", "x", 1)}, sort=["o"], groupby=["g"], distributed=True)
    for row in w.collect():
        assert row.pr == 0.0 and row.cd == 1.0 and row.nt == 1 and row.lag is None
    q = stats.quantile_bucket(df, "x", 4, ["g"])
    assert q.count() == 2
