"""Cases that were wrong once: nulls, NaN, text columns, odd zones, rule shapes, equal rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.functions import expr as E
from martlet.operators import joins, selections, stats
from martlet.operators import transforms as tf
from martlet.sources import io


@pytest.mark.parametrize("frame", [(None, 0), (-2, 2), (-3, -1), (0, None)])
def test_distributed_frames_with_nulls_and_nan(spark, frame):
    rnd = random.Random(1)
    rows = [(i, i % 3, rnd.choice([None, None, math.nan, math.inf, 1.5, -3.0, -math.inf] if i % 3 else [None, None, 2.0])) for i in range(90)]
    df = spark.createDataFrame(rows, "i int, g int, x double").repartition(7)
    ops = {"s": ("sum", "x"), "m": ("mean", "x"), "c": ("count", "x")}
    got = {r.i: r for r in tf.window(df, ops, sort=["i"], groupby=["g"], frame=frame, ignore_peers=True, distributed=True).collect()}
    for g in range(3):
        group = [r for r in rows if r[1] == g]
        for p, (i, _, _) in enumerate(group):
            lo = 0 if frame[0] is None else max(0, p + frame[0])
            hi = len(group) if frame[1] is None else max(0, p + frame[1] + 1)
            v = [x for _, _, x in group[lo:hi] if x is not None]
            for have, want in ((got[i].s, sum(v) if v else None), (got[i].m, sum(v) / len(v) if v else None)):
                assert (have is None) == (want is None)
                assert want is None or have == pytest.approx(want, nan_ok=True)
            assert got[i].c == len(v)


def test_peer_frame_mean_counts_values_only(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, None), (1, 2, None)], "g int, o int, x double")
    got = tf.window(df, {"m": ("mean", "x")}, ["o"], ["g"], (0, 0), distributed=True).collect()
    assert sorted((r.o, r.m) for r in got if r.o == 1) == [(1, 1.0)] * 2 and [r.m for r in got if r.o == 2] == [None]


def test_distributed_refuses_what_it_cannot(spark):
    df = spark.createDataFrame([(1, 1.0)], "g int, x double")
    with pytest.raises(ValueError):
        tf.window(df, {"m": ("median", "x")}, sort=["x"], groupby=["g"], ignore_peers=True, distributed=True)


def test_argmin_argmax_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, math.nan), (4, 7.0)], "k int, x double")
    r = tf.aggregate(df, {"lo": ("argmin", "x"), "hi": ("argmax", "x")}).first()
    assert r.lo.k == 2 and r.hi.k == 4


def test_type_tests_on_text(spark):
    df = spark.createDataFrame([("abc",), ("12",), (None,)], "s string")
    got = df.select(E.is_valid("s").alias("v"), E.is_nan("s").alias("n"), E.is_finite("s").alias("f"), selections.field_valid("s").alias("w")).collect()
    assert [r.v for r in got] == [True, True, False] and [r.f for r in got] == [False, True, False] and [r.w for r in got] == [True, True, False]


def test_lookup_default_only_where_nothing_matches(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, None, "a"), (2, 4, None)], "k int, n int, s string")
    got = {r.k: (r.n, r.s) for r in joins.lookup(left, right, "k", default={"n": 0, "s": "?"}).collect()}
    assert got == {1: (None, "a"), 2: (4, None), 3: (0, "?")}
    assert {r.k: r.n for r in joins.lookup(left, right, "k", fields=["n"], default="none").collect()} == {1: None, 2: "4", 3: "none"}


def test_yearly_rule_with_months_keeps_the_day(spark):
    got = [r.occurrence.date() for r in cal.recurrence(spark, "YEARLY", dt.datetime(2020, 9, 2), count=4, bymonth=[1, 3]).orderBy("occurrence").collect()]
    assert got == [dt.date(2021, 1, 2), dt.date(2021, 3, 2), dt.date(2022, 1, 2), dt.date(2022, 3, 2)]


def test_rules_beyond_fifty_years(spark):
    got = cal.recurrence(spark, "YEARLY", dt.datetime(2000, 2, 29), count=20, bymonth=[2], bymonthday=[29])
    assert got.count() == 20 and got.agg(F.max("occurrence")).first()[0].year == 2076
    with pytest.raises(ValueError):
        cal.recurrence(spark, "DAILY", dt.datetime(2000, 1, 1))


def test_last_week_of_the_year(spark):
    from dateutil import rrule as R
    start, until = dt.datetime(2018, 1, 1), dt.datetime(2022, 12, 31)
    got = [r.occurrence for r in cal.recurrence(spark, "YEARLY", start, until=until, byweekno=[-1], byweekday=[0]).orderBy("occurrence").collect()]
    assert got == list(R.rrule(R.YEARLY, dtstart=start, until=until, byweekno=-1, byweekday=R.MO))


def test_half_hour_overlap_is_ambiguous(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 4, 7, 1, 45),), (dt.datetime(2024, 4, 7, 3, 0),)], "w timestamp_ntz")
    got = [r.a.ambiguous for r in df.select(cal.dst_audit("w", "Australia/Lord_Howe").alias("a")).collect()]
    assert got == [True, False]


def test_null_dates_are_rejected_not_lost(spark):
    ok, bad = cal.normalise_dates(spark.createDataFrame([("2020-01-02",), (None,), ("x",)], "s string"), "s")
    assert ok.count() == 1 and bad.count() == 2


def test_easter_known_dates(spark):
    known = {1961: (4, 2), 1999: (4, 4), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2024: (3, 31), 2038: (4, 25), 2285: (3, 22)}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    assert {r.y: (r.e.month, r.e.day) for r in df.select("y", cal.easter("y").alias("e")).collect()} == known


@pytest.mark.parametrize("spec,value,want", [(".2s", 42e6, "42M"), ("s", 42e6, "42.0000M"), (".2s", 999.9, "1.0k"), (".3s", 0.00125, "1.25m"),
                                             (".3e", 42.0, "4.200e+1"), (",", 1234.5, "1,234.5"), (",.2f", 1234.5, "1,234.50"), ("d", 3.6, "4")])
def test_number_formats(spark, spec, value, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(E.number_format("x", spec).alias("s")).first().s == want


def test_fingerprint_sees_where_nulls_and_names_are(spark):
    names = {io.content_name(spark.createDataFrame([row], schema)) for row, schema in
             (((None, "x"), "a string, b string"), (("x", None), "a string, b string"), ((None, "x"), "a string, c string"))}
    assert len(names) == 3


def test_bootstrap_draws_equal_rows_apart(spark):
    df = spark.createDataFrame([(1.0,)] * 1000 + [(2.0,)] * 1000, "x double")
    r = stats.bootstrap_ci(df, "x").first()
    assert 1.45 < r.ci0 < 1.5 < r.ci1 < 1.55


def test_constant_column_has_one_bucket(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r.bucket for r in stats.quantize_bucket(df, "x", 4).collect()] == [0, 0, None]


def test_fractional_sequence(spark):
    assert [round(r.data, 6) for r in io.sequence_source(spark, 0, 0.5, 0.1).orderBy("data").collect()] == [0, 0.1, 0.2, 0.3, 0.4]


def test_fact_files_are_few(spark, tmp_path):
    df = spark.range(20_000).select(F.format_string("2020-%02d", (F.col("id") % 12 + 1)).alias("year_month"), "id").repartition(16)
    io.write_parquet(df, str(tmp_path / "f"))
    assert len(list((tmp_path / "f").rglob("*.parquet"))) <= 3 * 12


def test_deep_trees_and_cycles(spark):
    from martlet.operators.hierarchy import ancestors, tree_ancestors
    chain = spark.range(1, 201).select(F.col("id").alias("node"), (F.col("id") - 1).alias("parent"))
    got = {r.node: r.ancestors for r in tree_ancestors(chain).collect()}
    assert got[200] == list(range(200, -1, -1)) and got[1] == [1, 0] and len(got) == 200
    with pytest.raises(ValueError):
        ancestors(spark.createDataFrame([(1, 2), (2, 1)], "node int, parent int"))
