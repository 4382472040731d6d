"""Documented example cases (FIXTURES.md) and brute-force checks of custom operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.functions import expr as E
from martlet.functions import timeunits as tu
from martlet.operators import joins as J
from martlet.operators import stats
from martlet.operators.loess import loess
from martlet.operators import transforms as tf
from martlet.sources import io


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_type_inference(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), ("B", 4)], "foo string, bar int")
    m = {r.column: r.measure for r in io.infer_measure_types(df).collect()}
    assert m == {"foo": "nominal", "bar": "quantitative"}


def test_lerp(spark):
    assert one(spark, E.lerp(F.array(F.lit(0.0), F.lit(50.0)), 0.5)) == 25.0


def test_object_merge(spark):
    a = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    b = F.create_map(F.lit("a"), F.lit(3))
    assert one(spark, E.merge(a, b)) == {"a": 3, "b": 2}


def test_month_names(spark):
    assert one(spark, tu.month_format(F.lit(0))) == "January"
    assert one(spark, tu.month_abbrev_format(F.lit(0))) == "Jan"
    assert one(spark, tu.day_format(F.lit(0))) == "Sunday"


def test_calendar_shift(spark):
    t = F.lit(dt.datetime(2018, 4, 9, 13, 37)).cast("timestamp_ntz")
    got = one(spark, cal.calendar_shift(t, hours=25, day=1, weekday=(0, 1)))
    assert got == dt.datetime(2018, 4, 2, 14, 37)


def test_monthly_recurrence_skips_short_months(spark):
    occ = cal.recurrence(spark, "MONTHLY", dt.datetime(2014, 12, 31), count=4)
    got = [r.occurrence.date() for r in occ.orderBy("occurrence").collect()]
    assert got == [dt.date(2014, 12, 31), dt.date(2015, 1, 31), dt.date(2015, 3, 31), dt.date(2015, 5, 31)]


def test_imaginary_wall_time(spark):
    w = F.lit(dt.datetime(2017, 3, 12, 2, 30)).cast("timestamp_ntz")
    r = one(spark, cal.dst_audit(w, "America/New_York"))
    assert r.imaginary and not r.ambiguous and r.resolved == dt.datetime(2017, 3, 12, 3, 30)
    amb = one(spark, cal.dst_audit(F.lit(dt.datetime(2017, 11, 5, 1, 30)).cast("timestamp_ntz"),
                                   "America/New_York"))
    assert amb.ambiguous and not amb.imaginary


def test_running_total(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(100)], "x int, y double")
    rows = tf.window(df, {"cum": ("sum", "y")}, sort=["x"], frame=(None, 0)).orderBy("x").collect()
    acc = 0.0
    for r in rows:
        acc += r.y
        assert r.cum == acc


def test_easter_known_dates(spark):
    df = spark.createDataFrame([(2024,), (2025,), (1961,)], "y int")
    got = {r.y: (r.w, r.o) for r in df.select("y", cal.easter("y", 3).alias("w"),
                                                cal.easter("y", 2).alias("o")).collect()}
    assert got[2024] == (dt.date(2024, 3, 31), dt.date(2024, 5, 5))
    assert got[2025] == (dt.date(2025, 4, 20), dt.date(2025, 4, 20))
    assert got[1961][0] == dt.date(1961, 4, 2)


def test_month_diff(spark):
    a = F.lit(dt.datetime(2015, 3, 1)).cast("timestamp_ntz")
    b = F.lit(dt.datetime(2014, 1, 31)).cast("timestamp_ntz")
    r = one(spark, cal.month_diff(a, b))
    assert (r.years, r.months) == (1, 1) and r.seconds == 86400.0  # Jan 31 + 13 months = Feb 28, +1 day


def test_nice_bins():
    assert stats.nice_bins(0.01, 490.02, 10) == (0.0, 500.0, 50.0)
    lo, hi, step = stats.nice_bins(3, 97, 10)
    assert step == 10 and lo == 0 and hi == 100


def test_bin_max_value_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    b = stats.bin_(df, "v", maxbins=2)
    got = sorted(r[0] for r in b.select("bin_v").collect())
    assert got == [0.0, 5.0, 5.0]


def test_asof_matches_brute_force(spark):
    import random
    rnd = random.Random(1)
    base = dt.datetime(2020, 1, 1)
    ev = [(i, base + dt.timedelta(hours=rnd.randint(0, 24 * 200))) for i in range(300)]
    sch = sorted({base + dt.timedelta(days=rnd.randint(-10, 210)) for _ in range(25)})
    df = spark.createDataFrame(ev, "id int, ts timestamp_ntz")
    s = spark.createDataFrame([(t,) for t in sch], "occurrence timestamp_ntz")
    back = {r.id: r.prev for r in J.asof(df, "ts", s, as_="prev").collect()}
    fwd = {r.id: r.nxt for r in J.asof(df, "ts", s, direction="forward", as_="nxt").collect()}
    for i, t in ev:
        assert back[i] == max((x for x in sch if x <= t), default=None)
        assert fwd[i] == min((x for x in sch if x >= t), default=None)


def test_tolerance_join_matches_brute_force(spark):
    import random
    rnd = random.Random(2)
    base = dt.datetime(2021, 5, 1)
    a = [(i, base + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(150)]
    b = [(j, base + dt.timedelta(seconds=rnd.randint(0, 5000))) for j in range(150)]
    A = spark.createDataFrame(a, "a int, ta timestamp_ntz")
    B = spark.createDataFrame(b, "b int, tb timestamp_ntz")
    got = {(r.a, r.b) for r in J.tolerance_join(A, B, "ta", "tb", 60).collect()}
    want = {(i, j) for i, x in a for j, y in b if abs((x - y).total_seconds()) <= 60}
    assert got == want


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 3, 3, 4, 4, 5, 9]], "v double")
    d = stats.density(df, "v", steps=400, extent=(-10.0, 20.0)).orderBy("value").collect()
    step = d[1].value - d[0].value
    assert abs(sum(r.density for r in d) * step - 1) < 0.01


def test_regression_poly_recovers_coefficients(spark):
    df = spark.createDataFrame([(float(x), 2.0 - 3.0 * x + 0.5 * x * x) for x in range(-20, 21)],
                               "x double, y double")
    p = stats.regression_params(df, "x", "y", "quad").first()
    assert all(abs(a - b) < 1e-6 for a, b in zip(p.coef, [2.0, -3.0, 0.5]))
    assert abs(p.rSquared - 1) < 1e-9


def test_loess_on_a_line_is_the_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 1) for x in range(50)], "x double, y double")
    for r in loess(df, "x", "y").collect():
        assert abs(r.y - (3 * r.x + 1)) < 1e-6


def test_impute_fills_missing_keys(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 3, 30.0), ("b", 2, 5.0)], "g string, k int, v double")
    out = {(r.g, r.k): r.v for r in stats.impute(df, "v", "k", ["g"], method="mean").collect()}
    assert out[("a", 2)] == 20.0 and out[("b", 1)] == 5.0 and len(out) == 6


def test_limit_rows_guard(spark):
    io.limit_rows(spark.range(10), 10)
    with pytest.raises(io.MaxRowsError):
        io.limit_rows(spark.range(11), 10)


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"), dt.datetime(2020, 1, 2, 3, 4, 5))], "v double, t timestamp_ntz")
    r = io.sanitize(df).first()
    assert r.v is None and r.t == "2020-01-02T03:04:05.000"
    with pytest.raises(ValueError):
        io.sanitize(spark.sql("SELECT INTERVAL '1' DAY AS d"))


def test_number_and_time_format(spark):
    assert one(spark, E.number_format(F.lit(1234567.891), ",.2f")) == "1,234,567.89"
    assert one(spark, E.number_format(F.lit(0.256), ".1%")) == "25.6%"
    t = F.lit(dt.datetime(2024, 3, 5, 7, 8, 9)).cast("timestamp_ntz")
    assert one(spark, tu.time_format(t, "%Y-%m-%d %H:%M")) == "2024-03-05 07:08"
    assert one(spark, tu.timeunit(t, "yearmonth")) == dt.datetime(2024, 3, 1)
    assert one(spark, tu.timeunit(t, "monthdate")) == dt.datetime(2012, 3, 5)


def test_arrays_and_strings(spark):
    a = F.array(*[F.lit(x) for x in [5, 1, 4]])
    assert one(spark, E.slice_(a, -2)) == [1, 4]
    assert one(spark, E.indexof(a, 4)) == 2
    assert one(spark, E.sequence(0, 10, 3)) == [0, 3, 6, 9]
    assert one(spark, E.truncate(F.lit("abcdefghij"), 5)) == "abcd…"
    assert one(spark, E.pad(F.lit("ab"), 5, "*", "center")) == "*ab**"
    assert one(spark, E.parse_float(F.lit(" 3.5kg"))) == 3.5
    assert math.isclose(one(spark, E.quantile_normal(E.cumulative_normal(F.lit(1.3)))), 1.3, abs_tol=1e-5)


def test_geojson_and_inline(spark, tmp_path):
    p = tmp_path / "f.json"
    p.write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"name":"a","v":1},'
                 '"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    g = io.geojson_features(spark, str(p)).first()
    assert g.name == "a" and g.type == "Feature"
    df = io.inline_rows(spark, {"values": [{"a": 1, "b": "x"}]}, "a int, b string")
    assert df.first().b == "x"


def test_rare_cjk_uses_corpus_common_set(spark):
    from martlet.plans import text_profile as G
    docs = spark.createDataFrame([(1, "的的的的的一一是是 plain", "x", "zh"), (2, "的一是鬱鬱鬱鬱鬱鬱鬱鬱", "x", "zh"), (3, "none", "x", "en"), (4, None, "x", "en")],
                                 "doc_id long, text string, source string, lang string")
    given = spark.createDataFrame([("的",), ("一",), ("是",)], "ch string")
    s = {r.doc_id: r.rare_cjk_noise for r in G.noise_scores(docs, cjk_common=given).collect()}
    assert s[1] == 0.0 and s[3] == 0.0  # 9 CJK characters, none rare
    assert abs(s[2] - (8 / 11) / 10) < 1e-12  # 8 of 11 rare: share above 0.5
    # 1000 characters in ordinary use are common however many they are; one odd text is not
    usual = "".join(chr(0x4E00 + k) for k in range(1000))
    odd = "".join(chr(0x9000 + k) for k in range(40))
    docs = spark.createDataFrame([(k, usual, "x", "zh") for k in range(12)] + [(99, odd, "x", "zh")], docs.schema)
    assert G.common_cjk(G.cjk_counts(docs)).count() == 903  # of 12040 occurrences, nine tenths
    s = {r.doc_id: r.rare_cjk_noise for r in G.noise_scores(docs).collect()}
    assert s[0] == 0.0 and s[99] == 0.1


def test_window_without_sort_is_rejected(spark):
    with pytest.raises(ValueError):
        tf.window(spark.range(3), {"rn": ("row_number",)}, sort=None)


def test_text_measures_hand_cases(spark):
    from martlet.plans import text_profile as G
    assert "é" in G.ACCENTED_CHARS and G.ACCENTED_BASES[G.ACCENTED_CHARS.index("é")] == "e"
    assert "ß" not in G.ACCENTED_CHARS and "æ" not in G.ACCENTED_CHARS
    rows = spark.createDataFrame([("aBcDé",), ("éÉ éé",), ("plain ascii text only",)], "t string")
    got = rows.select(G.case_flip_noise(F.col("t")).alias("cf"),
                      G.duplicate_accent_noise(F.col("t")).alias("da")).collect()
    # "aBcDé": alternating run aBcDé has 4 flips -> +4; over 5 chars
    assert abs(got[0].cf - 4 / 5) < 1e-12
    # "éÉ": bases e/E differ and not both upper (0); "éé": same base (+1); 5 chars -> 2*1/5
    assert abs(got[1].da - 2 / 5) < 1e-12
    assert got[2].cf == 0.0 and got[2].da == 0.0
    words = " ".join(["word"] * 11 + ["crÉme", "ça$va"])
    w = spark.createDataFrame([(words,)], "t string").select(G.weird_word_noise(F.col("t")).alias("w")).first().w
    letters = 11 * 4 + 5 + 5
    # "ça$va" holds a symbol (5 chars incl. the symbol); "crÉme" trips no rule
    assert abs(w - 5 / letters) < 1e-12


def test_word_table_matches_column_form(spark):
    from martlet.plans import text_profile as G
    texts = [(1, "word " * 12 + "crÉme ça$va Ü日x"), (2, "ÀÉÎÕÜ àéîõü " * 3), (3, "tiny"),
             (4, "a" * 30 + "é Bonjour tout le monde ici et là-bas encore une fois merci")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    table = {r.doc_id: r.weird_word_noise for r in G.weird_word_table(docs).collect()}
    col = {r.doc_id: r.w for r in docs.select("doc_id", G.weird_word_noise(F.col("text")).alias("w")).collect()}
    for k in col:
        assert abs(table.get(k, 0.0) - col[k]) < 1e-12


def test_loess_matches_brute_force(spark):
    import random

    import numpy as np
    rnd = random.Random(5)
    pts = [(rnd.uniform(0, 100), 0.0) for _ in range(120)]
    pts = [(x, math.sin(x / 9) * 10 + rnd.gauss(0, 1)) for x, _ in pts]
    df = spark.createDataFrame(pts, "x double, y double")
    got = {round(r.x, 9): r.y for r in loess(df, "x", "y", bandwidth=0.3).collect()}
    xs = np.array(sorted(p[0] for p in pts))
    ys = np.array([dict(pts)[x] for x in xs])
    k = max(int(math.ceil(0.3 * len(xs))), 2)
    for i, x0 in enumerate(xs):
        idx = np.argsort(np.abs(xs - x0), kind="stable")[:k]
        h = np.abs(xs[idx] - x0).max()
        w = (1 - (np.abs(xs[idx] - x0) / h) ** 3) ** 3
        W = w.sum()
        xm, ym = (w * xs[idx]).sum() / W, (w * ys[idx]).sum() / W
        b = (w * (xs[idx] - xm) * (ys[idx] - ym)).sum() / (w * (xs[idx] - xm) ** 2).sum()
        assert abs(got[round(x0, 9)] - (ym + b * (x0 - xm))) < 1e-8


def test_sample_is_deterministic_and_whole(spark):
    df = spark.range(0, 5000).withColumn("v", F.col("id") % 7)
    a = [r.id for r in tf.sample(df, n=300, seed=3).collect()]
    b = [r.id for r in tf.sample(df.repartition(5), n=300, seed=3).collect()]
    assert len(a) == 300 and len(set(a)) == 300 and sorted(a) == sorted(b)
    assert tf.sample(df, n=10_000).count() == 5000
    c = [r.id for r in tf.sample(df, n=300, seed=4).collect()]
    assert sorted(a) != sorted(c)


def test_bootstrap_ci_brackets_the_mean_and_is_repeatable(spark):
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    a = {r.g: (r.ci0, r.ci1) for r in stats.bootstrap_ci(df, "v", ["g"], reps=100, seed=9).collect()}
    b = {r.g: (r.ci0, r.ci1) for r in stats.bootstrap_ci(df.repartition(7), "v", ["g"], reps=100, seed=9).collect()}
    means = {r.g: r.m for r in df.groupBy("g").agg(F.avg("v").alias("m")).collect()}
    for g, (lo, hi) in a.items():
        assert lo < means[g] < hi and hi - lo < 60
        assert (lo, hi) == b[g]


def test_content_fingerprint_ignores_row_order(spark):
    df = spark.range(0, 2000).select("id", (F.col("id") % 13).alias("k"))
    a = io.content_fingerprint(df).first()
    b = io.content_fingerprint(df.orderBy(F.desc("id")).repartition(5)).first()
    c = io.content_fingerprint(df.filter(F.col("id") != 5)).first()
    assert (a.rows, a.hash_sum) == (b.rows, b.hash_sum) and a.hash_sum != c.hash_sum


def test_sequence_catalog_and_content_named_output(spark, tmp_path):
    from conftest import SF_SMALL
    assert [r.data for r in io.sequence_source(spark, 2, 11, 3).collect()] == [2, 5, 8]
    cat = io.catalog(spark, SF_SMALL)
    names = {r.name for r in io.catalog_filter(cat, temporal=True, nested=False).collect()}
    assert names == {"orders", "lineitem", "events"}
    df = spark.range(0, 500).select("id", (F.col("id") % 7).alias("k"))
    p1 = io.write_content_named(df, str(tmp_path / "a"))
    p2 = io.write_content_named(df.orderBy(F.desc("id")).repartition(3), str(tmp_path / "b"))
    assert p1.rsplit("/", 1)[1] == p2.rsplit("/", 1)[1]
    assert spark.read.json(p1).count() == 500


def test_impute_with_key_sequence(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 4, 5.0)], "g string, k int, v double")
    out = {r.k: r.v for r in stats.impute(df, "v", "k", ["g"], keyvals={"start": 0, "stop": 6, "step": 2},
                                          method="value", value=-1.0).collect()}
    assert out == {0: 1.0, 2: -1.0, 4: 5.0}


def test_bin_parameters():
    assert stats.nice_bins(0, 97, 10, steps=[7, 11, 25]) == (0, 99, 11)
    lo, hi, step = stats.nice_bins(3, 97, 10, anchor=5)
    assert step == 10 and (5 - lo) % 10 == 0 and lo <= 3 and hi >= 97
    assert stats.nice_bins(0, 1, 10, minstep=0.5)[2] >= 0.5
    assert stats.nice_bins(0, 100, 10, divide=(2,))[2] in (10, 20)


def test_stack_single_output_name(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "g string, k string, v double")
    cols = tf.stack(df, "v", ["g"], sort=["k"], as_="s").columns
    assert "s" in cols and "s_end" in cols
