"""Scans, selection, blockwise windows and LOESS against plain Python."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.operators import transforms as tf
from martlet.operators.dwindow import window_distributed
from martlet.operators.loess import loess
from martlet.operators.scan import running
from martlet.operators.selecting import exact_quantiles
from martlet.operators.stats import exponential_both


def rows_of(n, seed=1):
    """(g, id, day, x): a hot group, a small one, a null one; nulls, NaN and equal days."""
    rnd = random.Random(seed)
    return [(rnd.choice(["hot"] * 8 + ["b", None]), k, k // rnd.choice([1, 4, 40]) if k % 3 else k // 40,
             rnd.choice([None, math.nan, math.inf, 0.0, *[rnd.randint(-50, 50) / 4 for _ in range(12)]])) for k in range(n)]


def frame_of(spark, rows, partitions=6):
    return spark.createDataFrame(rows, "g string, id long, day long, x double").repartition(partitions)


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) <= 1e-9 * max(1, abs(a))


def test_running_ops_both_ways(spark):
    rows = rows_of(1500)
    got = running(frame_of(spark, rows), {"rn": ("row_number",), "s": ("sum", "id"), "near": ("last", "x"), "early": ("first", "x"), "next": ("last", "x", "after"),
                                          "low": ("min", "id", "after"), "ema": ("decayed", "x", 0.1), "n": ("count", "x")}, ["g"], ["id"]).collect()
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {}
    for rs in by.values():
        near = early = nxt = None
        s = n = ema = 0
        for k, r in enumerate(rs):
            s += r[1]
            if r[3] is not None:
                near, early, n = r[3], r[3] if early is None else early, n + 1
                if not math.isnan(r[3]):
                    ema = 0.9 * ema + 0.1 * r[3]
            want[r[1]] = [k + 1, s, near, early, None, r[1], ema, n]
        for r in reversed(rs):
            nxt = nxt if r[3] is None else r[3]
            want[r[1]][4] = nxt
    for r in got:
        if math.isinf(want[r.id][6]) or math.isnan(want[r.id][6]):
            want[r.id][6] = r.ema
        assert all(same(a, b) for a, b in zip(want[r.id], [r.rn, r.s, r.near, r.early, r.next, r.low, r.ema, r.n], strict=True)), (r, want[r.id])


def test_quantiles_equal_numpy(spark):
    rnd = random.Random(2)
    rows = [("hot" if k % 3 else f"g{k % 50}", k, 0, rnd.choice([None, float(rnd.randint(0, 9)), rnd.random() * 100])) for k in range(4000)] + [("none", -1, 0, None)]
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = frame_of(spark, rows)
    by = defaultdict(list)
    for g, _, _, x in rows:
        if x is not None:
            by[g].append(x)
    got = {r.g: r.q for r in exact_quantiles(df, F.col("x"), probs, ["g"], "q").collect()}
    assert set(got) == set(by)
    for g, q in got.items():
        assert np.allclose(q, np.quantile(by[g], probs), rtol=1e-12, atol=1e-12)
    every = exact_quantiles(df, F.col("x"), probs, as_="q").first().q
    assert np.allclose(every, np.quantile(sum(by.values(), []), probs))
    out = {r.g: r for r in tf.aggregate(df, {"m": ("median", "x"), "n": ("count",), "q": ("q3", "x")}, ["g"]).collect()}
    assert out["none"].m is None and out["none"].n == 1 and same(out["hot"].m, np.median(by["hot"])) and same(out["hot"].q, np.quantile(by["hot"], 0.75))
    assert "percentile" not in tf.quantile(df, "x", groupby=["g"])._jdf.queryExecution().optimizedPlan().toString()


FRAMES = [(-2, 2), (None, 0), (None, -3), (None, 2), (0, None), (3, None), (-4, None), (None, None), (1, 3), (-5, -2), (0, 0)]


def brute(op, param, values):
    seen = [v for v in values if v is not None]
    finite = [v for v in seen if not math.isnan(v)]
    if op == "count":
        return len(values)
    if op == "valid":
        return len(finite)
    if op == "missing":
        return len(values) - len(seen)
    if op in ("first_value", "last_value", "nth_value"):
        k = {"first_value": 0, "last_value": len(values) - 1}.get(op, (param or 1) - 1)
        return values[k] if 0 <= k < len(values) else None
    if not seen:
        return None
    if op == "min":  # NaN is the largest value
        return min(finite) if finite else math.nan
    if op == "max":
        return math.nan if len(finite) < len(seen) else max(finite)
    return sum(seen) if op == "sum" else sum(seen) / len(seen)


@pytest.mark.parametrize("peers", [False, True])
def test_blockwise_windows_equal_brute_force(spark, peers):
    rows = rows_of(500, 7)
    ops = [("sum", "x"), ("mean", "x"), ("count",), ("valid", "x"), ("missing", "x"), ("min", "x"), ("max", "x"), ("first_value", "x"), ("last_value", "x"), ("nth_value", "x", 3)]
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        by[r[0]].append(r)
    df = frame_of(spark, rows)
    for chunk in (FRAMES[:4], FRAMES[4:8], FRAMES[8:]):
        spec = {f"{o[0]}{i}": (o[0], o[1] if len(o) > 1 else None, o[2] if len(o) > 2 else None, fr) for i, fr in enumerate(chunk) for o in ops}
        got = {r.id: r for r in window_distributed(df, spec, ["day"], ["g"], tiebreak=["id"], ignore_peers=not peers, block=16).collect()}
        assert len(got) == len(rows)
        for rs in by.values():
            for k, r in enumerate(rs):
                for i, (lo, hi) in enumerate(chunk):
                    a, b = 0 if lo is None else max(0, k + lo), len(rs) - 1 if hi is None else min(len(rs) - 1, k + hi)
                    if peers and a <= b:
                        while a > 0 and rs[a - 1][2] == rs[a][2]:
                            a -= 1
                        while b < len(rs) - 1 and rs[b + 1][2] == rs[b][2]:
                            b += 1
                    values = [x[3] for x in rs[a:b + 1]] if a <= b else []
                    for o in ops:
                        want = brute(o[0], o[2] if len(o) > 2 else None, values)
                        assert same(got[r[1]][f"{o[0]}{i}"], want), (r, o, (lo, hi), got[r[1]][f"{o[0]}{i}"], want)


@pytest.mark.parametrize("peers", [False, True])
def test_frames_without_end_are_read_from_their_end(spark, peers):
    # Spark goes through the rest of the block for every row of a frame that begins at a row and has no end
    df = frame_of(spark, rows_of(300, 5))
    ops = {f"{op}{i}": (op, "x", 3 if op == "nth_value" else None, (lo, None))
           for i, lo in enumerate((-2, 0, 3)) for op in ("min", "max", "sum", "count", "valid", "first_value", "last_value", "nth_value")}
    out = window_distributed(df, ops, ["day"], ["g"], tiebreak=["id"], ignore_peers=not peers, block=16)
    frames = re.findall(r"specifiedwindowframe\(RowFrame, ([^,]+), unboundedfollowing", out._jdf.queryExecution().analyzed().toString(), re.I)
    assert not [lo for lo in frames if "unbounded" not in lo.lower()], frames
    # null, where a frame begins behind its group's end
    last = out.groupBy("g").agg(F.max_by(F.struct("first_value2", "sum2", "count2"), F.struct("day", "id")).alias("x")).select("x.*").collect()
    assert len(last) == 3 and all((r.first_value2, r.sum2, r.count2) == (None, None, 0) for r in last)


def test_blockwise_ranks_offsets_and_odd_ops(spark):
    df = frame_of(spark, rows_of(700, 3))
    ops = {"rn": ("row_number",), "rk": ("rank",), "dr": ("dense_rank",), "pr": ("percent_rank",), "cd": ("cume_dist",), "nt": ("ntile", None, 7),
           "b": ("lag", "id", 20), "f": ("lead", "id", 3), "sd": ("stdev", "id", None, (-9, 9)), "md": ("median", "id", None, (-3, 0)), "dv": ("variance", "id", None, (0, 5))}
    a = window_distributed(df, ops, ["day"], ["g"], tiebreak=["id"], block=32).orderBy("id").collect()
    b = tf.window(df, ops, ["day"], ["g"], tiebreak=["id"], ignore_peers=True).orderBy("id").collect()
    for x, y in zip(a, b, strict=True):
        assert all(same(x[c], y[c]) for c in ops), (x, y)
    with pytest.raises(ValueError):
        window_distributed(df, {"m": ("median", "id")}, ["day"], ["g"])
    assert tf.window(df, {"m": ("max", "id")}, ["day"], ["g"], frame=(-1, 1), tiebreak=["id"]).count() == 700


def test_exponential_and_bounds_by_name(spark):
    rows = [r for r in rows_of(600, 9) if r[3] is None or not math.isinf(r[3])]
    df = frame_of(spark, rows)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)

    def average(values, alpha):
        e, z, n = None, 0.0, 0
        for v in values:
            if v is not None and not math.isnan(v):
                e, z, n = v if e is None else alpha * v + (1 - alpha) * e, alpha * v + (1 - alpha) * z, n + 1
        return e, z / (1 - (1 - alpha) ** n) if n else None

    out = {r.g: r for r in tf.aggregate(df, {"e": ("exponential", "x", 0.3, ["id"]), "z": ("exponentialb", "x", 0.3, ["id"]), "lo": ("ci0", "x"), "hi": ("ci1", "x"),
                                             "n": ("count",)}, ["g"]).collect()}
    win = {r.id: r for r in tf.window(df, {"e": ("exponential", "x", 0.05), "z": ("exponentialb", "x", 0.05), "f": ("exponential", "x", 0.3, (-4, 0))}, ["id"], ["g"],
                                      ignore_peers=True).collect()}
    for g, rs in by.items():
        e, z = average([r[3] for r in rs], 0.3)
        assert same(out[g].e, e) and same(out[g].z, z) and out[g].n == len(rs)
        for k, r in enumerate(rs):
            e, z = average([x[3] for x in rs[:k + 1]], 0.05)
            f, _ = average([x[3] for x in rs[max(0, k - 4):k + 1]], 0.3)
            assert same(win[r[1]].e, e) and same(win[r[1]].z, z) and same(win[r[1]].f, f)
    joined = tf.joinaggregate(df, {"z": ("exponentialb", "x", 0.3, ["id"])}, ["g"]).collect()
    assert len(joined) == len(rows) and all(same(r.z, out[r.g].z) for r in joined)
    assert exponential_both(df.limit(0), "x", ["id"], groupby=["g"]).collect() == []
    with pytest.raises(ValueError):
        tf.aggregate(df, {"e": ("exponential", "x")}, ["g"])


def brute_loess(points, bandwidth):
    """points: (x, y); a window of nearest x values for each distinct x."""
    xs = sorted({x for x, _ in points})
    w = {x: sum(1 for a, _ in points if a == x) for x in xs}
    s = {x: sum(b for a, b in points if a == x) for x in xs}
    need = max(bandwidth * len(points), 2.0)
    out = {}
    for x in xs:
        near, held = [], 0
        for a in sorted(xs, key=lambda a: (abs(a - x), a)):
            if held >= need:
                break
            near.append(a)
            held += w[a]
        h = max(abs(a - x) for a in near)
        k = {a: (1 - (abs(a - x) / h) ** 3) ** 3 if h > 0 else 1.0 for a in near}
        m = sum(k[a] * w[a] for a in near)
        xm, ym = sum(k[a] * w[a] * a for a in near) / m, sum(k[a] * s[a] for a in near) / m
        sxx = sum(k[a] * w[a] * (a - xm) ** 2 for a in near)
        sxy = sum(k[a] * (a - xm) * s[a] for a in near)
        out[x] = ym + (sxy / sxx if sxx > 1e-12 * m * h * h else 0.0) * (x - xm)
    return out


@pytest.mark.parametrize("bandwidth", [0.05, 0.3, 1.0])
def test_loess_equals_brute_force(spark, bandwidth):
    rnd = random.Random(5)
    rows = [(g, float(x), math.sin(x / 9) + rnd.random()) for g, n in (("hot", 300), ("b", 40), (None, 1), ("two", 2)) for x in (rnd.choice([rnd.randint(0, 60), rnd.random() ** 5 * 60]) for _ in range(n))]
    df = spark.createDataFrame([*rows, ("hot", None, 1.0), ("hot", 1.0, None), ("hot", math.nan, 1.0)], "g string, x double, y double")
    got = {(r.g, r.x): r.y for r in loess(df, "x", "y", ["g"], bandwidth).collect()}
    n = 0
    for g in {r[0] for r in rows}:
        for x, y in brute_loess([(a, b) for k, a, b in rows if k == g], bandwidth).items():
            assert abs(got[g, x] - y) < 1e-7, (g, x, got[g, x], y)
            n += 1
    assert len(got) == n


def test_loess_keeps_every_x(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("x"), (F.sin(F.col("id") / 50) + F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("y"))
    got = {r.x: r.y for r in loess(df, "x", "y", bandwidth=0.02).collect()}
    assert len(got) == 5000
    pts = {r.x: r.y for r in df.collect()}
    for x in (0.0, 17.0, 2500.0, 4080.0, 4999.0):
        near = sorted(pts, key=lambda a: (abs(a - x), a))[:100]
        want = brute_loess([(a, pts[a]) for a in near], 1.0)[x]
        assert abs(got[x] - want) < 1e-8
