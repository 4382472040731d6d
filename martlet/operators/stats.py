"""Statistical transforms: bin (T2), density (T3), impute (T4), regression (T12),
boxplot (T22), error extent (T23), scale binning (T26), bootstrap confidence interval (A14) and exponential averages (A16, A17).

Work that grows with the data stays in Spark aggregates: a value is reduced to
per-group sums or to (distinct value, weight) rows before anything else happens.
Only bounded per-group tables (power sums) reach pandas/numpy inside tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .keys import join_on
from .scan import running
from .selecting import exact_quantiles

EPSILON = 1e-14


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _attach(df: DataFrame, per_group: DataFrame, g: list) -> DataFrame:
    """Attach per-group values: an equi-join on the group keys, or, without
    groups, the single row's values as scalar subqueries (no join at all)."""
    if g:
        return join_on(df, per_group, g)
    cols = [c for c in per_group.columns]
    return df.select("*", *[per_group.select(c).scalar().alias(c) for c in cols])


# ---------------------------------------------------------------- T2 bin

def nice_bins(lo: float, hi: float, maxbins: int = 10, step: float | None = None,
              nice: bool = True, minstep: float = 0.0, divide: Sequence[int] = (5, 2),
              base: int = 10, steps: Sequence[float] | None = None,
              anchor: float | None = None) -> tuple[float, float, float]:
    """Bin start, stop and step: a step of 1, 2 or 5 × 10^k giving at most
    ``maxbins`` bins over [lo, hi], the span widened to whole steps. ``steps``
    restricts the choice to the smallest allowed step giving at most ``maxbins``
    bins; ``anchor`` shifts the boundaries so one falls on it."""
    span = hi - lo
    if span == 0:
        span = abs(lo) if lo != 0 else 1.0
    logb = math.log(base)
    if step is None and steps:
        fitting = [x for x in sorted(steps) if x >= minstep and span / x <= maxbins]
        step = fitting[0] if fitting else max(steps)
    if step is None:
        level = math.ceil(math.log(maxbins) / logb)
        step = max(minstep, base ** (round(math.log(span) / logb) - level))
        while math.ceil(span / step) > maxbins:
            step *= base
        for d in divide:
            v = step / d
            if v >= minstep and span / v <= maxbins:
                step = v
    v = math.log(step)
    precision = 0 if v >= 0 else int(-v / logb) + 1
    eps = base ** (-precision - 1)
    if nice:
        v = math.floor(lo / step + eps) * step
        lo = v - step if lo < v else v
        hi = math.ceil(hi / step) * step
    if anchor is not None:
        shift = anchor - (lo + step * math.floor((anchor - lo) / step))
        if shift:
            lo, hi = lo + shift - step, hi + shift
    return lo, hi, step


def bin_expr(c: Column, start: float, stop: float, step: float) -> Column:
    """Bin start for a value; the maximum falls into the last bin; null stays null."""
    v = c.cast("double")
    clamped = F.greatest(F.lit(start), F.least(v, F.lit(stop - step)))
    b = F.lit(start) + F.lit(step) * F.floor(F.lit(EPSILON) + (clamped - F.lit(start)) / F.lit(step))
    return F.when(v.isNull(), F.lit(None)) \
            .when(v < start, F.lit(float("-inf"))) \
            .when(v > stop, F.lit(float("inf"))).otherwise(b)


def bin_(df: DataFrame, field: str, as_: tuple[str, str] | None = None, maxbins: int = 10,
         step: float | None = None, extent: tuple[float, float] | None = None,
         nice: bool = True, **params) -> DataFrame:
    """Add [bin_start, bin_end) columns. The extent (one min/max aggregate) is
    read first; everything else is a column expression. ``params``: base, divide,
    minstep, steps, anchor (see ``nice_bins``)."""
    as_ = as_ or (f"bin_{field}", f"bin_{field}_end")
    if extent is None:
        r = df.agg(F.min(field).alias("lo"), F.max(field).alias("hi")).first()
        extent = (float(r.lo), float(r.hi)) if r.lo is not None else (0.0, 1.0)
    start, stop, st = nice_bins(extent[0], extent[1], maxbins, step, nice, **params)
    b = bin_expr(F.col(field), start, stop, st)
    return df.withColumn(as_[0], b).withColumn(as_[1], F.col(as_[0]) + F.lit(st))


# ---------------------------------------------------------------- T3 density

def scott_bandwidth(n: Column, sd: Column, iqr: Column) -> Column:
    """1.06 · min(sd, iqr / 1.34) · n^(-1/5) (falls back to sd when the IQR is 0)."""
    spread = F.when(iqr > 0, F.least(sd, iqr / 1.34)).otherwise(sd)
    return 1.06 * spread * F.pow(n.cast("double"), -0.2)


def density(df: DataFrame, field: str, groupby: Sequence[str] | None = None,
            bandwidth: float | None = None, extent: tuple[float, float] | None = None,
            steps: int | None = None, counts: bool = False, cumulative: bool = False,
            resolve: str = "shared", as_: tuple[str, str] = ("value", "density"),
            minsteps: int = 25, maxsteps: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid of ``steps`` points over the
    extent (shared over groups unless ``resolve='independent'``). Without ``steps``
    the grid has ``maxsteps`` points: the densest sampling the adaptive curve
    sampler may use (our definition; a uniform grid keeps densities stackable).
    A bandwidth of None or 0 is estimated (Scott's rule).

    Rows are first reduced to (group, value, weight): a partial + final aggregate.
    Every distinct value is evaluated exactly at every grid point; the sums combine
    map-side, so groups × steps rows are shuffled."""
    from ..functions.expr import erf  # local: avoid an import cycle

    g = _as_list(groupby)
    steps = int(steps) if steps else max(int(minsteps), int(maxsteps))
    x = F.col(field).cast("double")
    base = df.select(*g, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    stats = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
                                 F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    if not bandwidth:
        stats = _attach(stats, exact_quantiles(base, F.col("_x"), (0.25, 0.75), g, "_q"), g)
    bw = F.lit(float(bandwidth)) if bandwidth else \
        scott_bandwidth(F.col("_n"), F.col("_sd"), F.col("_q")[1] - F.col("_q")[0])
    stats = stats.withColumn("_bw", bw)
    if extent is None and resolve == "shared":
        whole = base.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        stats = stats.withColumn("_lo", whole.select("lo").scalar()).withColumn("_hi", whole.select("hi").scalar())
    # one row per group, read twice below: checkpoint instead of recomputing the pass
    stats = cut_lineage(stats)
    if extent is not None:
        stats = stats.withColumn("_lo", F.lit(float(extent[0]))).withColumn("_hi", F.lit(float(extent[1])))
    weights = base.groupBy(*g, "_x").agg(F.count(F.lit(1)).alias("_w"))
    # every (value, weight) row is evaluated at each of the `steps` grid points of its
    # group: rows are per distinct value (or per pre-bin cell), not per input row
    j = _attach(weights, stats.select(*g, "_n", "_bw", "_lo", "_hi"), g)
    j = j.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    j = j.withColumn("_gx", F.col("_lo") + F.col("_k") * (F.col("_hi") - F.col("_lo")) / (steps - 1))
    z = (F.col("_gx") - F.col("_x")) / F.col("_bw")
    if cumulative:
        k = 0.5 * (1.0 + erf(z / math.sqrt(2.0)))
    else:
        k = F.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    contrib = F.col("_w") * k
    out = j.groupBy(*g, "_k", "_gx", "_n", "_bw").agg(F.sum(contrib).alias("_s"))
    val = F.col("_s").cast("double") / F.col("_n")
    if not cumulative:
        val = val / F.col("_bw")
    if counts:
        val = val * F.col("_n")
    return out.select(*g, F.col("_gx").alias(as_[0]), val.alias(as_[1]))


# ---------------------------------------------------------------- T4 impute

def impute(df: DataFrame, field: str, key: str, groupby: Sequence[str] | None = None,
           keyvals: Sequence | None = None, method: str = "value", value=None,
           frame: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """T4: add the missing (group, key) rows and fill ``field`` there.

    ``keyvals`` is a list of extra keys or a sequence ``{"start", "stop", "step"}``.
    The output is every group × every key (the feature). Groups and keys are both dealt
    into as many parts as make one task per pair of parts and shuffle partition, and
    joined on the pair, so neither side is collected or held by a few tasks; the present
    rows are joined back on (group, key). Filled values: a constant, or mean / median /
    min / max of the present values of the group within ``frame`` (row offsets over the
    key order; None = unbounded), over blocks of rows rather than whole groups."""
    g = _as_list(groupby)
    keys_df = df.select(key).dropna().distinct()
    if isinstance(keyvals, dict):
        # a number sequence {start, stop, step}: stop is exclusive
        start, stop, step = keyvals.get("start", 0), keyvals["stop"], keyvals.get("step", 1)
        n = max(0, math.ceil((stop - start) / step))
        keyvals = [start + i * step for i in range(n)]
    if keyvals:
        more = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k) for k in keyvals])).alias(key))
        more = more.select(F.col(key).cast(df.schema[key].dataType))
        keys_df = keys_df.unionByName(more).distinct()
    parts = max(1, math.ceil(math.sqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    dealt = keys_df.select(key, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("_b"), F.explode(every).alias("_a"))
    groups = df.select(*g).distinct() if g else df.sparkSession.range(1).select()
    groups = groups.select(*g, (F.pmod(F.xxhash64(*g), F.lit(parts)) if g else F.lit(0)).cast("int").alias("_a"), F.explode(every).alias("_b"))
    full = groups.join(dealt, ["_a", "_b"]).select(*g, key)
    present = df.select(*g, key, field).withColumn("_present", F.lit(True))
    filled = join_on(full, present, [*g, key], "left")
    if method == "value":
        fill = F.lit(value)
    elif method == "median" and tuple(frame) == (None, None):
        from .transforms import joinaggregate
        filled = joinaggregate(filled, {"_fill": ("median", field)}, g)
        fill = F.col("_fill")
    else:
        from .transforms import window
        lo, hi = frame
        # a median has no distributed form where its frame is open to one side
        spread = method != "median" or (lo is not None and hi is not None)
        filled = window(filled, {"_fill": (method, field)}, [key], g, (lo, hi), ignore_peers=True, distributed=spread)
        fill = F.col("_fill")
    out = filled.withColumn(field, F.when(F.col("_present").isNull(), fill).otherwise(F.col(field)))
    extra = [c for c in df.columns if c not in (*g, key, field)]
    if extra:
        out = join_on(out, df.select(*g, key, *extra).dropDuplicates([*g, key]), [*g, key], "left")
    return out.drop("_present", "_fill")


# ---------------------------------------------------------------- T12 regression

def regression_params(df: DataFrame, x: str, y: str, method: str = "linear", order: int = 3,
                      groupby: Sequence[str] | None = None) -> DataFrame:
    """T12 with params=True: per group ``coef`` (ascending powers, or [a, b] for
    log/exp/pow) and ``rSquared``.

    Everything is computed from one aggregate of power sums (x centred on its mean
    for polynomial fits); the small normal-equation system of each group is solved
    in its own task."""
    g = _as_list(groupby)
    X = F.col(x).cast("double")
    Y = F.col(y).cast("double")
    d = df.select(*g, X.alias("_x"), Y.alias("_y")).dropna()
    if method in ("linear", "log", "pow"):
        tx = d["_x"] if method == "linear" else F.log("_x")
        ty = F.log("_y") if method == "pow" else d["_y"]
        t = d.select(*g, tx.alias("_u"), ty.alias("_v"))
        if method != "linear":
            t = t.filter(F.col("_u").isNotNull() & F.col("_v").isNotNull())
        agg = t.groupBy(*g).agg(F.regr_intercept("_v", "_u").alias("_a"),
                                F.regr_slope("_v", "_u").alias("_b"),
                                F.regr_r2("_v", "_u").alias("rSquared"))
        a = F.exp("_a") if method == "pow" else F.col("_a")
        return agg.select(*g, F.array(a, F.col("_b")).alias("coef"), "rSquared")
    if method == "exp":
        t = d.filter(F.col("_y") > 0).select(*g, "_x", "_y", F.log("_y").alias("_ly"))
        s = t.groupBy(*g).agg(F.sum("_y").alias("Y"), F.sum(F.col("_x") * F.col("_y")).alias("XY"),
                              F.sum(F.col("_x") * F.col("_x") * F.col("_y")).alias("X2Y"),
                              F.sum(F.col("_y") * F.col("_ly")).alias("YL"),
                              F.sum(F.col("_x") * F.col("_y") * F.col("_ly")).alias("XYL"),
                              F.avg("_y").alias("ym"), F.var_pop("_y").alias("yv"),
                              F.count(F.lit(1)).alias("n"))
        c = F.col("Y") * F.col("X2Y") - F.col("XY") * F.col("XY")
        a = F.exp((F.col("X2Y") * F.col("YL") - F.col("XY") * F.col("XYL")) / c)
        b = (F.col("Y") * F.col("XYL") - F.col("XY") * F.col("YL")) / c
        coef = s.select(*g, a.alias("_a"), b.alias("_b"))
        sse = _attach(t, coef, g)
        sse = sse.groupBy(*g).agg(F.sum(F.pow(F.col("_y") - F.col("_a") * F.exp(F.col("_b") * F.col("_x")), 2))
                                  .alias("_sse"), F.sum(F.col("_y")).alias("_sy"),
                                  F.sum(F.col("_y") * F.col("_y")).alias("_syy"), F.count(F.lit(1)).alias("_n"),
                                  F.first("_a").alias("_a"), F.first("_b").alias("_b"))
        sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("_n")
        return sse.select(*g, F.array("_a", "_b").alias("coef"), (1 - F.col("_sse") / sst).alias("rSquared"))
    k = 2 if method == "quad" else int(order)
    return _poly_params(d, g, k)


def _poly_params(d: DataFrame, g: list, k: int) -> DataFrame:
    means = d.groupBy(*g).agg(F.avg("_x").alias("_x0"))
    t = _attach(d, means, g)
    u = F.col("_x") - F.col("_x0")
    sums = [F.sum(F.pow(u, p)).alias(f"sx{p}") for p in range(2 * k + 1)]
    sums += [F.sum(F.pow(u, p) * F.col("_y")).alias(f"sxy{p}") for p in range(k + 1)]
    sums += [F.sum(F.col("_y") * F.col("_y")).alias("syy"), F.first("_x0").alias("_x0")]
    s = t.groupBy(*g).agg(*sums)
    fields = [f for f in s.select(*g).schema.fields]
    schema = T.StructType([*fields, T.StructField("coef", T.ArrayType(T.DoubleType())),
                           T.StructField("rSquared", T.DoubleType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():  # one row per group
            A = np.array([[r[f"sx{i + j}"] for j in range(k + 1)] for i in range(k + 1)], float)
            bvec = np.array([r[f"sxy{i}"] for i in range(k + 1)], float)
            c = np.linalg.lstsq(A, bvec, rcond=None)[0]
            n = r["sx0"]
            ybar = r["sxy0"] / n
            sst = r["syy"] - n * ybar * ybar
            ssr = c @ bvec - n * ybar * ybar
            # expand the centred polynomial back to powers of x
            x0 = r["_x0"]
            coef = np.zeros(k + 1)
            for p, cp in enumerate(c):
                for q in range(p + 1):
                    coef[q] += cp * math.comb(p, q) * (-x0) ** (p - q)
            rec = {name: r[name] for name in g}
            rec.update(coef=coef.tolist(), rSquared=float(ssr / sst) if sst > 0 else None)
            rows.append(rec)
        return pd.DataFrame(rows, columns=[*g, "coef", "rSquared"])

    if g:
        return s.groupBy(*g).applyInPandas(solve, schema)
    return s.withColumn("_g", F.lit(0)).groupBy("_g").applyInPandas(solve, schema)


def regression(df: DataFrame, x: str, y: str, method: str = "linear", order: int = 3,
               groupby: Sequence[str] | None = None, extent: tuple[float, float] | None = None,
               params: bool = False, steps: int = 100) -> DataFrame:
    """Fitted curve points over the x extent (``steps`` even points; 2 for
    linear), or the parameters when ``params=True``."""
    g = _as_list(groupby)
    p = regression_params(df, x, y, method, order, g)
    if params:
        return p
    ext = df.groupBy(*g).agg(F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi")) \
        if g else df.agg(F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi"))
    if extent is not None:
        ext = ext.withColumn("_lo", F.lit(float(extent[0]))).withColumn("_hi", F.lit(float(extent[1])))
    n = 2 if method == "linear" else steps
    pts = ext.select(*g, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_k"))
    pts = pts.withColumn("_px", F.col("_lo") + F.col("_k") * (F.col("_hi") - F.col("_lo")) / (n - 1))
    j = _attach(pts, p, g)
    c = F.col("coef")
    X = F.col("_px")
    if method == "linear":
        fy = c[0] + c[1] * X
    elif method == "log":
        fy = c[0] + c[1] * F.log(X)
    elif method == "exp":
        fy = c[0] * F.exp(c[1] * X)
    elif method == "pow":
        fy = c[0] * F.pow(X, c[1])
    else:
        fy = F.aggregate(F.reverse(c), F.lit(0.0), lambda acc, ci: acc * X + ci)
    return j.select(*g, X.alias(x), fy.alias(y))


# ---------------------------------------------------------------- T22 boxplot / T23 error extent

def boxplot_stats(df: DataFrame, field: str, groupby: Sequence[str] | None = None,
                  k: float | None = 1.5) -> DataFrame:
    """q1, median, q3, whiskers (furthest values within k·IQR of the box, or the
    min / max when ``k`` is None) and the outlier count per group."""
    g = _as_list(groupby)
    v = F.col(field).cast("double")
    q = df.groupBy(*g).agg(F.min(v).alias("_min"), F.max(v).alias("_max"), F.count(v).alias("count"))
    quartiles = exact_quantiles(df, v, (0.25, 0.5, 0.75), g, "_q")
    q = join_on(q, quartiles, g, "left") if g else _attach(q, quartiles, g)
    q = q.select(*g, "count", "_min", "_max", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = cut_lineage(q)  # one row per group, read twice
    if k is None:
        return q.select(*g, "count", "q1", "median", "q3", F.col("_min").alias("lower"),
                        F.col("_max").alias("upper"), F.lit(0).cast("bigint").alias("outliers"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("_lf", F.col("q1") - k * iqr).withColumn("_uf", F.col("q3") + k * iqr)
    j = _attach(df.select(*g, v.alias("_v")), q.select(*g, "_lf", "_uf"), g)
    inside = (F.col("_v") >= F.col("_lf")) & (F.col("_v") <= F.col("_uf"))
    w = j.groupBy(*g).agg(F.min(F.when(inside, F.col("_v"))).alias("lower"),
                          F.max(F.when(inside, F.col("_v"))).alias("upper"),
                          F.count(F.when(~inside, F.lit(1))).alias("outliers"))
    out = _attach(q, w, g)
    return out.select(*g, "count", "q1", "median", "q3", "lower", "upper", "outliers")


def boxplot_outliers(df: DataFrame, field: str, groupby: Sequence[str] | None = None,
                     k: float = 1.5) -> DataFrame:
    """The rows outside the whiskers."""
    g = _as_list(groupby)
    s = boxplot_stats(df, field, g, k).select(*g, "q1", "q3")
    j = _attach(df, s, g)
    iqr = F.col("q3") - F.col("q1")
    v = F.col(field)
    return j.filter((v < F.col("q1") - k * iqr) | (v > F.col("q3") + k * iqr)).drop("q1", "q3")


def error_extent(df: DataFrame, field: str, extent: str = "stderr",
                 groupby: Sequence[str] | None = None, reps: int = 200, seed: int = 42,
                 key: Sequence[str] | None = None) -> DataFrame:
    """Center and [lower, upper] per group for stderr / stdev (mean ± it),
    iqr (median, q1..q3) or ci (mean, 95 % bootstrap interval)."""
    g = _as_list(groupby)
    v = F.col(field).cast("double")
    if extent in ("stderr", "stdev"):
        spread = F.stddev_samp(v) / F.sqrt(F.count(v)) if extent == "stderr" else F.stddev_samp(v)
        a = df.groupBy(*g).agg(F.avg(v).alias("center"), spread.alias("_s"))
        return a.select(*g, "center", (F.col("center") - F.col("_s")).alias("lower"),
                        (F.col("center") + F.col("_s")).alias("upper"))
    if extent == "iqr":
        a = exact_quantiles(df, v, (0.25, 0.5, 0.75), g, "_q")
        return a.select(*g, F.col("_q")[1].alias("center"), F.col("_q")[0].alias("lower"),
                        F.col("_q")[2].alias("upper"))
    ci = bootstrap_ci(df, field, g, reps, seed, key)
    m = df.groupBy(*g).agg(F.avg(v).alias("center"))
    out = _attach(m, ci, g)
    return out.select(*g, "center", F.col("ci0").alias("lower"), F.col("ci1").alias("upper"))


# ---------------------------------------------------------------- A14 bootstrap ci

# Replicate weights are drawn modulo this prime (the largest below 2^28).
DRAWS = 268435399


def poisson_steps() -> list[int]:
    """Draws from which a Poisson(1) weight is at least 1, 2, ...: p times e^-1 sum 1/j!."""
    steps, acc = [], 0.0
    for j in range(11):
        acc += math.exp(-1.0) / math.factorial(j)
        steps.append(int(acc * DRAWS))
    return steps


def _replicate_sums(batches, reps: int):
    """Per group of a task (key ``_k``) the replicates' sums of weights and of weighted values."""
    steps, r = np.array(poisson_steps()), np.arange(1, reps + 1)
    held: dict = {}

    def out():
        frame = pd.DataFrame({"_k": list(held), "_sw": [x[0] for x in held.values()], "_sv": [x[1] for x in held.values()]})
        held.clear()
        return frame

    for pdf in batches:
        for lo in range(0, len(pdf), 4096):
            part = pdf.iloc[lo:lo + 4096]
            codes, keys = pd.factorize(part["_k"])
            order = np.argsort(codes, kind="stable")
            draws = (part["_a"].to_numpy()[order, None] + r * part["_b"].to_numpy()[order, None]) % DRAWS
            weight = np.searchsorted(steps, draws, "right").astype(float)
            first = np.searchsorted(codes[order], np.arange(len(keys)))
            sw = np.add.reduceat(weight, first)
            sv = np.add.reduceat(weight * part["_v"].to_numpy(float)[order, None], first)
            for k, key in enumerate(keys):
                old = held.get(key)
                held[key] = (sw[k], sv[k]) if old is None else (old[0] + sw[k], old[1] + sv[k])
        if len(held) > 5000:
            yield out()
    if held:
        yield out()


def bootstrap_ci(df: DataFrame, field: str, groupby: Sequence[str] | None = None,
                 reps: int = 200, seed: int = 42, key: Sequence[str] | None = None,
                 level: float = 0.95) -> DataFrame:
    """A14 ci0 / ci1: percentile interval of the mean over ``reps`` Poisson bootstrap
    replicates. A row's weight in replicate r is drawn by (a + r b) mod p, with a and b
    from the MD5 digest of the seed and the row's ``key`` (default: all columns, equal
    rows being numbered), so reruns and recomputed tasks give the same numbers.

    A task keeps one array of weights and one of weighted sums per group and adds its
    rows to them; rows are never multiplied by the replicates, and what is shuffled is
    one pair of arrays per task and group. Null and NaN values are left out."""
    g = _as_list(groupby)
    v = F.col(field).cast("double")
    named = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key or df.columns)])
    group = F.to_json(F.struct(*g)) if g else F.lit("{}")
    base = df.select(group.alias("_k"), v.alias("_v"), named.alias("_h")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if key is None:
        # equal rows are told apart by their number among their equals
        base = base.groupBy("_k", "_v", "_h").agg(F.count(F.lit(1)).alias("_n")) \
                   .withColumn("_o", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))) \
                   .select("_k", "_v", F.concat_ws("|", "_h", "_o").alias("_h"))
    digest = F.md5("_h")
    base = base.select("_k", "_v", F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint").alias("_a"), F.conv(F.substring(digest, 9, 7), 16, 10).cast("bigint").alias("_b"))
    parts = base.mapInPandas(lambda batches: _replicate_sums(batches, reps), "_k string, _sw array<double>, _sv array<double>")
    each = parts.select("_k", F.posexplode(F.arrays_zip("_sw", "_sv")).alias("_r", "_x"))
    # a replicate that draws no row at all has no mean
    means = each.groupBy("_k", "_r").agg(F.try_divide(F.sum("_x._sv"), F.sum("_x._sw")).alias("_m"))
    a = (1 - level) / 2
    out = means.groupBy("_k").agg(F.percentile("_m", F.array(F.lit(a), F.lit(1 - a))).alias("_ci"))  # ``reps`` values
    keys = [F.from_json("_k", df.select(*g).schema)[k].alias(k) for k in g]
    return out.select(*keys, F.col("_ci")[0].alias("ci0"), F.col("_ci")[1].alias("ci1"))


# ---------------------------------------------------------------- T26 scale binning

def quantize_bucket(df: DataFrame, field: str, n: int, as_: str = "bucket") -> DataFrame:
    """quantize: n equal-width buckets over the extent -> 0..n-1."""
    lo = df.agg(F.min(field)).scalar()
    hi = df.agg(F.max(field)).scalar()
    # a constant column has one bucket, the first
    idx = F.floor(F.coalesce(F.try_divide((F.col(field) - lo).cast("double"), (hi - lo).cast("double")), F.col(field) * 0.0) * n)
    bucket = F.least(F.greatest(idx, F.lit(0)), F.lit(n - 1)).cast("int")
    return df.withColumn(as_, F.when(F.col(field).isNotNull(), bucket))


def threshold_bucket(df: DataFrame, field: str, cuts: Sequence[float], as_: str = "bucket") -> DataFrame:
    """threshold: bucket = number of cuts <= value."""
    c = F.col(field)
    idx = sum((F.when(c >= t, F.lit(1)).otherwise(F.lit(0)) for t in cuts), F.lit(0))
    return df.withColumn(as_, F.when(c.isNull(), F.lit(None)).otherwise(idx).cast("int"))


def quantile_bucket(df: DataFrame, field: str, n: int, groupby: Sequence[str] | None = None,
                    as_: str = "bucket", approx: bool = False) -> DataFrame:
    """quantile: cuts at the 1/n ... (n-1)/n quantiles (one aggregate), then threshold."""
    g = _as_list(groupby)
    probs = [i / n for i in range(1, n)]
    if approx:
        cuts = df.groupBy(*g).agg(F.percentile_approx(field, F.array(*[F.lit(p) for p in probs]), 10000).alias("_cuts"))
    else:
        cuts = exact_quantiles(df, F.col(field), probs, g, "_cuts")
    j = join_on(df, cuts, g, "left") if g else _attach(df, cuts, g)
    c = F.col(field)
    idx = F.aggregate(F.col("_cuts"), F.lit(0), lambda acc, t: acc + F.when(c >= t, 1).otherwise(0))
    return j.withColumn(as_, F.when(c.isNull(), F.lit(None)).otherwise(idx).cast("int")).drop("_cuts")


# ---------------------------------------------------------------- A16 / A17 exponential

def exponential_both(df: DataFrame, field: str, order: Sequence, alpha: float = 0.5,
                     groupby: Sequence[str] | None = None) -> DataFrame:
    """A16 ``exponential`` (e1 = v1, ek = alpha vk + (1 - alpha) e(k-1)) and A17
    ``exponentialb`` (start at 0, divided by the sum of the weights) per group, of the
    values that are neither null nor NaN.

    The weighted sums come from the segmented scan, so a group with a third of all rows
    is spread over many tasks."""
    from .dwindow import _names, _order
    g = _as_list(groupby)
    v = F.col(field).cast("double")
    rows = df.select(*dict.fromkeys([*g, *_names(order)]), F.when(~F.isnan(v), v).alias("_v"))
    s = running(rows, {"_d": ("decayed", "_v", alpha), "_k": ("count", "_v"), "_f": ("first", "_v"), "_rn": ("row_number",)}, g, _order(order))
    last = s.groupBy(*g).agg(F.max_by(F.struct("_d", "_k", "_f"), "_rn").alias("_l"))
    left = F.pow(F.lit(1 - float(alpha)), F.col("_l._k").cast("double"))
    return last.select(*g, (F.col("_l._d") + left * F.col("_l._f")).alias("exponential"),
                       F.try_divide(F.col("_l._d"), 1 - left).alias("exponentialb"))


def exponential(df: DataFrame, field: str, order: Sequence, alpha: float = 0.5,
                groupby: Sequence[str] | None = None, bias_corrected: bool = False,
                as_: str = "exponential") -> DataFrame:
    """A16, or A17 with ``bias_corrected``."""
    both = exponential_both(df, field, order, alpha, groupby)
    return both.select(*_as_list(groupby), F.col("exponentialb" if bias_corrected else "exponential").alias(as_))
