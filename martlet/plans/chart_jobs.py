"""Registered jobs for the table transforms, aggregate and window operations
(T*, A*, W*) over the input tables, each next to its SQL twin when one exists.

Floating results that depend on summation order are reported to 6 decimals
(``q6``) on both sides; exact results are reported as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import dbl, round_half_up
from ..functions.timeunits import timeunit
from ..operators import stats
from ..operators import transforms as tf
from ..operators.loess import loess
from ..sources.tables import Tables
from .oracle_sql import R


def q6(c):
    return round_half_up(c, 6)


def S6(x: str) -> str:
    return R(x, 6)


JOBS: dict = {}
ORACLE: dict[str, str] = {}


def job(name: str, sql: str | None = None):
    def deco(fn):
        JOBS[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def ev(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).events


# ------------------------------------------------------------------ T1 + A1-A12

@job("t1_aggregate", f"""
SELECT event_type, COUNT(*) AS n, COUNT(value) FILTER (WHERE NOT isnan(value)) AS valid,
       COUNT(*) FILTER (WHERE props IS NULL OR props = '') AS missing,
       COUNT(DISTINCT user_id) AS distinct_users,
       {S6('SUM(value)')} AS sum_value, {S6('AVG(value)')} AS mean_value,
       {S6('VAR_SAMP(value)')} AS variance, {S6('VAR_POP(value)')} AS variancep,
       {S6('STDDEV_SAMP(value)')} AS stdev, {S6('STDDEV_POP(value)')} AS stdevp,
       {S6('STDDEV_SAMP(value) / SQRT(COUNT(value))')} AS stderr,
       MIN(value) AS min_value, MAX(value) AS max_value,
       {S6('QUANTILE_CONT(value, 0.5)')} AS median, {S6('QUANTILE_CONT(value, 0.25)')} AS q1,
       {S6('QUANTILE_CONT(value, 0.75)')} AS q3,
       FIRST(event_id ORDER BY value, event_id) AS argmin_event,
       FIRST(event_id ORDER BY value DESC, event_id DESC) AS argmax_event
FROM events GROUP BY 1""")
def t1_aggregate(spark, d):
    e = ev(spark, d)
    a = tf.aggregate(e, {
        "n": ("count",), "valid": ("valid", "value"), "missing": ("missing", "props"),
        "distinct_users": ("distinct", "user_id"), "sum_value": ("sum", "value"),
        "mean_value": ("mean", "value"), "variance": ("variance", "value"),
        "variancep": ("variancep", "value"), "stdev": ("stdev", "value"), "stdevp": ("stdevp", "value"),
        "stderr": ("stderr", "value"), "min_value": ("min", "value"), "max_value": ("max", "value"),
        "median": ("median", "value"), "q1": ("q1", "value"), "q3": ("q3", "value"),
        "argmin": ("argmin", "value"), "argmax": ("argmax", "value")}, ["event_type"])
    floats = ["sum_value", "mean_value", "variance", "variancep", "stdev", "stdevp", "stderr",
              "median", "q1", "q3"]
    return a.select("event_type", "n", "valid", "missing", "distinct_users",
                    *[q6(c).alias(c) for c in floats], "min_value", "max_value",
                    F.col("argmin.event_id").alias("argmin_event"),
                    F.col("argmax.event_id").alias("argmax_event"))


# ------------------------------------------------------------------ T2 bin

BIN_SQL = """
WITH ext AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events),
s0 AS (SELECT lo, hi, CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END AS span FROM ext),
s1 AS (SELECT *, POWER(10.0, ROUND(LN(span) / LN(10)) - CEIL(LN(10) / LN(10))) AS st0 FROM s0),
s2 AS (SELECT *, CASE WHEN CEIL(span / st0) > 10 THEN (CASE WHEN CEIL(span / (st0 * 10)) > 10
                 THEN st0 * 100 ELSE st0 * 10 END) ELSE st0 END AS st1 FROM s1),
s3 AS (SELECT *, CASE WHEN span / (st1 / 5) <= 10 THEN st1 / 5 ELSE st1 END AS st2 FROM s2),
s4 AS (SELECT *, CASE WHEN span / (st2 / 2) <= 10 THEN st2 / 2 ELSE st2 END AS step FROM s3),
s5 AS (SELECT *, CASE WHEN LN(step) >= 0 THEN 0 ELSE CAST(TRUNC(-LN(step) / LN(10)) AS INTEGER) + 1 END AS prec FROM s4),
s6 AS (SELECT *, FLOOR(lo / step + POWER(10.0, -prec - 1)) * step AS v FROM s5),
p AS (SELECT CASE WHEN lo < v THEN v - step ELSE v END AS start, CEIL(hi / step) * step AS stop, step FROM s6),
b AS (SELECT p.start + p.step * FLOOR(1e-14 + (GREATEST(p.start, LEAST(e.value, p.stop - p.step)) - p.start) / p.step) AS b0,
             p.step FROM events e, p WHERE e.value IS NOT NULL)
SELECT b0 AS bin_value, b0 + step AS bin_value_end, COUNT(*) AS n FROM b GROUP BY 1, 2"""


@job("t2_bin", BIN_SQL)
def t2_bin(spark, d):
    b = stats.bin_(ev(spark, d), "value", ("bin_value", "bin_value_end"), maxbins=10)
    return b.filter(F.col("bin_value").isNotNull()).groupBy("bin_value", "bin_value_end") \
            .agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T3 density (rows-only twin below)

@job("t3_density", f"""
WITH base AS (SELECT event_type, value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
st AS (SELECT event_type, COUNT(*) AS n, STDDEV_SAMP(x) AS sd, QUANTILE_CONT(x, 0.25) AS q1,
              QUANTILE_CONT(x, 0.75) AS q3 FROM base GROUP BY 1),
ext AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM base),
bw AS (SELECT event_type, n, 1.06 * CASE WHEN q3 - q1 > 0 THEN LEAST(sd, (q3 - q1) / 1.34) ELSE sd END
              * POWER(CAST(n AS DOUBLE), -0.2) AS bw FROM st),
w AS (SELECT event_type, x, COUNT(*) AS w FROM base GROUP BY 1, 2),
grid AS (SELECT k, lo + k * (hi - lo) / 99 AS gx FROM ext, range(0, 100) r(k))
SELECT w.event_type, {S6('gx')} AS value,
       {R('SUM(w.w * EXP(-0.5 * ((gx - x) / bw) * ((gx - x) / bw)) / SQRT(2 * PI())) / n / bw', 9)} AS density
FROM w JOIN bw USING (event_type), grid GROUP BY w.event_type, k, gx, n, bw""")
def t3_density(spark, d):
    dn = stats.density(ev(spark, d), "value", groupby=["event_type"], steps=100)
    return dn.select("event_type", q6("value").alias("value"), round_half_up("density", 9).alias("density"))


# ------------------------------------------------------------------ T4 impute

@job("t4_impute", """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2),
keys AS (SELECT DISTINCT day FROM daily), users AS (SELECT DISTINCT user_id FROM daily)
SELECT u.user_id, k.day, COALESCE(d.n, 0) AS n
FROM users u CROSS JOIN keys k LEFT JOIN daily d ON d.user_id = u.user_id AND d.day = k.day""")
def t4_impute(spark, d):
    daily = ev(spark, d).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = stats.impute(daily, "n", "day", groupby=["user_id"], method="value", value=0)
    return out.select("user_id", "day", F.col("n").cast("bigint").alias("n"))


IMPUTE_SQL = """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, SUM(value) AS v FROM events WHERE event_id % 5 = 0 AND day(ts) % 3 <> 0 GROUP BY 1, 2),
every AS (SELECT t.event_type, k.day, v FROM (SELECT DISTINCT event_type FROM daily) t CROSS JOIN (SELECT DISTINCT day FROM daily) k
          LEFT JOIN daily d ON d.event_type = t.event_type AND d.day = k.day)
SELECT event_type, day, {m} AS v_mean, {x} AS v_max, {q} AS v_median
FROM every WINDOW w AS (PARTITION BY event_type ORDER BY day)"""


@job("t4_impute_methods", IMPUTE_SQL.format(
    m=S6("COALESCE(v, AVG(v) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING))"),
    x=S6("COALESCE(v, MAX(v) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"),
    q=S6("COALESCE(v, QUANTILE_CONT(v, 0.5) OVER (PARTITION BY event_type))")))
def t4_impute_methods(spark, d):
    """Missing days filled from the days around, before, and all."""
    e = ev(spark, d).filter((F.col("event_id") % 5 == 0) & (F.dayofmonth("ts") % 3 != 0))
    daily = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("v"))
    out = None
    for name, method, frame in (("v_mean", "mean", (-6, 6)), ("v_max", "max", (None, 0)), ("v_median", "median", (None, None))):
        one = stats.impute(daily, "v", "day", groupby=["event_type"], method=method, frame=frame).select("event_type", "day", q6("v").alias(name))
        out = one if out is None else out.join(one, ["event_type", "day"])
    return out


# ------------------------------------------------------------------ T5 joinaggregate

@job("t5_joinaggregate", f"""
SELECT event_id, event_type, value, {S6('AVG(value) OVER (PARTITION BY event_type)')} AS mean_value,
       COUNT(*) OVER (PARTITION BY event_type) AS n
FROM events""")
def t5_joinaggregate(spark, d):
    e = ev(spark, d).select("event_id", "event_type", "value")
    j = tf.joinaggregate(e, {"mean_value": ("mean", "value"), "n": ("count",)}, ["event_type"])
    return j.select("event_id", "event_type", "value", q6("mean_value").alias("mean_value"), "n")


# ------------------------------------------------------------------ T6 extent

@job("t6_extent", "SELECT [MIN(value), MAX(value)] AS value_extent FROM events")
def t6_extent(spark, d):
    return tf.extent(ev(spark, d), "value")


# ------------------------------------------------------------------ T7 flatten

@job("t7_flatten", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, embedding[i] AS embedding, CASE WHEN i <= 8 THEN embedding[i] END AS head
FROM (SELECT vec_id, embedding, UNNEST(generate_series(1, len(embedding))) AS i FROM embeddings) t""")
def t7_flatten(spark, d):
    emb = Tables(spark, d).embeddings.select("vec_id", "embedding",
                                              F.slice("embedding", 1, 8).alias("head"))
    return tf.flatten(emb, ["embedding", "head"], index="idx")


# ------------------------------------------------------------------ T8 fold

@job("t8_fold", """
SELECT p_partkey, 'p_size' AS key, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def t8_fold(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                     "p_retailprice")
    return tf.fold(p, ["p_size", "p_retailprice"])


# ------------------------------------------------------------------ T10 pivot

@job("t10_pivot", """
SELECT user_id,
       COUNT(*) FILTER (WHERE event_type = 'click') AS click,
       COUNT(*) FILTER (WHERE event_type = 'error') AS error,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS signup,
       COUNT(*) FILTER (WHERE event_type = 'view') AS "view"
FROM events GROUP BY 1""")
def t10_pivot(spark, d):
    e = ev(spark, d)
    p = tf.pivot(e, "event_type", "event_id", groupby=["user_id"], op="valid")
    return p.select("user_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                 for c in p.columns if c != "user_id"])


# ------------------------------------------------------------------ T11 quantile

@job("t11_quantile", f"""
SELECT event_type, CAST(probs[i] AS DOUBLE) AS prob, {S6('qs[i]')} AS value
FROM (SELECT event_type, [0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95] AS probs,
             QUANTILE_CONT(value, [0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95]) AS qs
      FROM events GROUP BY 1) t, range(1, 11) r(i)""")
def t11_quantile(spark, d):
    q = tf.quantile(ev(spark, d), "value", step=0.1, groupby=["event_type"])
    return q.select("event_type", "prob", q6("value").alias("value"))


# ------------------------------------------------------------------ T12 regression

@job("t12_regression", f"""
SELECT l_returnflag, 'linear' AS method, {S6('REGR_INTERCEPT(l_extendedprice, l_quantity)')} AS c0,
       {S6('REGR_SLOPE(l_extendedprice, l_quantity)')} AS c1,
       {S6('REGR_R2(l_extendedprice, l_quantity)')} AS r2 FROM lineitem GROUP BY 1
UNION ALL
SELECT l_returnflag, 'log', {S6('REGR_INTERCEPT(l_extendedprice, LN(l_quantity))')},
       {S6('REGR_SLOPE(l_extendedprice, LN(l_quantity))')},
       {S6('REGR_R2(l_extendedprice, LN(l_quantity))')} FROM lineitem GROUP BY 1
UNION ALL
SELECT l_returnflag, 'pow', {S6('EXP(REGR_INTERCEPT(LN(l_extendedprice), LN(l_quantity)))')},
       {S6('REGR_SLOPE(LN(l_extendedprice), LN(l_quantity))')},
       {S6('REGR_R2(LN(l_extendedprice), LN(l_quantity))')} FROM lineitem GROUP BY 1""")
def t12_regression(spark, d):
    li = Tables(spark, d).lineitem
    outs = []
    for m in ("linear", "log", "pow"):
        p = stats.regression_params(li, "l_quantity", "l_extendedprice", m, groupby=["l_returnflag"])
        outs.append(p.select("l_returnflag", F.lit(m).alias("method"), q6(F.col("coef")[0]).alias("c0"),
                             q6(F.col("coef")[1]).alias("c1"), q6("rSquared").alias("r2")))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


@job("t12_regression_poly", f"""
WITH c AS (SELECT l_returnflag, AVG(l_quantity) AS x0, MIN(l_quantity) AS lo, MAX(l_quantity) AS hi
           FROM lineitem GROUP BY 1),
s AS (SELECT l.l_returnflag, COUNT(*) AS s0, SUM(l_quantity - x0) AS s1, SUM(POWER(l_quantity - x0, 2)) AS s2,
             SUM(POWER(l_quantity - x0, 3)) AS s3, SUM(POWER(l_quantity - x0, 4)) AS s4,
             SUM(l_extendedprice) AS t0, SUM((l_quantity - x0) * l_extendedprice) AS t1,
             SUM(POWER(l_quantity - x0, 2) * l_extendedprice) AS t2
      FROM lineitem l JOIN c USING (l_returnflag) GROUP BY 1),
det AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS dd FROM s),
coef AS (SELECT l_returnflag,
  (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / dd AS c0,
  (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / dd AS c1,
  (s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / dd AS c2 FROM det),
pts AS (SELECT c.l_returnflag, c.x0, c.lo + k * (c.hi - c.lo) / 99 AS px FROM c, range(0, 100) r(k))
SELECT p.l_returnflag, {R('px', 4)} AS l_quantity,
       {R('c0 + c1 * (px - x0) + c2 * (px - x0) * (px - x0)', 4)} AS l_extendedprice
FROM pts p JOIN coef USING (l_returnflag)""")
def t12_regression_poly(spark, d):
    li = Tables(spark, d).lineitem
    r = stats.regression(li, "l_quantity", "l_extendedprice", "quad", groupby=["l_returnflag"])
    # a fitted curve: reported to 4 decimals (solvers differ around 1e-9)
    return r.select("l_returnflag", round_half_up("l_quantity", 4).alias("l_quantity"),
                    round_half_up("l_extendedprice", 4).alias("l_extendedprice"))


# ------------------------------------------------------------------ T13 sample (hash-ranked; rows-only)

@job("t13_sample")
def t13_sample(spark, d):
    return tf.sample(ev(spark, d), n=1000, seed=7, key=["event_id"])


# ------------------------------------------------------------------ T14 stack

@job("t14_stack", f"""
WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, SUM(value) AS v FROM events GROUP BY 1, 2)
SELECT day, event_type, {S6('v')} AS v,
       {S6('SUM(v) OVER (PARTITION BY day ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - v')} AS y0,
       {S6('SUM(v) OVER (PARTITION BY day ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS y1
FROM daily""")
def t14_stack(spark, d):
    daily = ev(spark, d).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.sum("value").alias("v"))
    s = tf.stack(daily, "v", ["day"], sort=["event_type"])
    return s.select("day", "event_type", q6("v").alias("v"), q6("y0").alias("y0"), q6("y1").alias("y1"))


# ------------------------------------------------------------------ T15 timeunit

TIMEUNITS = ("yearmonth", "yearquarter", "yearweek", "yearmonthdate", "yearmonthdatehours",
             "monthdate", "hours", "dayhours", "day", "week", "quarter", "minutes",
             "yearmonthdatehoursminutes", "dayofyear", "utcyearmonthdate", "binnedyearmonth")


def _duck_unit(unit: str, d: str = "ts") -> str:
    from ..functions.timeunits import BASE_YEAR, parse_unit
    parts, _, binned = parse_unit(unit)
    if binned:
        return d
    y = f"year({d})" if "year" in parts else str(BASE_YEAR)
    jan1 = f"make_date({y}, 1, 1)"
    dow = f"dayofweek({d})"
    wk = f"CAST(strftime({d}, '%U') AS INTEGER)"
    if "month" in parts:
        m = f"month({d})"
    elif "quarter" in parts:
        m = f"(CAST(FLOOR((month({d}) - 1) / 3) AS INTEGER) * 3 + 1)"
    else:
        m = "1"
    if "week" in parts and "year" in parts:
        day = f"(CAST({d} AS DATE) - CAST({'0' if 'day' in parts else dow} AS INTEGER))"
    elif "week" in parts:
        off = f"(({wk} - 1) * 7 + {dow if 'day' in parts else '0'})"
        day = f"(CAST({jan1} AS DATE) + CAST({off} AS INTEGER))"
    elif "dayofyear" in parts:
        day = f"(CAST({jan1} AS DATE) + CAST(dayofyear({d}) - 1 AS INTEGER))"
    elif "day" in parts and "date" not in parts:
        day = f"(make_date({BASE_YEAR}, 1, 1) + CAST({dow} AS INTEGER))"
    else:
        day = f"make_date({y}, {m}, {'day(' + d + ')' if 'date' in parts else '1'})"
    hh = f"hour({d})" if "hours" in parts else "0"
    mi = f"minute({d})" if "minutes" in parts else "0"
    ss = f"second({d})" if "seconds" in parts else "0"
    return f"make_timestamp(year({day}), month({day}), day({day}), {hh}, {mi}, {ss})"


@job("t15_timeunit", "\nUNION ALL\n".join(
    f"SELECT '{u}' AS unit, {_duck_unit(u)} AS t, COUNT(*) AS n FROM events GROUP BY 1, 2"
    for u in TIMEUNITS))
def t15_timeunit(spark, d):
    e = ev(spark, d)
    outs = [e.groupBy(F.lit(u).alias("unit"), timeunit("ts", u).alias("t")).agg(F.count(F.lit(1)).alias("n"))
            for u in TIMEUNITS]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


# ------------------------------------------------------------------ T16 window / W1-W13

@job("t16_window", f"""
SELECT event_id, event_type,
  CAST(ROW_NUMBER() OVER w AS INTEGER) AS rn, CAST(RANK() OVER wd AS INTEGER) AS rk,
  CAST(DENSE_RANK() OVER wd AS INTEGER) AS drk,
  {S6('PERCENT_RANK() OVER wd')} AS prk, {S6('CUME_DIST() OVER wd')} AS cd, CAST(NTILE(4) OVER w AS INTEGER) AS nt,
  LAG(value, 1) OVER w AS prev_value, LEAD(value, 2) OVER w AS next2_value,
  FIRST_VALUE(value) OVER w AS first_value,
  LAST_VALUE(value) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS last_in_frame,
  NTH_VALUE(value, 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS second_value,
  {S6('SUM(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS running_sum,
  {S6('AVG(value) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)')} AS moving_avg,
  MAX(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS group_max
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
       wd AS (PARTITION BY event_type ORDER BY CAST(ts AS DATE))""")
def t16_window(spark, d):
    e = ev(spark, d).withColumn("day", F.to_date("ts"))
    a = tf.window(e, {"rn": ("row_number",), "nt": ("ntile", None, 4),
                      "prev_value": ("lag", "value", 1), "next2_value": ("lead", "value", 2),
                      "first_value": ("first_value", "value")},
                  sort=["ts", "event_id"], groupby=["event_type"], frame=(None, None), ignore_peers=True)
    a = tf.window(a, {"last_in_frame": ("last_value", "value")}, sort=["ts", "event_id"],
                  groupby=["event_type"], frame=(-2, 2), ignore_peers=True)
    a = tf.window(a, {"second_value": ("nth_value", "value", 2), "running_sum": ("sum", "value")},
                  sort=["ts", "event_id"], groupby=["event_type"], frame=(None, 0), ignore_peers=True)
    a = tf.window(a, {"moving_avg": ("mean", "value")}, sort=["ts", "event_id"],
                  groupby=["event_type"], frame=(-3, 0), ignore_peers=True)
    a = tf.window(a, {"group_max": ("max", "value")}, sort=["ts", "event_id"],
                  groupby=["event_type"], frame=(None, None), ignore_peers=True)
    a = tf.window(a, {"rk": ("rank",), "drk": ("dense_rank",), "prk": ("percent_rank",),
                      "cd": ("cume_dist",)}, sort=["day"], groupby=["event_type"],
                  tiebreak=["ts", "event_id"])
    return a.select("event_id", "event_type", "rn", "rk", "drk", q6("prk").alias("prk"),
                    q6("cd").alias("cd"), "nt", "prev_value", "next2_value", "first_value",
                    "last_in_frame", "second_value", q6("running_sum").alias("running_sum"),
                    q6("moving_avg").alias("moving_avg"), "group_max")


# the distributed row number is a bigint (its groups may exceed 2^31 rows)
T16_SQL = ORACLE["t16_window"].replace("CAST(ROW_NUMBER() OVER w AS INTEGER) AS rn", "ROW_NUMBER() OVER w AS rn")


@job("t16_window_distributed", T16_SQL)
def t16_window_distributed(spark, d):
    e = ev(spark, d).withColumn("day", F.to_date("ts"))
    a = tf.window(e, {"rn": ("row_number",), "nt": ("ntile", None, 4),
                      "prev_value": ("lag", "value", 1), "next2_value": ("lead", "value", 2),
                      "first_value": ("first_value", "value", None, (None, None)),
                      "last_in_frame": ("last_value", "value", None, (-2, 2)),
                      "second_value": ("nth_value", "value", 2, (None, 0)),
                      "running_sum": ("sum", "value", None, (None, 0)),
                      "moving_avg": ("mean", "value", None, (-3, 0)),
                      "group_max": ("max", "value", None, (None, None))},
                  sort=["ts", "event_id"], groupby=["event_type"], ignore_peers=True, distributed=True)
    a = tf.window(a, {"rk": ("rank",), "drk": ("dense_rank",), "prk": ("percent_rank",),
                      "cd": ("cume_dist",)}, sort=["day"], groupby=["event_type"], tiebreak=["ts", "event_id"],
                  distributed=True)
    return a.select("event_id", "event_type", "rn", "rk", "drk", q6("prk").alias("prk"),
                    q6("cd").alias("cd"), "nt", "prev_value", "next2_value", "first_value",
                    "last_in_frame", "second_value", q6("running_sum").alias("running_sum"),
                    q6("moving_avg").alias("moving_avg"), "group_max")


# ------------------------------------------------------------------ W14 peers

@job("w14_peer_frame", f"""
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, value, event_id FROM events),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY day, event_id) AS rn,
             COUNT(*) OVER (PARTITION BY event_type) AS n,
             SUM(value) OVER (PARTITION BY event_type ORDER BY day, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ps
      FROM daily),
pg AS (SELECT event_type, day, MIN(rn) AS p0, MAX(rn) AS p1 FROM r GROUP BY 1, 2),
f AS (SELECT r.*, GREATEST(1, rn - 2) AS i0, LEAST(n, rn + 2) AS i1 FROM r),
e AS (SELECT f.*, a.p0 AS e0, b.p1 AS e1 FROM f
      JOIN r ra ON ra.event_type = f.event_type AND ra.rn = f.i0 JOIN pg a ON a.event_type = ra.event_type AND a.day = ra.day
      JOIN r rb ON rb.event_type = f.event_type AND rb.rn = f.i1 JOIN pg b ON b.event_type = rb.event_type AND b.day = rb.day)
SELECT e.event_id, e.event_type, e.day,
       {S6('s1.ps - COALESCE(s0.ps, 0)')} AS peer_sum, e.e1 - e.e0 + 1 AS peer_count
FROM e JOIN r s1 ON s1.event_type = e.event_type AND s1.rn = e.e1
LEFT JOIN r s0 ON s0.event_type = e.event_type AND s0.rn = e.e0 - 1""")
def w14_peer_frame(spark, d):
    e = ev(spark, d).select("event_id", "event_type", F.to_date("ts").alias("day"), "value")
    s = tf.window(e, {"peer_sum": ("sum", "value"), "peer_count": ("count",)}, sort=["day"],
                  groupby=["event_type"], frame=(-2, 2), tiebreak=["event_id"])
    return s.select("event_id", "event_type", "day", q6("peer_sum").alias("peer_sum"), "peer_count")


# a third of the values are null or NaN; frames of every kind, widened to whole days
ODD_SQL = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END"""
W14_OPS = {"peer_min": ("min", "x", None, (-3, 3)), "peer_max": ("max", "x", None, (-1, 1)), "peer_first": ("first_value", "x", None, (-2, 0)),
           "peer_last": ("last_value", "x", None, (0, 4)), "peer_third": ("nth_value", "x", 3, (-1, 2)), "peer_valid": ("valid", "x", None, (-4, -1)),
           "peer_count": ("count", None, None, (1, 3)), "min_so_far": ("min", "x", None, (None, 2)), "max_from_here": ("max", "x", None, (-2, None)),
           "sum_ahead": ("sum", "x", None, (1, 2))}


def _over(lo: int, hi: int, value: str) -> str:
    """An aggregate over the rows of a frame's peer groups, by a join on row numbers."""
    return f"""(SELECT {value} FROM r, (SELECT MIN(p0) AS e0, MAX(p1) AS e1 FROM r b WHERE b.event_type = a.event_type
                AND b.rn BETWEEN a.rn + ({lo}) AND a.rn + ({hi})) e WHERE r.event_type = a.event_type AND r.rn BETWEEN e0 AND e1)"""


@job("w14_peer_frame_all_ops", f"""
WITH d AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, {ODD_SQL} AS x FROM events),
r0 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY day, event_id) AS rn FROM d),
r AS (SELECT *, MIN(rn) OVER (PARTITION BY event_type, day) AS p0, MAX(rn) OVER (PARTITION BY event_type, day) AS p1 FROM r0)
SELECT event_id, {_over(-3, 3, 'MIN(x)')} AS peer_min, {_over(-1, 1, 'MAX(x)')} AS peer_max,
  {_over(-2, 0, 'FIRST(x ORDER BY rn)')} AS peer_first, {_over(0, 4, 'LAST(x ORDER BY rn)')} AS peer_last,
  {_over(-1, 2, 'LIST(x ORDER BY rn)[3]')} AS peer_third, {_over(-4, -1, 'COUNT(x) FILTER (WHERE NOT isnan(x))')} AS peer_valid,
  {_over(1, 3, 'COUNT(*)')} AS peer_count, {_over(-1000000000, 2, 'MIN(x)')} AS min_so_far, {_over(-2, 1000000000, 'MAX(x)')} AS max_from_here,
  CASE WHEN isnan({_over(1, 2, 'SUM(x)')}) THEN CAST('nan' AS DOUBLE) ELSE {S6(_over(1, 2, 'SUM(x)'))} END AS sum_ahead
FROM r a""")
def w14_peer_frame_all_ops(spark, d):
    x = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, float("nan")).otherwise(F.col("value"))
    e = ev(spark, d).select("event_id", "event_type", F.to_date("ts").alias("day"), x.alias("x"))
    w = tf.window(e, W14_OPS, sort=["day"], groupby=["event_type"], tiebreak=["event_id"])
    total = F.when(F.isnan("sum_ahead"), F.col("sum_ahead")).otherwise(q6("sum_ahead"))
    return w.select("event_id", *[n for n in W14_OPS if n != "sum_ahead"], total.alias("sum_ahead"))


# ------------------------------------------------------------------ T22 boxplot / T23 error extent

@job("t22_boxplot", """
WITH q AS (SELECT event_type, COUNT(value) AS count, QUANTILE_CONT(value, 0.25) AS q1,
                  QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3 FROM events GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT f.event_type, f.count, ROUND(f.q1, 6) AS q1, ROUND(f.median, 6) AS median, ROUND(f.q3, 6) AS q3,
       MIN(e.value) FILTER (WHERE e.value BETWEEN lf AND uf) AS lower,
       MAX(e.value) FILTER (WHERE e.value BETWEEN lf AND uf) AS upper,
       COUNT(*) FILTER (WHERE NOT e.value BETWEEN lf AND uf) AS outliers
FROM f JOIN events e USING (event_type) GROUP BY 1, 2, 3, 4, 5""")
def t22_boxplot(spark, d):
    b = stats.boxplot_stats(ev(spark, d), "value", ["event_type"])
    return b.select("event_type", "count", F.round("q1", 6).alias("q1"), F.round("median", 6).alias("median"),
                    F.round("q3", 6).alias("q3"), "lower", "upper", "outliers")


@job("t23_error_extent", f"""
SELECT event_type, {S6('AVG(value)')} AS center,
       {S6('AVG(value) - STDDEV_SAMP(value) / SQRT(COUNT(value))')} AS lower,
       {S6('AVG(value) + STDDEV_SAMP(value) / SQRT(COUNT(value))')} AS upper FROM events GROUP BY 1""")
def t23_error_extent(spark, d):
    x = stats.error_extent(ev(spark, d), "value", "stderr", ["event_type"])
    return x.select("event_type", q6("center").alias("center"), q6("lower").alias("lower"),
                    q6("upper").alias("upper"))


@job("t23_quartiles", """
SELECT event_type, QUANTILE_CONT(value, 0.5) AS center, QUANTILE_CONT(value, 0.25) AS lower, QUANTILE_CONT(value, 0.75) AS upper
FROM events GROUP BY 1""".replace("QUANTILE_CONT(value, 0.5) AS", f"{S6('QUANTILE_CONT(value, 0.5)')} AS")
     .replace("QUANTILE_CONT(value, 0.25) AS", f"{S6('QUANTILE_CONT(value, 0.25)')} AS").replace("QUANTILE_CONT(value, 0.75) AS", f"{S6('QUANTILE_CONT(value, 0.75)')} AS"))
def t23_quartiles(spark, d):
    x = stats.error_extent(ev(spark, d), "value", "iqr", ["event_type"])
    return x.select("event_type", q6("center").alias("center"), q6("lower").alias("lower"), q6("upper").alias("upper"))


@job("a14_bootstrap_ci", f"""
WITH h AS (SELECT event_type, value, md5('42|' || event_id) AS d FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
ab AS (SELECT event_type, value, CAST('0x' || substr(d, 1, 7) AS BIGINT) AS a, CAST('0x' || substr(d, 9, 7) AS BIGINT) AS b FROM h),
draw AS (SELECT event_type, value, r, (a + r * b) % {stats.DRAWS} AS u FROM ab, range(1, 201) t(r)),
w AS (SELECT event_type, r, value, {' + '.join(f'CAST(u >= {x} AS INTEGER)' for x in stats.poisson_steps())} AS w FROM draw),
m AS (SELECT event_type, r, SUM(w * value) / SUM(w) AS m FROM w GROUP BY 1, 2),
c AS (SELECT event_type, AVG(value) AS center FROM events GROUP BY 1)
SELECT c.event_type, {S6('ANY_VALUE(center)')} AS center, {S6('QUANTILE_CONT(m, 0.025)')} AS lower, {S6('QUANTILE_CONT(m, 0.975)')} AS upper
FROM c JOIN m USING (event_type) GROUP BY 1""")
def a14_bootstrap_ci(spark, d):
    x = stats.error_extent(ev(spark, d), "value", "ci", ["event_type"], reps=200, key=["event_id"])
    return x.select("event_type", q6("center").alias("center"), q6("lower").alias("lower"), q6("upper").alias("upper"))


# ------------------------------------------------------------------ A16 / A17 exponential

@job("a16_exponential", f"""
WITH r AS (SELECT event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,
                  COUNT(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type,
       {S6('SUM(CASE WHEN rn = 1 THEN 1.0 ELSE 0.5 END * POWER(0.5, n - rn) * value)')} AS exponential,
       {S6('SUM(POWER(0.5, n - rn) * value) / SUM(POWER(0.5, n - rn))')} AS exponentialb
FROM r GROUP BY 1""")
def a16_exponential(spark, d):
    order = ["ts", "event_id"]
    out = tf.aggregate(ev(spark, d), {"exponential": ("exponential", "value", 0.5, order), "exponentialb": ("exponentialb", "value", 0.5, order)}, ["event_type"])
    return out.select("event_type", q6("exponential").alias("exponential"), q6("exponentialb").alias("exponentialb"))


@job("a16_running_exponential", f"""
WITH r AS (SELECT event_id, event_type, {ODD_SQL} AS x, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
v AS (SELECT event_type, x, rn, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY rn) AS k FROM r WHERE x IS NOT NULL AND NOT isnan(x)),
n AS (SELECT r.event_id, r.event_type, (SELECT COUNT(*) FROM v WHERE v.event_type = r.event_type AND v.rn <= r.rn) AS n FROM r),
s AS (SELECT n.event_id, SUM(CASE WHEN k = 1 THEN 1.0 ELSE 0.2 END * POWER(0.8, n - k) * x) AS a,
             SUM(0.2 * POWER(0.8, n - k) * x) / (1 - POWER(0.8, ANY_VALUE(n))) AS b
      FROM n JOIN v ON v.event_type = n.event_type AND v.k <= n.n AND v.k > n.n - 200 GROUP BY 1)
SELECT r.event_id, {S6('a')} AS average, {S6('b')} AS corrected FROM r LEFT JOIN s USING (event_id)""")
def a16_running_exponential(spark, d):
    """Running exponential averages (A16, A17) of all values so far that are neither null nor NaN."""
    x = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, float("nan")).otherwise(F.col("value"))
    e = ev(spark, d).select("event_id", "event_type", "ts", x.alias("x"))
    w = tf.window(e, {"average": ("exponential", "x", 0.2), "corrected": ("exponentialb", "x", 0.2)}, sort=["ts", "event_id"],
                  groupby=["event_type"], ignore_peers=True)
    return w.select("event_id", q6("average").alias("average"), q6("corrected").alias("corrected"))


# ------------------------------------------------------------------ T24 repeat / T25 facet / T29

@job("t24_repeat", f"""
SELECT 'value' AS repeat, event_type, {S6('AVG(value)')} AS mean, MAX(value) AS max FROM events GROUP BY 2
UNION ALL
SELECT 'user_id', event_type, {S6('AVG(CAST(user_id AS DOUBLE))')}, MAX(CAST(user_id AS DOUBLE)) FROM events GROUP BY 2""")
def t24_repeat(spark, d):
    r = tf.repeat_columns(ev(spark, d), ["value", "user_id"], {"mean": ("mean", "x"), "max": ("max", "x")},
                          groupby=["event_type"])
    return r.select("repeat", "event_type", q6("mean").alias("mean"), "max")


@job("t25_facet", """
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def t25_facet(spark, d):
    e = ev(spark, d).withColumn("hour", F.hour("ts"))
    return tf.facet_aggregate(e, ["event_type"], {"n": ("count",)}, ["hour"])


@job("t29_encoded_aggregate", f"""
SELECT make_timestamp(year(ts), month(ts), 1, 0, 0, 0) AS month_ts, event_type,
       {S6('AVG(value)')} AS mean_value, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def t29_encoded_aggregate(spark, d):
    from ..operators.encoding import chart_aggregate
    out = chart_aggregate(ev(spark, d), x=("yearmonth", "ts", "month_ts"), color="event_type",
                          y=("mean", "value", "mean_value"), size=("count", None, "n"))
    return out.select("month_ts", "event_type", q6("mean_value").alias("mean_value"), "n")


# ------------------------------------------------------------------ T26 scale binning

@job("t26_scale_binning", """
WITH ext AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events),
b AS (SELECT e.event_id,
        LEAST(GREATEST(CAST(FLOOR((e.value - lo) / (hi - lo) * 5) AS INTEGER), 0), 4) AS quantize,
        (CASE WHEN value >= 5 THEN 1 ELSE 0 END + CASE WHEN value >= 10 THEN 1 ELSE 0 END
         + CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS threshold
      FROM events e, ext)
SELECT quantize, threshold, COUNT(*) AS n FROM b GROUP BY 1, 2""")
def t26_scale_binning(spark, d):
    e = ev(spark, d)
    e = stats.quantize_bucket(e, "value", 5, "quantize")
    e = stats.threshold_bucket(e, "value", [5, 10, 50], "threshold")
    return e.groupBy("quantize", "threshold").agg(F.count(F.lit(1)).alias("n"))


@job("t26_quantile_scale", """
WITH c AS (SELECT event_type, QUANTILE_CONT(value, [0.25, 0.5, 0.75]) AS cuts FROM events GROUP BY 1)
SELECT e.event_type,
       (CASE WHEN e.value >= cuts[1] THEN 1 ELSE 0 END + CASE WHEN e.value >= cuts[2] THEN 1 ELSE 0 END
        + CASE WHEN e.value >= cuts[3] THEN 1 ELSE 0 END) AS bucket, COUNT(*) AS n
FROM events e JOIN c USING (event_type) GROUP BY 1, 2""")
def t26_quantile_scale(spark, d):
    e = stats.quantile_bucket(ev(spark, d), "value", 4, ["event_type"], "bucket")
    return e.groupBy("event_type", "bucket").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T27 sort by other field

@job("t27_sort_by_field", """
SELECT p_type, CAST(s AS DOUBLE) AS sort_value, CAST(ROW_NUMBER() OVER (ORDER BY s DESC, p_type) AS INTEGER) AS "order"
FROM (SELECT p.p_type, SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS s
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1) t""")
def t27_sort_by_field(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")) \
                  .select("p_type", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    s = tf.sort_by_field(j, "p_type", "amount", "sum", descending=True)
    return s.select("p_type", dbl("sort_value").alias("sort_value"), "order")


# ------------------------------------------------------------------ T9 loess (rows-only)

LOESS_SQL = f"""
WITH h AS (SELECT event_type, CAST(epoch_us(ts) // 3600000000 AS DOUBLE) AS x, SUM(value) AS y
           FROM events GROUP BY 1, 2),
n AS (SELECT event_type, COUNT(*) AS n FROM h GROUP BY 1),
pairs AS (SELECT a.event_type, a.x AS x0, b.x, b.y, ABS(b.x - a.x) AS dist,
                 ROW_NUMBER() OVER (PARTITION BY a.event_type, a.x ORDER BY ABS(b.x - a.x), b.x) AS k
          FROM h a JOIN h b USING (event_type)),
win AS (SELECT p.* FROM pairs p JOIN n USING (event_type) WHERE p.k <= GREATEST(CEIL(0.3 * n.n), 2)),
hh AS (SELECT *, MAX(dist) OVER (PARTITION BY event_type, x0) AS bw FROM win),
w AS (SELECT *, CASE WHEN bw > 0 THEN POWER(GREATEST(1 - POWER(dist / bw, 3), 0), 3) ELSE 1.0 END AS tri FROM hh),
m AS (SELECT event_type, x0, SUM(tri) AS sw, SUM(tri * x) / SUM(tri) AS xm, SUM(tri * y) / SUM(tri) AS ym
      FROM w GROUP BY 1, 2),
fit AS (SELECT w.event_type, w.x0, m.xm, m.ym,
               SUM(w.tri * (w.x - m.xm) * w.y) AS sxy, SUM(w.tri * (w.x - m.xm) * (w.x - m.xm)) AS sxx
        FROM w JOIN m USING (event_type, x0) GROUP BY 1, 2, 3, 4)
SELECT event_type, {R('x0', 4)} AS hour_index,
       {R('ym + CASE WHEN sxx > 0 THEN sxy / sxx ELSE 0 END * (x0 - xm)', 4)} AS value
FROM fit"""


@job("t9_loess", LOESS_SQL)
def t9_loess(spark, d):
    daily = ev(spark, d).groupBy("event_type", (F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)
                                 .cast("bigint").alias("hour_index")) \
                        .agg(F.sum("value").alias("value"))
    fit = loess(daily, "hour_index", "value", groupby=["event_type"], bandwidth=0.3)
    # a local least-squares fit: reported to 4 decimals (sum orders differ around 1e-10)
    return fit.select("event_type", round_half_up("hour_index", 4).alias("hour_index"),
                      round_half_up("value", 4).alias("value"))


# ------------------------------------------------------------------ T28 layered / T21 transform chain

@job("t28_layered", f"""
SELECT 'by_type' AS view, event_type AS k, COUNT(*) AS n, {S6('SUM(value)')} AS total FROM events GROUP BY 2
UNION ALL
SELECT 'by_day', CAST(CAST(ts AS DATE) AS VARCHAR), COUNT(*), {S6('SUM(value)')} FROM events GROUP BY 2""")
def t28_layered(spark, d):
    views = tf.layered(ev(spark, d), {
        "by_type": lambda x: x.groupBy(F.col("event_type").alias("k")).agg(
            F.count(F.lit(1)).alias("n"), q6(F.sum("value")).alias("total")),
        "by_day": lambda x: x.groupBy(F.to_date("ts").cast("string").alias("k")).agg(
            F.count(F.lit(1)).alias("n"), q6(F.sum("value")).alias("total")),
    })
    out = None
    for name, v in views.items():
        v = v.select(F.lit(name).alias("view"), "k", "n", "total")
        out = v if out is None else out.unionByName(v)
    return out


@job("t21_transform_chain", f"""
SELECT event_type, COUNT(*) AS n, {S6('AVG(value * 2)')} AS mean_double
FROM events WHERE value > 10 GROUP BY 1""")
def t21_transform_chain(spark, d):
    steps = [lambda x: tf.calculate(x, double_value=F.col("value") * 2),
             lambda x: tf.filter_(x, F.col("value") > 10),
             lambda x: tf.aggregate(x, {"n": ("count",), "mean_double": ("mean", "double_value")},
                                    ["event_type"])]
    out = tf.chain(ev(spark, d), steps)
    return out.select("event_type", "n", q6("mean_double").alias("mean_double"))
