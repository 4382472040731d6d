"""Registered jobs for joins (J5-J8, P19), predicates and selections (P9-P20),
scalar and date functions (E*, C*) and the text profile (G*), each next to its SQL
twin when one exists.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import expr as E
from ..functions import timeunits as tu
from ..functions.numeric import round_half_up
from ..operators import joins as J
from ..operators import selections as P
from ..operators import transforms as tf
from ..sources.tables import Tables
from . import text_profile as G
from .oracle_sql import KPIS, R, W

KPI_SQL = KPIS["k1_headline_kpis"]

JOBS: dict = {}
ORACLE: dict[str, str] = {}


def q6(c):
    return round_half_up(c, 6)


def S6(x: str) -> str:
    return R(x, 6)


def job(name: str, sql: str | None = None):
    def deco(fn):
        JOBS[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def T(spark: SparkSession, d: str) -> Tables:
    return Tables(spark, d)


# ================================================================== joins

@job("j5_lookup", """
SELECT o.o_orderkey, o.o_custkey, COALESCE(c.c_name, 'unknown') AS c_name,
       COALESCE(c.c_mktsegment, 'unknown') AS c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def j5_lookup(spark, d):
    t = T(spark, d)
    return J.lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer, "o_custkey", "c_custkey",
                    fields=["c_name", "c_mktsegment"], default="unknown")


@job("j6_membership", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_delivered
FROM customer""")
def j6_membership(spark, d):
    t = T(spark, d)
    return J.indata(t.customer.select("c_custkey"), t.orders.filter(F.col("o_orderstatus") == "F"),
                    "c_custkey", "o_custkey", as_="has_delivered")


@job("j6_semi_anti", """
SELECT 'semi' AS kind, COUNT(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT 'anti', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j6_semi_anti(spark, d):
    t = T(spark, d)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    a = J.semi(t.customer, o, "c_custkey", True).agg(F.count(F.lit(1)).alias("n")).select(F.lit("semi").alias("kind"), "n")
    b = J.semi(t.customer, o, "c_custkey", False).agg(F.count(F.lit(1)).alias("n")).select(F.lit("anti").alias("kind"), "n")
    return a.unionByName(b)


def _span(t: Tables) -> tuple[_dt.datetime, _dt.datetime]:
    r = t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return r.a, r.b


def paydays(spark, t: Tables) -> DataFrame:
    """Last business day (Mon-Fri) of each month over the order span."""
    a, b = _span(t)
    return cal.recurrence(spark, "MONTHLY", _dt.datetime(a.year, a.month, 1), until=b + _dt.timedelta(days=40),
                          byweekday=[0, 1, 2, 3, 4], bysetpos=[-1])


# the last day of every month, moved back over a weekend
PAYDAY_SQL = """
span AS (SELECT MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders),
months AS (SELECT CAST(g AS TIMESTAMP) AS month FROM span,
           generate_series(CAST(date_trunc('month', a) AS TIMESTAMP), CAST(date_trunc('month', b + INTERVAL 40 DAY) AS TIMESTAMP), INTERVAL 1 MONTH) t(g)),
ends AS (SELECT CAST(last_day(month) AS TIMESTAMP) AS day FROM months),
payday AS (SELECT day - to_days(CASE dayofweek(day) WHEN 6 THEN 1 WHEN 0 THEN 2 ELSE 0 END) AS occurrence FROM ends),
paydays AS (SELECT occurrence FROM payday, span WHERE occurrence <= b + INTERVAL 40 DAY)
"""


def _orders_on(t: Tables, occurrences: DataFrame) -> DataFrame:
    """The orders placed on each occurrence's day (also on days without any)."""
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    j = occurrences.join(per_day, F.to_date("occurrence") == F.col("day"), "left")
    return j.select("occurrence", F.coalesce("n", F.lit(0)).alias("orders"))


ORDERS_ON_SQL = """(SELECT COUNT(*) FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(occurrence AS DATE)) AS orders"""


@job("c13_recurrence", f"WITH {PAYDAY_SQL} SELECT occurrence, {ORDERS_ON_SQL} FROM paydays")
def c13_recurrence(spark, d):
    t = T(spark, d)
    return _orders_on(t, paydays(spark, t))


@job("c13_nth_weekday", f"""
WITH span AS (SELECT MIN(o_orderdate) + INTERVAL 9 DAY AS a, MAX(o_orderdate) - INTERVAL 9 DAY AS b FROM orders),
days AS (SELECT CAST(g AS TIMESTAMP) AS day FROM span, generate_series(CAST(date_trunc('year', a) AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY) t(g)),
monday AS (SELECT 'first monday' AS rule, day AS occurrence FROM days WHERE dayofweek(day) = 1 AND day(day) <= 7),
friday AS (SELECT 'last friday', day FROM days WHERE dayofweek(day) = 5 AND month(day + INTERVAL 7 DAY) <> month(day)),
tuesday AS (SELECT 'second tuesday', day FROM days WHERE dayofweek(day) = 2 AND dayofyear(day) BETWEEN 8 AND 14),
every AS (SELECT * FROM monday UNION ALL SELECT * FROM friday UNION ALL SELECT * FROM tuesday)
SELECT rule, occurrence, {ORDERS_ON_SQL} FROM every, span WHERE occurrence BETWEEN a AND b""")
def c13_nth_weekday(spark, d):
    """Rules whose first and last period are cut by the start and the end of the orders."""
    t = T(spark, d)
    a, b = _span(t)
    a, b = a + _dt.timedelta(days=9), b - _dt.timedelta(days=9)
    rules = {"first monday": ("MONTHLY", (0, 1)), "last friday": ("MONTHLY", (4, -1)), "second tuesday": ("YEARLY", (1, 2))}
    out = None
    for name, (freq, day) in rules.items():
        one = _orders_on(t, cal.recurrence(spark, freq, a, until=b, byweekday=[day])).select(F.lit(name).alias("rule"), "occurrence", "orders")
        out = one if out is None else out.unionByName(one)
    return out


@job("c13_subdaily", """
WITH span AS (SELECT date_trunc('hour', MIN(ts)) AS a, MAX(ts) AS b FROM events),
hours AS (SELECT 'seven hours' AS rule, g AS occurrence FROM span, generate_series(a, b, INTERVAL 7 HOUR) t(g)
          WHERE hour(g) BETWEEN 8 AND 17 AND dayofweek(g) BETWEEN 1 AND 5),
minutes AS (SELECT 'fifty minutes', g FROM span, generate_series(a, b, INTERVAL 50 MINUTE) t(g) WHERE minute(g) IN (0, 20) AND day(g) = 3),
every AS (SELECT * FROM hours UNION ALL SELECT * FROM minutes)
SELECT rule, occurrence, (SELECT COUNT(*) FROM events WHERE date_trunc('hour', ts) = date_trunc('hour', occurrence)) AS events FROM every""")
def c13_subdaily(spark, d):
    """Hourly and minutely rules over the span of the events, with the events of each one's hour."""
    e = T(spark, d).events
    r = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    start = r.a.replace(minute=0, second=0, microsecond=0, tzinfo=None)
    until = r.b.replace(tzinfo=None)
    hours = cal.recurrence(spark, "HOURLY", start, until=until, interval=7, byhour=list(range(8, 18)), byweekday=[0, 1, 2, 3, 4])
    minutes = cal.recurrence(spark, "MINUTELY", start, until=until, interval=50, byminute=[0, 20], bymonthday=[3])
    every = hours.select(F.lit("seven hours").alias("rule"), "occurrence").unionByName(minutes.select(F.lit("fifty minutes").alias("rule"), "occurrence"))
    per_hour = e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    j = every.join(per_hour, F.date_trunc("hour", "occurrence").cast("timestamp_ntz") == F.col("hour"), "left")
    return j.select("rule", "occurrence", F.coalesce("n", F.lit(0)).alias("events"))


@job("j7_asof", f"""
WITH {PAYDAY_SQL}
SELECT o.o_orderkey, o.o_orderdate,
       (SELECT MAX(occurrence) FROM paydays p WHERE p.occurrence <= o.o_orderdate) AS last_payday,
       (SELECT MIN(occurrence) FROM paydays p WHERE p.occurrence >= o.o_orderdate) AS next_payday
FROM orders o""")
def j7_asof(spark, d):
    t = T(spark, d)
    pd_ = paydays(spark, t)
    o = t.orders.select("o_orderkey", "o_orderdate")
    return J.asof(o, "o_orderdate", pd_, direction="both", as_=["last_payday", "next_payday"])


@job("j8_between", f"""
WITH {PAYDAY_SQL}
SELECT o.o_orderkey, p.occurrence
FROM orders o JOIN paydays p ON p.occurrence > o.o_orderdate AND p.occurrence < o.o_orderdate + INTERVAL 45 DAY""")
def j8_between(spark, d):
    t = T(spark, d)
    o = t.orders.select("o_orderkey", "o_orderdate",
                        F.timestamp_add("DAY", F.lit(45), "o_orderdate").alias("o_until"))
    return J.between(o, "o_orderdate", "o_until", paydays(spark, t)).select("o_orderkey", "occurrence")


@job("c14_recurrence_set", f"""
WITH {PAYDAY_SQL},
mid AS (SELECT month + INTERVAL 14 DAY AS occurrence FROM months),
allocc AS (SELECT occurrence FROM paydays UNION SELECT occurrence FROM mid, span WHERE occurrence >= date_trunc('month', a) AND occurrence <= b + INTERVAL 40 DAY)
SELECT occurrence, {ORDERS_ON_SQL} FROM allocc WHERE month(occurrence) <> 12""")
def c14_recurrence_set(spark, d):
    t = T(spark, d)
    a, b = _span(t)
    start = _dt.datetime(a.year, a.month, 1)
    until = b + _dt.timedelta(days=40)
    mid = cal.recurrence(spark, "MONTHLY", start, until=until, bymonthday=[15])
    dec = cal.recurrence(spark, "YEARLY", start, until=until, bymonth=[12], bymonthday=list(range(1, 32)))
    return _orders_on(t, cal.recurrence_set([paydays(spark, t), mid], [dec]))


@job("p19_tolerance_join", """
SELECT c.event_id AS click_id, p.event_id AS purchase_id
FROM events c JOIN events p ON c.user_id = p.user_id
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
  AND ABS(date_diff('microsecond', c.ts, p.ts)) <= 3600000000""")
def p19_tolerance_join(spark, d):
    e = T(spark, d).events
    c = e.filter(F.col("event_type") == "click").select(F.col("event_id").alias("click_id"), "user_id",
                                                        F.col("ts").alias("c_ts"))
    p = e.filter(F.col("event_type") == "purchase").select(F.col("event_id").alias("purchase_id"), "user_id",
                                                           F.col("ts").alias("p_ts"))
    return J.tolerance_join(c, p, "c_ts", "p_ts", 3600, on=["user_id"]).select("click_id", "purchase_id")


# ================================================================== predicates / selections

@job("p10_filter", """
SELECT event_id FROM events
WHERE value BETWEEN 10 AND 100 AND event_type IN ('click', 'view') AND user_id < 100
  AND NOT (value > 90) AND (hour(ts) < 12 OR event_type = 'view') AND event_type = 'click'""")
def p10_filter(spark, d):
    e = T(spark, d).events
    pred = P.and_(P.field_range("value", 10, 100), P.field_one_of("event_type", ["click", "view"]),
                  P.field_lt("user_id", 100), P.not_(P.field_gt("value", 90)),
                  P.or_(F.hour("ts") < 12, P.field_equal("event_type", "view")))
    return tf.filter_(e, pred, event_type="click").select("event_id")


@job("p11_when_chain", """
SELECT event_id, CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS band
FROM events""")
def p11_when_chain(spark, d):
    e = T(spark, d).events
    band = P.when_chain([(F.col("value") < 10, "low"), (F.col("value") < 100, "mid")], "high")
    return e.select("event_id", band.alias("band"))


@job("p9_calculate", f"""
SELECT event_id, value * 2 AS v2, value * 2 + 1 AS v3, {S6('LN(value * 2 + 1)')} AS lv FROM events""")
def p9_calculate(spark, d):
    e = T(spark, d).events.select("event_id", "value")
    c = tf.calculate(e, v2="value * 2", v3=F.col("v2") + 1, lv=q6(F.log("v3")))
    return c.select("event_id", "v2", "v3", "lv")


@job("p14_named_params", """
SELECT event_type, COUNT(*) AS n FROM events WHERE value >= 50 AND event_type <> 'error' GROUP BY 1""")
def p14_named_params(spark, d):
    T(spark, d).events.createOrReplaceTempView("events_view")
    return P.sql_with_params(
        spark, "SELECT event_type, COUNT(*) AS n FROM events_view WHERE value >= :lo AND event_type <> :skip "
               "GROUP BY event_type", lo=50, skip="error")


@job("p15_point_selection", """
WITH chosen AS (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 2)
SELECT c_custkey FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM chosen)""")
def p15_point_selection(spark, d):
    c = T(spark, d).customer
    chosen = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")) \
              .orderBy(F.desc("n"), "c_mktsegment").limit(2)
    return P.point_select(c, chosen, ["c_mktsegment"]).select("c_custkey")


@job("p16_interval_selection", """
SELECT event_id FROM events
WHERE value BETWEEN 20 AND 80 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
  AND event_type IN ('click', 'purchase')""")
def p16_interval_selection(spark, d):
    e = T(spark, d).events
    pred = P.interval_predicate({"value": [80, 20],
                                 "ts": [_dt.datetime(2024, 1, 5), _dt.datetime(2024, 1, 20)],
                                 "event_type": ["click", "purchase"]})
    return e.filter(pred).select("event_id")


@job("p17_index_selection", """
SELECT event_id, idx AS _index FROM (
  SELECT event_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events) t
WHERE idx IN (0, 1, 10, 100, 1000)""")
def p17_index_selection(spark, d):
    e = T(spark, d).events
    return P.index_select(e, ["ts", "event_id"], [0, 1, 10, 100, 1000]).select("event_id", "_index")


@job("p18_selection_resolve", """
SELECT 'union' AS how, COUNT(*) FILTER (WHERE value > 200 OR event_type = 'signup') AS n FROM events
UNION ALL SELECT 'intersect', COUNT(*) FILTER (WHERE value > 200 AND event_type = 'signup') FROM events
UNION ALL SELECT 'global', COUNT(*) FILTER (WHERE event_type = 'signup') FROM events""")
def p18_selection_resolve(spark, d):
    e = T(spark, d).events
    preds = [F.col("value") > 200, F.col("event_type") == "signup"]
    parts = [e.agg(F.count(F.when(P.resolve(preds, h), F.lit(1))).alias("n")).select(F.lit(h).alias("how"), "n")
             for h in ("union", "intersect", "global")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@job("p20_invalid_filter", """
SELECT event_id FROM events WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL""")
def p20_invalid_filter(spark, d):
    return P.drop_invalid(T(spark, d).events, ["value", "user_id"]).select("event_id")


# ================================================================== C* date functions

@job("c4_date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(FLOOR((month(ts) - 1) / 3) AS INTEGER) AS quarter,
       CAST(month(ts) - 1 AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS date, CAST(dayofweek(ts) AS INTEGER) AS day,
       CAST(dayofyear(ts) AS INTEGER) AS dayofyear,
       CAST(strftime(ts, '%U') AS INTEGER) AS week,
       CAST(hour(ts) AS INTEGER) AS hours, CAST(minute(ts) AS INTEGER) AS minutes, CAST(FLOOR(second(ts)) AS INTEGER) AS seconds,
       CAST(FLOOR(microsecond(ts) / 1000) % 1000 AS INTEGER) AS milliseconds,
       epoch_us(ts) // 1000 AS time
FROM events""")
def c4_date_parts(spark, d):
    e = T(spark, d).events
    names = ["year", "quarter", "month", "date", "day", "dayofyear", "week", "hours", "minutes",
             "seconds", "milliseconds"]
    return e.select("event_id", *[tu.date_part(n, "ts").cast("int" if n != "year" else "int").alias(n)
                                  for n in names], tu.time_ms("ts").alias("time"))


@job("c6_c8_build_offset", """
SELECT o_orderkey,
       make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) + to_months(month(o_orderdate) - 1 + 13) + INTERVAL 4 DAY AS built,
       o_orderdate + INTERVAL 3 MONTH AS plus_quarter, o_orderdate + INTERVAL 14 DAY AS plus_2weeks,
       o_orderdate - INTERVAL 90 MINUTE AS minus_90min
FROM orders""")
def c6_c8_build_offset(spark, d):
    o = T(spark, d).orders
    built = tu.datetime_(F.year("o_orderdate"), F.month("o_orderdate") - 1 + 13, 5)
    return o.select("o_orderkey", built.alias("built"),
                    tu.time_offset("quarter", "o_orderdate", 1).alias("plus_quarter"),
                    tu.time_offset("week", "o_orderdate", 2).alias("plus_2weeks"),
                    tu.time_offset("minutes", "o_orderdate", -90).alias("minus_90min"))


@job("c9_time_sequence", """
SELECT o_orderkey, CAST(len(generate_series(o_orderdate, o_orderdate + INTERVAL 30 DAY, INTERVAL 7 DAY))
       - CASE WHEN (o_orderdate + INTERVAL 28 DAY) = (o_orderdate + INTERVAL 30 DAY) THEN 1 ELSE 0 END AS INTEGER) AS n_weeks
FROM orders""")
def c9_time_sequence(spark, d):
    o = T(spark, d).orders
    seq = tu.time_sequence("week", "o_orderdate", F.timestamp_add("DAY", F.lit(30), "o_orderdate"))
    return o.select("o_orderkey", F.size(seq).alias("n_weeks"))


@job("c10_time_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%d/%m/%y') AS dmy,
       strftime(o_orderdate, '%B %Y') AS month_year, strftime(o_orderdate, '%a') AS dow_abbrev,
       dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name
FROM orders""")
def c10_time_format(spark, d):
    o = T(spark, d).orders
    return o.select("o_orderkey", tu.time_format("o_orderdate", "%Y-%m-%d").alias("iso"),
                    tu.time_format("o_orderdate", "%d/%m/%y").alias("dmy"),
                    tu.time_format("o_orderdate", "%B %Y").alias("month_year"),
                    tu.day_abbrev_format(tu.date_part("day", "o_orderdate")).alias("dow_abbrev"),
                    tu.day_format(tu.date_part("day", "o_orderdate")).alias("day_name"),
                    tu.month_format(tu.date_part("month", "o_orderdate")).alias("month_name"))


@job("c10_time_parse", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS parsed FROM orders""")
def c10_time_parse(spark, d):
    o = T(spark, d).orders
    txt = tu.time_format("o_orderdate", "%d/%m/%Y")
    return o.select("o_orderkey", tu.time_parse(txt, "%d/%m/%Y").alias("parsed"))


MONTH_DIFF_SQL = """
WITH p AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate AS a, o.o_orderdate AS b
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
m0 AS (SELECT *, (year(a) - year(b)) * 12 + (month(a) - month(b)) AS m0 FROM p),
m1 AS (SELECT *, CASE WHEN a >= b AND b + to_months(m0) > a THEN m0 - 1
                      WHEN a < b AND b + to_months(m0) < a THEN m0 + 1 ELSE m0 END AS m1 FROM m0),
m2 AS (SELECT *, CASE WHEN a >= b AND b + to_months(m1) > a THEN m1 - 1
                      WHEN a < b AND b + to_months(m1) < a THEN m1 + 1 ELSE m1 END AS m2 FROM m1)
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CASE WHEN m2 < 0 THEN -1 ELSE 1 END * FLOOR(ABS(m2) / 12) AS INTEGER) AS years,
       CAST(m2 - CASE WHEN m2 < 0 THEN -1 ELSE 1 END * FLOOR(ABS(m2) / 12) * 12 AS INTEGER) AS months,
       CAST(date_diff('microsecond', b + to_months(m2), a) AS DOUBLE) / 1e6 AS seconds
FROM m2"""


@job("c11_month_diff", MONTH_DIFF_SQL)
def c11_month_diff(spark, d):
    t = T(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    md = cal.month_diff("l_shipdate", "o_orderdate")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", md["years"].alias("years"),
                    md["months"].alias("months"), md["seconds"].alias("seconds"))


@job("c12_calendar_shift", """
WITH s AS (SELECT o_orderkey, o_orderdate,
                  make_date(CAST(year(o_orderdate) + FLOOR((month(o_orderdate) + 1 - 1) / 12) AS INTEGER),
                            CAST((month(o_orderdate) + 1 - 1) % 12 + 1 AS INTEGER), 1) AS first FROM orders),
b AS (SELECT o_orderkey, CAST(make_date(year(first), month(first), LEAST(31, day(last_day(first)))) AS TIMESTAMP)
             + INTERVAL 25 HOUR AS t FROM s)
SELECT o_orderkey, t + to_days(CAST((7 - (isodow(t) - 1) + 0) % 7 AS INTEGER)) AS shifted FROM b""")
def c12_calendar_shift(spark, d):
    o = T(spark, d).orders
    return o.select("o_orderkey", cal.calendar_shift("o_orderdate", months=1, day=31, hours=25,
                                                     weekday=(0, 1)).alias("shifted"))


@job("c15_easter", """
WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
-- Meeus, Jones and Butcher
western AS (
  SELECT year, (19 * (year % 19) + year // 100 - year // 400 - (year // 100 - (year // 100 + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM years
), western2 AS (
  SELECT year, h, (32 + 2 * ((year // 100) % 4) + 2 * ((year % 100) // 4) - h - year % 4) % 7 AS l FROM western
), western3 AS (
  SELECT year, h + l - 7 * ((year % 19 + 11 * h + 22 * l) // 451) + 114 AS n FROM western2
),
-- Meeus, Julian calendar
eastern AS (SELECT year, (19 * (year % 19) + 15) % 30 AS d FROM years),
eastern2 AS (SELECT year, d + (2 * (year % 4) + 4 * (year % 7) - d + 34) % 7 + 114 AS n FROM eastern),
eastern3 AS (SELECT year, make_date(year, CAST(n // 31 AS INTEGER), CAST(n % 31 + 1 AS INTEGER)) AS julian FROM eastern2)
SELECT year, make_date(year, CAST(n // 31 AS INTEGER), CAST(n % 31 + 1 AS INTEGER)) AS western,
       julian + CAST(year // 100 - year // 400 - 2 AS INTEGER) AS orthodox, julian
FROM western3 JOIN eastern3 USING (year)""")
def c15_easter(spark, d):
    yrs = T(spark, d).orders.select(F.year("o_orderdate").alias("year")).distinct()
    return yrs.select("year", cal.easter("year", 3).alias("western"), cal.easter("year", 2).alias("orthodox"),
                      cal.easter("year", 1).alias("julian"))


@job("c16_dst_audit", """
WITH w AS (SELECT o_orderkey, o_orderdate + INTERVAL 150 MINUTE AS wall FROM orders),
i AS (SELECT *, timezone('America/New_York', wall) AS inst FROM w)
SELECT o_orderkey, wall, timezone('America/New_York', inst) <> wall AS imaginary,
       (timezone('America/New_York', inst - INTERVAL 1 HOUR) = wall
        OR timezone('America/New_York', inst + INTERVAL 1 HOUR) = wall) AS ambiguous,
       timezone('America/New_York', inst) AS resolved
FROM i""")
def c16_dst_audit(spark, d):
    o = T(spark, d).orders
    wall = F.timestamp_add("MINUTE", F.lit(150), "o_orderdate")  # 02:30 wall time
    a = cal.dst_audit(wall, "America/New_York")
    return o.select("o_orderkey", wall.alias("wall"), a["imaginary"].alias("imaginary"),
                    a["ambiguous"].alias("ambiguous"), a["resolved"].alias("resolved"))


@job("c17_zone_convert", """
SELECT o_orderkey, timezone('Asia/Kolkata', timezone(CASE WHEN starts_with(o_orderpriority, '1')
                                                      THEN 'Europe/Berlin' ELSE 'UTC' END, o_orderdate)) AS ist
FROM orders""")
def c17_zone_convert(spark, d):
    o = T(spark, d).orders
    zone = F.when(F.col("o_orderpriority").startswith("1"), F.lit("Europe/Berlin"))
    return o.select("o_orderkey", cal.zone_convert("o_orderdate", "Asia/Kolkata", zone, "UTC").alias("ist"))


@job("c18_date_normalise", """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                               WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                                               ELSE strftime(o_orderdate, '%d %b %Y') END AS txt FROM orders)
SELECT o_orderkey, txt, COALESCE(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%d/%m/%Y'),
                                 try_strptime(txt, '%d %b %Y')) AS parsed FROM t""")
def c18_date_normalise(spark, d):
    o = T(spark, d).orders
    # mixed-format text derived from the order dates (format picked per row)
    txt = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")) \
           .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")) \
           .otherwise(F.date_format("o_orderdate", "dd MMM yyyy"))
    src = o.select("o_orderkey", txt.alias("txt"))
    ok, bad = cal.normalise_dates(src, "txt", "parsed", dayfirst=True)
    return ok.unionByName(bad)


# ================================================================== E* scalar functions

@job("e7_math", f"""
SELECT event_id, {S6('SQRT(value)')} AS sqrt_v, {S6('CASE WHEN value > 0 THEN LN(value) END')} AS log_v, {S6('EXP(value / 100)')} AS exp_v,
       CEIL(value) AS ceil_v, FLOOR(value) AS floor_v, LEAST(GREATEST(value, 10), 100) AS clamp_v,
       FLOOR(value + 0.5) AS round_v, {S6('SIN(value) + COS(value) + TAN(value / 1000)')} AS trig,
       {S6('ATAN2(value, user_id + 1)')} AS atan2_v, {S6('SQRT(value * value + user_id * user_id)')} AS hypot_v,
       {S6('POWER(value, 0.5)')} AS pow_v, value / NULLIF(user_id % 3, 0) AS div_v,
       CAST(user_id % 7 AS BIGINT) AS mod_v
FROM events""")
def e7_math(spark, d):
    e = T(spark, d).events
    v, u = F.col("value"), F.col("user_id")
    return e.select("event_id", q6(F.sqrt(v)).alias("sqrt_v"), q6(F.log(v)).alias("log_v"),
                    q6(F.exp(v / 100)).alias("exp_v"), F.ceil(v).cast("double").alias("ceil_v"),
                    F.floor(v).cast("double").alias("floor_v"), E.clamp(v, 10, 100).alias("clamp_v"),
                    E.js_round(v).alias("round_v"),
                    q6(F.sin(v) + F.cos(v) + F.tan(v / 1000)).alias("trig"),
                    q6(F.atan2(v, u + 1)).alias("atan2_v"), q6(E.hypot(v, u)).alias("hypot_v"),
                    q6(E.pow_(v, 0.5)).alias("pow_v"), E.div(v, u % 3).alias("div_v"),
                    E.mod(u, 7).cast("bigint").alias("mod_v"))


@job("e9_distributions", f"""
SELECT event_id,
       {S6('EXP(-0.5 * POWER((value - 100) / 50, 2)) / (50 * SQRT(2 * PI()))')} AS pdf,
       {S6('CASE WHEN value < 0 THEN 0.0 WHEN value >= 500 THEN 1.0 ELSE value / 500 END')} AS ucdf
FROM events""")
def e9_distributions(spark, d):
    e = T(spark, d).events
    return e.select("event_id", q6(E.density_normal("value", 100.0, 50.0)).alias("pdf"),
                    q6(E.cumulative_uniform("value", 0.0, 500.0)).alias("ucdf"))


def _d(v) -> str:
    """A double literal for DuckDB (plain decimals there are DECIMAL)."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def _horner(coefs, x: str) -> str:
    out = _d(coefs[0])
    for k in coefs[1:]:
        out = f"(({out}) * ({x}) + {_d(k)})"
    return out


def _sql_erf(z: str) -> str:
    a = f"ABS({z})"
    t = f"({_d(1)} / ({_d(1)} + {_d(E.ERF_P)} * {a}))"
    return f"(SIGN({z}) * ({_d(1)} - {t} * {_horner(tuple(reversed(E.ERF_A)), t)} * EXP(-{a} * {a})))"


def _sql_cdf(x: str, m: float, sd: float) -> str:
    return f"({_d(0.5)} * ({_d(1)} + {_sql_erf(f'(({x}) - {_d(m)}) / ({_d(sd)} * {_d(math.sqrt(2.0))})')}))"


def _sql_qnorm(p: str, m: float, sd: float) -> str:
    q = f"SQRT({_d(-2)} * LN({p}))"
    low = f"({_horner(E.ACKLAM_C, q)} / ({_horner(E.ACKLAM_D, q)} * {q} + {_d(1)}))"
    qc = f"({p} - {_d(0.5)})"
    r = f"({qc} * {qc})"
    mid = f"({_horner(E.ACKLAM_A, r)} * {qc} / ({_horner(E.ACKLAM_B, r)} * {r} + {_d(1)}))"
    qh = f"SQRT({_d(-2)} * LN({_d(1)} - {p}))"
    high = f"(-{_horner(E.ACKLAM_C, qh)} / ({_horner(E.ACKLAM_D, qh)} * {qh} + {_d(1)}))"
    z = (f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN {p} < {_d(0.02425)} THEN {low} "
         f"WHEN {p} > {_d(1)} - {_d(0.02425)} THEN {high} ELSE {mid} END)")
    return f"({_d(m)} + {_d(sd)} * {z})"


_CDF = _sql_cdf("value", 100.0, 50.0)
_LN = f"((LN(value) - {_d(0)}) / {_d(1)})"
E9_SQL = f"""
WITH c AS (SELECT event_id, value, {_CDF} AS p FROM events)
SELECT event_id, {S6('p')} AS cdf, {S6(_sql_qnorm('p', 100.0, 50.0))} AS roundtrip,
       {S6(f"CASE WHEN value <= 0 THEN {_d(0)} ELSE {_sql_cdf('LN(value)', 0.0, 1.0)} END")} AS lncdf,
       {S6(f"CASE WHEN value <= 0 THEN {_d(0)} ELSE EXP({_d(-0.5)} * {_LN} * {_LN}) / ({_d(1)} * {_d(math.sqrt(2 * math.pi))} * value) END")} AS lnpdf,
       {S6(f"{_d(0)} + {_d(0.25)} * (value - {_d(0)})")} AS uq
FROM c"""


@job("e9_normal_cdf_quantile", E9_SQL)
def e9_normal_cdf_quantile(spark, d):
    e = T(spark, d).events
    p = E.cumulative_normal("value", 100.0, 50.0)
    return e.select("event_id", q6(p).alias("cdf"), q6(E.quantile_normal(p, 100.0, 50.0)).alias("roundtrip"),
                    q6(E.cumulative_log_normal("value")).alias("lncdf"),
                    q6(E.density_log_normal("value")).alias("lnpdf"),
                    q6(E.quantile_uniform(F.lit(0.25), 0.0, F.col("value"))).alias("uq"))


@job("e10_arrays", """
SELECT vec_id, list_min(embedding) AS mn, list_max(embedding) AS mx, CAST(len(embedding) AS INTEGER) AS n,
       list_position(embedding, embedding[3]) - 1 AS idx3, embedding[len(embedding)] AS last_e,
       embedding[2:4] AS sl, list_reverse(embedding)[1] AS rev0, list_sort(embedding)[1] AS sorted0,
       list_max(embedding) - list_min(embedding) AS span
FROM embeddings""")
def e10_arrays(spark, d):
    em = T(spark, d).embeddings
    a = F.col("embedding")
    ext = E.extent(a)
    return em.select("vec_id", ext[0].alias("mn"), ext[1].alias("mx"), E.length(a).alias("n"),
                     E.indexof(a, a[2]).alias("idx3"), E.peek(a).alias("last_e"),
                     E.slice_(a, 1, 4).alias("sl"), E.reverse(a)[0].alias("rev0"),
                     E.sort(a)[0].alias("sorted0"), E.span(a).alias("span"))


@job("e11_strings", """
SELECT c_custkey, lower(c_name) AS lo, upper(c_name) AS up, rpad(c_mktsegment, 12, '.') AS padded,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS lpadded,
       substr(c_name, 2, 4) AS sub, CASE WHEN length(c_name) > 10 THEN substr(c_name, 1, 9) || '…' ELSE c_name END AS trunc,
       CASE WHEN strpos(c_name, '0') = 0 THEN c_name
            ELSE substr(c_name, 1, strpos(c_name, '0') - 1) || 'o' || substr(c_name, strpos(c_name, '0') + 1) END AS rep1,
       trim('  ' || c_mktsegment || '  ') AS trimmed, to_base64(encode(c_name)) AS b64,
       TRY_CAST(regexp_extract(CAST(c_acctbal AS VARCHAR), '^[+-]?\\d+', 0) AS BIGINT) AS int_part
FROM customer""")
def e11_strings(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", F.lower("c_name").alias("lo"), F.upper("c_name").alias("up"),
                    E.pad("c_mktsegment", 12, ".", "right").alias("padded"),
                    E.pad(F.col("c_nationkey").cast("string"), 3, "0", "left").alias("lpadded"),
                    E.substring("c_name", 1, 5).alias("sub"), E.truncate("c_name", 10).alias("trunc"),
                    E.replace_first("c_name", "0", "o").alias("rep1"),
                    F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit("  "))).alias("trimmed"),
                    E.btoa("c_name").alias("b64"),
                    E.parse_int(F.col("c_acctbal").cast("string")).alias("int_part"))


@job("e11_base64_roundtrip", "SELECT c_custkey, c_name AS back FROM customer")
def e11_base64_roundtrip(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", E.atob(E.btoa("c_name")).alias("back"))


@job("e12_merge", """
SELECT event_id, map_concat(CAST(json(props) AS MAP(VARCHAR, INTEGER)),
                            MAP {'k': CAST(user_id AS INTEGER), 'u': 1}) AS merged FROM events""")
def e12_merge(spark, d):
    e = T(spark, d).events
    props = F.from_json("props", "map<string,int>")
    extra = F.create_map(F.lit("k"), F.col("user_id").cast("int"), F.lit("u"), F.lit(1))
    return e.select("event_id", E.merge(props, extra).alias("merged"))


@job("e13_number_format", """
SELECT o_orderkey, format('{:,.2f}', FLOOR(o_totalprice * 100 + 0.5) / 100) AS money,
       format('{:.1f}', FLOOR(o_totalprice / 1000 * 10 + 0.5) / 10) AS thousands
FROM orders""")
def e13_number_format(spark, d):
    o = T(spark, d).orders
    return o.select("o_orderkey", E.number_format("o_totalprice", ",.2f").alias("money"),
                    E.number_format(F.col("o_totalprice") / 1000, ".1f").alias("thousands"))


@job("e14_regex", """
SELECT page_id, regexp_matches(url, '^https://') AS secure,
       length(html) - length(replace(html, '<p', '')) AS p_chars,
       regexp_replace(url, '\\?.*$', '') AS clean_url
FROM pages""")
def e14_regex(spark, d):
    p = T(spark, d).pages
    return p.select("page_id", E.test("url", "^https://").alias("secure"),
                    (E.regexp_count("html", "<p") * 2).cast("bigint").alias("p_chars"),
                    E.regexp_replace("url", "\\?.*$", "").alias("clean_url"))


@job("e5_coercion", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
       CASE WHEN value IS NULL THEN NULL WHEN lower(CAST(value AS VARCHAR)) IN ('false', '0', '0.0') THEN false
            ELSE true END AS k_bool, CAST(user_id AS VARCHAR) AS user_str FROM events""")
def e5_coercion(spark, d):
    e = T(spark, d).events
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", E.to_number(k).alias("k_num"), E.to_boolean("value").alias("k_bool"),
                    E.to_string("user_id").alias("user_str"))


@job("e4_type_tests", """
SELECT event_id, value IS NOT NULL AND NOT isnan(value) AS valid, isnan(value) AS nan,
       isfinite(value) AS finite, props IS NOT NULL AS defined FROM events""")
def e4_type_tests(spark, d):
    e = T(spark, d).events
    return e.select("event_id", E.is_valid("value").alias("valid"), E.is_nan("value").alias("nan"),
                    E.is_finite("value").alias("finite"), E.is_defined("props").alias("defined"))


@job("e16_tree_path", """
WITH RECURSIVE edges AS (
  SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS parent FROM nation
  UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region),
walk(node, ancestor, depth) AS (
  SELECT node, node, 0 FROM edges
  UNION ALL SELECT w.node, e.parent, w.depth + 1 FROM walk w JOIN edges e ON e.node = w.ancestor)
SELECT node, ancestor, depth FROM walk""")
def e16_tree_path(spark, d):
    from ..operators.hierarchy import ancestors
    t = T(spark, d)
    edges = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("node"),
                            F.concat(F.lit("r"), "n_regionkey").alias("parent")) \
        .unionByName(t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("node"),
                                     F.lit("world").alias("parent")))
    return ancestors(edges)


# ================================================================== G* text profile

@job("g1_noise_scores")
def g1_noise_scores(spark, d):
    return G.noise_scores(T(spark, d).documents)


@job("g5_noise_report")
def g5_noise_report(spark, d):
    r = G.noise_report(T(spark, d).documents)
    # a mean over documents: reported to 6 decimals (summation order differs by engine)
    return r.withColumn("mean_mess", q6("mean_mess"))


@job("g6_letter_profile", """
WITH l AS (SELECT lang, UNNEST(string_split(regexp_replace(lower(text), '[^\\p{L}]', '', 'g'), '')) AS letter
           FROM documents),
c AS (SELECT lang, letter, COUNT(*) AS n FROM l WHERE letter <> '' GROUP BY 1, 2)
SELECT lang, letter, n, CAST(ROW_NUMBER() OVER (PARTITION BY lang ORDER BY n DESC, letter) AS INTEGER) AS rank FROM c""")
def g6_letter_profile(spark, d):
    return G.letter_profile(T(spark, d).documents)


@job("g7_language_coherence")
def g7_language_coherence(spark, d):
    return G.coherence_accuracy(T(spark, d).documents)


@job("g8_utf8_audit", """
-- a third of the texts ends in half a character
SELECT source, COUNT(*) AS rows, COUNT(*) FILTER (WHERE doc_id % 3 <> 1) AS valid,
       COUNT(*) FILTER (WHERE doc_id % 3 = 1) AS repaired, CAST(0 AS BIGINT) AS rejected
FROM documents GROUP BY 1""")
def g8_utf8_audit(spark, d):
    docs = T(spark, d).documents
    raw = F.encode("text", "UTF-8")
    broken = F.when(F.col("doc_id") % 3 == 1, F.concat(raw, F.unhex(F.lit("C3")))).otherwise(raw)
    return G.utf8_audit(docs.withColumn("raw", broken), "raw", "source")


# ================================================================== S* sinks (write, then read back)

def _fact(spark, d):
    from ..sources.mart import star
    from .fact import build_fact
    return build_fact(star(spark, d))


@job("s3_parquet_roundtrip", W("""
WITH f AS (SELECT strftime(o.order_date, '%Y-%m') AS year_month, oi.line_total
           FROM star_order_items oi JOIN star_orders o USING (order_id) WHERE o.status = 'delivered')
SELECT year_month, COUNT(*) AS n, CAST(SUM(line_total) AS DOUBLE) AS revenue FROM f
GROUP BY 1"""))
def s3_parquet_roundtrip(spark, d):
    from ..sources.io import scratch_path, write_parquet
    path = scratch_path(spark, "fact_sales")
    write_parquet(_fact(spark, d), path)
    back = spark.read.parquet(path)
    return back.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum("line_total").cast("double").alias("revenue"))


@job("s4_kpi_json_roundtrip", KPI_SQL)
def s4_kpi_json_roundtrip(spark, d):
    from ..sources.io import scratch_path, write_json
    from ..sources.mart import star
    from .kpis import headline_kpis
    path = scratch_path(spark, "kpis")
    write_json(headline_kpis(star(spark, d)).coalesce(1), path)
    return spark.read.json(path)


@job("s5_csv_roundtrip", W("""
SELECT strftime(o.order_date, '%Y-%m') AS year_month, COUNT(*) AS n
FROM star_order_items oi JOIN star_orders o USING (order_id) WHERE o.status = 'delivered' GROUP BY 1"""))
def s5_csv_roundtrip(spark, d):
    from ..sources.io import read_csv, scratch_path, write_csv
    path = scratch_path(spark, "filtered")
    fact = _fact(spark, d)
    write_csv(fact.select("order_id", "seller_id", "line_total", "year_month"), path)
    st = "order_id bigint, seller_id bigint, line_total decimal(18,2), year_month string"
    back = read_csv(spark, path, spark.createDataFrame([], st).schema)
    return back.groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))


@job("s8_content_fingerprint")
def s8_content_fingerprint(spark, d):
    from ..sources.io import content_fingerprint
    return content_fingerprint(T(spark, d).orders)


@job("s9_sanitize", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((microsecond(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS ts,
       CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE value END AS value FROM events""")
def s9_sanitize(spark, d):
    from ..sources.io import sanitize
    return sanitize(T(spark, d).events.select("event_id", "ts", "value"))


# ================================================================== remaining inventory items

@job("s11_row_limit_guard", W("""
SELECT strftime(o.order_date, '%Y-%m') AS year_month,
       CASE WHEN c.is_rural THEN 'Rural' WHEN NOT c.is_rural THEN 'Urban' END AS seg,
       CAST(SUM(oi.line_total) AS DOUBLE) AS line_total
FROM star_order_items oi JOIN star_orders o USING (order_id)
LEFT JOIN star_customers c USING (customer_id) WHERE o.status = 'delivered' GROUP BY 1, 2"""))
def s11_row_limit_guard(spark, d):
    from ..sources.io import limit_rows
    from .kpis import monthly_segment_revenue
    # the chart path: aggregate first, then refuse anything above the inline limit
    return limit_rows(monthly_segment_revenue(_fact(spark, d)), 5000)


@job("t20_keyword_agg", f"""
SELECT l_returnflag, COUNT(*) AS n, {S6('AVG(l_quantity)')} AS mean_qty, MAX(l_discount) AS max_disc
FROM lineitem GROUP BY 1""")
def t20_keyword_agg(spark, d):
    from ..operators.encoding import agg
    out = agg(T(spark, d).lineitem, ["l_returnflag"], n=("count",), mean_qty=("mean", "l_quantity"),
              max_disc=("max", "l_discount"))
    return out.select("l_returnflag", "n", q6("mean_qty").alias("mean_qty"), "max_disc")


@job("t22_boxplot_outliers", """
WITH q AS (SELECT event_type, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3
           FROM events GROUP BY 1)
SELECT e.event_id, e.event_type, e.value FROM events e JOIN q USING (event_type)
WHERE e.value < q1 - 1.5 * (q3 - q1) OR e.value > q3 + 1.5 * (q3 - q1)""")
def t22_boxplot_outliers(spark, d):
    from ..operators.stats import boxplot_outliers
    e = T(spark, d).events.select("event_id", "event_type", "value")
    return boxplot_outliers(e, "value", ["event_type"]).select("event_id", "event_type", "value")


@job("a6_product", f"""
SELECT l_orderkey, {R('PRODUCT(1 - l_discount)', 14)} AS keep_factor FROM lineitem GROUP BY 1""")
def a6_product(spark, d):
    li = T(spark, d).lineitem.withColumn("keep", 1 - F.col("l_discount"))
    a = tf.aggregate(li, {"keep_factor": ("product", "keep")}, ["l_orderkey"])
    # a product of 2-decimal factors has at most 14 decimals (orders hold at most 7
    # lines): reported at that precision no rounding tie can occur
    return a.select("l_orderkey", round_half_up("keep_factor", 14).alias("keep_factor"))


@job("a15_values", """
SELECT l_orderkey, list_sort(list(l_linenumber)) AS lines FROM lineitem GROUP BY 1""")
def a15_values(spark, d):
    li = T(spark, d).lineitem.select("l_orderkey", "l_linenumber")
    # one list per order: bounded by the lines of an order
    a = tf.aggregate(li, {"vals": ("values", "l_linenumber")}, ["l_orderkey"])
    return a.select("l_orderkey", F.array_sort(F.transform("vals", lambda s: s["l_linenumber"])).alias("lines"))


@job("e3_e6_e2_constants_branch_fields", f"""
SELECT event_id, {S6('value * PI()')} AS circ, {S6('EXP(1) * value')} AS e_scaled,
       CASE WHEN value > 100 THEN 'big' ELSE 'small' END AS size,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def e3_e6_e2(spark, d):
    e = T(spark, d).events.withColumn("p", F.from_json("props", "struct<k:int>"))
    return e.select("event_id", q6(F.col("value") * E.const("PI")).alias("circ"),
                    q6(E.const("E") * F.col("value")).alias("e_scaled"),
                    E.if_(F.col("value") > 100, F.lit("big"), F.lit("small")).alias("size"),
                    E.field("datum.p.k").alias("k"))


@job("e8_random")
def e8_random(spark, d):
    e = T(spark, d).events.select("event_id")
    return e.select("event_id", E.random(1).alias("u"), E.sample_normal(0.0, 1.0, 2).alias("z"),
                    E.sample_log_normal(0.0, 1.0, 3).alias("ln"), E.sample_uniform(5.0, 10.0, 4).alias("un"))


@job("e10_array_more", """
SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CAST(label + x > label AS VARCHAR)), '|') AS joined,
       CAST(embedding[1] AS DOUBLE) + 0.5 * (CAST(embedding[len(embedding)] AS DOUBLE) - CAST(embedding[1] AS DOUBLE)) AS lerp_half,
       embedding[1] BETWEEN LEAST(embedding[2], embedding[3]) AND GREATEST(embedding[2], embedding[3]) AS inrange,
       CAST(len(range(0, label + 3, 2)) AS INTEGER) AS seq_len
FROM embeddings""")
def e10_array_more(spark, d):
    em = T(spark, d).embeddings
    a = F.col("embedding")
    labels = F.transform(a, lambda x: (F.col("label") + x > F.col("label")).cast("string"))
    return em.select("vec_id", E.join(labels, "|").alias("joined"),
                     E.lerp(a.cast("array<double>"), 0.5).alias("lerp_half"),
                     E.inrange(a[0], F.array(a[1], a[2])).alias("inrange"),
                     F.size(E.sequence(F.lit(0), F.col("label") + 3, F.lit(2))).alias("seq_len"))


@job("c7_timezone_offset", """
SELECT o_orderkey, CAST((epoch(o_orderdate) - epoch(timezone('America/New_York', o_orderdate))) / -60 AS INTEGER) AS ny_offset,
       epoch_ms(o_orderdate) AS time FROM orders""")
def c7_timezone_offset(spark, d):
    o = T(spark, d).orders.select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", tu.timezone_offset("o_orderdate", "America/New_York").alias("ny_offset"),
                    tu.time_ms("o_orderdate").alias("time"))


@job("e16_tree_path_pairs", """
WITH pairs AS (SELECT 'n' || a.n_nationkey AS src, 'n' || b.n_nationkey AS dst
               FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 1) % 25)
SELECT src, dst, CASE WHEN na.n_regionkey = nb.n_regionkey THEN [src, 'r' || na.n_regionkey, dst]
                      ELSE [src, 'r' || na.n_regionkey, 'world', 'r' || nb.n_regionkey, dst] END AS path
FROM pairs JOIN nation na ON src = 'n' || na.n_nationkey JOIN nation nb ON dst = 'n' || nb.n_nationkey""")
def e16_tree_path_pairs(spark, d):
    from ..operators.hierarchy import tree_path
    t = T(spark, d)
    edges = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("node"),
                            F.concat(F.lit("r"), "n_regionkey").alias("parent")) \
        .unionByName(t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("node"),
                                     F.lit("world").alias("parent")))
    pairs = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("src"),
                            F.concat(F.lit("n"), ((F.col("n_nationkey") + 1) % 25).cast("string")).alias("dst"))
    return tree_path(edges, pairs)


@job("x5_x6_set_ops", """
SELECT 'intersect' AS op, COUNT(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
                                              INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL
SELECT 'except', COUNT(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
                                EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL
SELECT 'union_distinct', COUNT(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
                                        UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def x5_x6_set_ops(spark, d):
    o = T(spark, d).orders
    f = o.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    op = o.filter(F.col("o_orderstatus") == "O").select("o_custkey")
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
    return n(f.intersect(op), "intersect").unionByName(n(f.subtract(op), "except")) \
        .unionByName(n(f.union(op).distinct(), "union_distinct"))


@job("u2_transform_registry", f"""
SELECT event_type, COUNT(*) AS n, {S6('SUM(value)')} AS total FROM events WHERE value > 1 GROUP BY 1""")
def u2_transform_registry(spark, d):
    reg = tf.TransformRegistry()
    reg.register("default", lambda x: x)
    reg.register("cleaned_totals", lambda x: x.filter(F.col("value") > 1).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), q6(F.sum("value")).alias("total")))
    reg.enable("cleaned_totals")
    return reg.apply(T(spark, d).events)


G_ACC_SQL = f"""
SELECT doc_id,
  CASE WHEN regexp_matches(text, '[^\\x00-\\x7F]') AND length(text) >= 8
            AND (length(text) - length(regexp_replace(text, '{G.ACCENTED}', '', 'g'))) * 1.0 / length(text) >= 0.35
       THEN CAST(length(text) - length(regexp_replace(text, '{G.ACCENTED}', '', 'g')) AS DOUBLE) / length(text)
       ELSE 0.0 END AS accent_noise,
  CASE WHEN regexp_matches(text, '[^\\x00-\\x7F]') AND length(text) >= 8
       THEN CAST(length(text) - length(regexp_replace(text, '{G.ARABIC_ISOLATED}', '', 'g')) AS DOUBLE) / length(text)
       ELSE 0.0 END AS isolated_form_noise
FROM documents"""


@job("g2_g12_accent_isolated", G_ACC_SQL)
def g2_g12_accent_isolated(spark, d):
    t = F.col("text")
    return T(spark, d).documents.select("doc_id", G.accent_noise(t).alias("accent_noise"),
                                        G.isolated_form_noise(t).alias("isolated_form_noise"))


ORACLE["g7_language_coherence"] = """
WITH l AS (SELECT doc_id, lang, UNNEST(string_split(regexp_replace(lower(text), '[^\\p{L}]', '', 'g'), '')) AS letter
           FROM documents),
l2 AS (SELECT * FROM l WHERE letter <> ''),
prof AS (SELECT lang AS profile_lang, letter,
                ROW_NUMBER() OVER (PARTITION BY lang ORDER BY COUNT(*) DESC, letter) AS p_rank
         FROM l2 GROUP BY lang, letter),
per_doc AS (SELECT doc_id, letter, COUNT(*) AS n FROM l2 GROUP BY 1, 2),
tot AS (SELECT doc_id, SUM(n) AS n_letters FROM per_doc GROUP BY 1),
ranked AS (SELECT doc_id, letter, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY n DESC, letter) AS d_rank
           FROM per_doc),
placed AS (SELECT r.* FROM ranked r JOIN tot t USING (doc_id) WHERE n_letters > 32),
n_top AS (SELECT doc_id, COUNT(*) AS n_top FROM placed GROUP BY 1),
score AS (SELECT r.doc_id, pr.profile_lang AS lang,
                 CAST(SUM(CASE WHEN ABS(d_rank - p_rank) <= 4 THEN 1 ELSE 0 END) AS DOUBLE) / n.n_top AS score
          FROM placed r JOIN prof pr USING (letter) JOIN n_top n USING (doc_id)
          GROUP BY r.doc_id, pr.profile_lang, n.n_top),
best AS (SELECT doc_id, lang AS predicted,
                ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS rk
         FROM score WHERE score >= 0.1)
SELECT d.lang, COUNT(*) AS docs, AVG(CAST(d.lang = b.predicted AS DOUBLE)) AS accuracy
FROM documents d JOIN best b ON d.doc_id = b.doc_id AND b.rk = 1 GROUP BY 1""".strip()


def _sql_in(chars: str) -> str:
    return "(" + ", ".join("chr(%d)" % ord(c) for c in chars) + ")"


_SCRIPT_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(ch, '\\p{{{sc}}}') THEN '{sc}'" for sc in G.SCRIPTS) + " END"
_CJK = "('Han', 'Hiragana', 'Katakana')"

G_CHAR_SQL = f"""
WITH d AS (SELECT doc_id, length(text) AS n, regexp_matches(text, '[^\\x00-\\x7F]') AS non_ascii,
                  regexp_matches(text, '\\p{{L}}') AND regexp_matches(regexp_replace(text, '[^\\p{{L}}]', '', 'g'), '[^\\p{{Latin}}]') AS non_latin
           FROM documents),
c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(1, length(text) + 1)) AS pos FROM documents),
f AS (SELECT doc_id, pos, ch,
        regexp_matches(ch, '\\p{{P}}') AND ch NOT IN {_sql_in(G.SAFE_ASCII)} AS is_punct,
        regexp_matches(ch, '[\\p{{S}}\\p{{No}}\\p{{Nl}}]') AND ch NOT IN {_sql_in(G.SAFE_ASCII)}
          AND NOT (unicode(ch) BETWEEN 127744 AND 129791) AS is_sym,
        unicode(ch) BETWEEN 192 AND 591 AND strip_accents(ch) <> ch AS acc,
        regexp_matches(ch, '[\\p{{Cc}}\\p{{Cf}}\\p{{Co}}\\p{{Zl}}\\p{{Zp}}]')
          AND ch NOT IN (chr(32), chr(9), chr(10), chr(11), chr(12), chr(13), chr(26), chr(65279)) AS unprintable,
        unicode(ch) BETWEEN 65136 AND 65279 OR unicode(ch) BETWEEN 64336 AND 65023 AS isolated,
        {_SCRIPT_CASE} AS script
      FROM c),
p AS (SELECT *, lead(ch) OVER w AS nxt, lead(acc) OVER w AS nxt_acc, lead(script) OVER w AS nxt_script
      FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
agg AS (SELECT doc_id,
          SUM(CASE WHEN is_punct AND (nxt IS NULL OR nxt <> ch) THEN 1 ELSE 0 END) AS punct,
          SUM(CASE WHEN is_sym AND (nxt IS NULL OR nxt <> ch) THEN 1 ELSE 0 END) AS sym,
          SUM(CASE WHEN acc THEN 1 ELSE 0 END) AS acc,
          SUM(CASE WHEN unprintable THEN 1 ELSE 0 END) AS unp,
          SUM(CASE WHEN isolated THEN 1 ELSE 0 END) AS iso,
          SUM(CASE WHEN acc AND nxt_acc AND strip_accents(ch) BETWEEN 'A' AND 'Z' AND strip_accents(nxt) BETWEEN 'A' AND 'Z'
                   AND length(strip_accents(ch)) = 1 AND length(strip_accents(nxt)) = 1 THEN 1 ELSE 0 END)
          + SUM(CASE WHEN acc AND nxt_acc AND strip_accents(ch) = strip_accents(nxt) THEN 1 ELSE 0 END) AS dup,
          SUM(CASE WHEN script IS NOT NULL AND nxt_script IS NOT NULL AND script <> nxt_script
                    AND NOT (script IN {_CJK} AND nxt_script IN {_CJK}) THEN 1 ELSE 0 END) AS mix
        FROM p GROUP BY 1)
SELECT d.doc_id,
  CASE WHEN CAST(COALESCE(punct, 0) + 2 * COALESCE(sym, 0) AS DOUBLE) / NULLIF(d.n, 0) >= 0.3
       THEN CAST(COALESCE(punct, 0) + 2 * COALESCE(sym, 0) AS DOUBLE) / NULLIF(d.n, 0) ELSE 0.0 END AS symbol_noise,
  CASE WHEN d.non_ascii AND d.n >= 8 AND CAST(COALESCE(acc, 0) AS DOUBLE) / NULLIF(d.n, 0) >= 0.35
       THEN CAST(acc AS DOUBLE) / NULLIF(d.n, 0) ELSE 0.0 END AS accent_noise,
  COALESCE(CAST(8 * COALESCE(unp, 0) AS DOUBLE) / NULLIF(d.n, 0), 0.0) AS unprintable_noise,
  CASE WHEN d.non_ascii THEN CAST(2 * COALESCE(dup, 0) AS DOUBLE) / NULLIF(d.n, 0) ELSE 0.0 END AS duplicate_accent_noise,
  CASE WHEN d.n > 13 AND d.non_latin THEN CAST(2 * COALESCE(mix, 0) AS DOUBLE) / NULLIF(d.n, 0) ELSE 0.0 END AS script_mix_noise,
  CASE WHEN d.non_ascii AND d.n >= 8 THEN CAST(COALESCE(iso, 0) AS DOUBLE) / NULLIF(d.n, 0) ELSE 0.0 END AS isolated_form_noise,
  CAST(COALESCE(punct, 0) AS BIGINT) AS n_punct_runs, CAST(COALESCE(sym, 0) AS BIGINT) AS n_symbol_runs,
  CAST(COALESCE(acc, 0) AS BIGINT) AS n_accented, CAST(COALESCE(unp, 0) AS BIGINT) AS n_unprintable,
  CAST(COALESCE(mix, 0) AS BIGINT) AS n_script_pairs
FROM d LEFT JOIN agg USING (doc_id)"""


@job("g1_char_noise", G_CHAR_SQL)
def g1_char_noise(spark, d):
    t = F.col("text")
    names = ["symbol_noise", "accent_noise", "unprintable_noise", "duplicate_accent_noise",
             "script_mix_noise", "isolated_form_noise"]
    # the raw counts behind the thresholds are reported too
    raw = [G._count(t, f"({G.PUNCT})(?!\\1)").cast("bigint").alias("n_punct_runs"),
           G._count(t, f"({G.SYMBOL})(?!\\1)").cast("bigint").alias("n_symbol_runs"),
           G._count_set(t, G.ACCENTED_CHARS).cast("bigint").alias("n_accented"),
           G._count(t, G.UNPRINTABLE).cast("bigint").alias("n_unprintable"),
           G._count(t, G._script_pairs()).cast("bigint").alias("n_script_pairs")]
    return T(spark, d).documents.select("doc_id", *[G.MEASURES[n](t).alias(n) for n in names], *raw)


G4_SQL = """
WITH d AS (SELECT doc_id, length(text) AS n, regexp_matches(text, '[^\\x00-\\x7F]') AS non_ascii FROM documents),
c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(1, length(text) + 1)) AS pos FROM documents),
f AS (SELECT doc_id, pos, ch, regexp_matches(ch, '[\\p{Lu}\\p{Ll}]') AS cased, regexp_matches(ch, '\\p{Lu}') AS up,
             regexp_matches(ch, '^[0-9]$') AS digit FROM c),
k AS (SELECT *, SUM(CASE WHEN cased THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS chunk,
             lead(digit) OVER (PARTITION BY doc_id ORDER BY pos) AS next_digit,
             lag(up) OVER (PARTITION BY doc_id ORDER BY pos) AS prev_up,
             lag(cased) OVER (PARTITION BY doc_id ORDER BY pos) AS prev_cased FROM f),
cased_only AS (SELECT * FROM k WHERE cased),
chunks AS (SELECT doc_id, chunk, COUNT(*) AS len, MAX(unicode(ch)) > 127 AS has_non_ascii,
                  COALESCE(arg_max(next_digit, pos), false) AS cut_by_digit
           FROM cased_only GROUP BY 1, 2),
runs AS (SELECT doc_id, chunk, pos,
                SUM(CASE WHEN prev_cased AND up <> prev_up THEN 0 ELSE 1 END)
                  OVER (PARTITION BY doc_id, chunk ORDER BY pos) AS run
         FROM cased_only),
run_len AS (SELECT doc_id, chunk, run, COUNT(*) AS m FROM runs GROUP BY 1, 2, 3),
flips AS (SELECT r.doc_id, SUM(2 * CAST(FLOOR((r.m - 1) / 2) AS BIGINT)) AS flips
          FROM run_len r JOIN chunks ch USING (doc_id, chunk)
          WHERE ch.len <= 64 AND ch.has_non_ascii AND NOT ch.cut_by_digit GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.non_ascii THEN CAST(COALESCE(f.flips, 0) AS DOUBLE) / d.n ELSE 0.0 END AS case_flip_noise,
       CAST(COALESCE(f.flips, 0) AS BIGINT) AS n_flip_points
FROM d LEFT JOIN flips f USING (doc_id)"""


@job("g4_case_flip", G4_SQL)
def g4_case_flip(spark, d):
    t = F.col("text")
    chunks = F.filter(F.regexp_extract_all(t, F.lit("[\\p{Lu}\\p{Ll}]++(?!\\d)"), 0),
                      lambda w: (F.length(w) <= 64) & w.rlike("[^\\x00-\\x7F]"))
    runs = F.flatten(F.transform(chunks, lambda w: F.regexp_extract_all(
        w, F.lit("(?:\\p{Lu}\\p{Ll})+\\p{Lu}?|(?:\\p{Ll}\\p{Lu})+\\p{Ll}?"), 0)))
    points = F.aggregate(runs, F.lit(0).cast("bigint"),
                         lambda acc, r: acc + 2 * F.floor((F.length(r) - 1) / 2).cast("bigint"))
    return T(spark, d).documents.select("doc_id", G.case_flip_noise(t).alias("case_flip_noise"),
                                        points.alias("n_flip_points"))


G11_SQL = """
WITH w0 AS (SELECT doc_id, unnest(string_split_regex(text, '[\\s\\p{Z}\\p{P}｜+<>]+')) AS w FROM documents),
w1 AS (SELECT doc_id, w, row_number() OVER () AS wid FROM w0),
wc AS (SELECT wid, unnest(string_split(w, '')) AS ch FROM w1),
acc AS (SELECT wid, SUM(CASE WHEN unicode(ch) BETWEEN 192 AND 591 AND strip_accents(ch) <> ch THEN 1 ELSE 0 END) AS acc,
               SUM(CASE WHEN unicode(ch) BETWEEN 4352 AND 4607 OR unicode(ch) BETWEEN 12352 AND 12543
                         OR unicode(ch) BETWEEN 13312 AND 19903 OR unicode(ch) BETWEEN 19968 AND 40959
                         OR unicode(ch) BETWEEN 44032 AND 55215 OR unicode(ch) BETWEEN 63744 AND 64255
                         OR unicode(ch) BETWEEN 131072 AND 195103 THEN 1 ELSE 0 END) AS glyph,
               MAX(CASE WHEN (regexp_matches(ch, '\\p{L}') AND NOT regexp_matches(ch, '[\\p{Latin}\\p{Han}\\p{Hangul}\\p{Hiragana}\\p{Katakana}]'))
                          OR (unicode(ch) BETWEEN 192 AND 591 AND strip_accents(ch) <> ch) THEN 1 ELSE 0 END) AS watch
        FROM wc GROUP BY 1),
m AS (SELECT w1.doc_id, w1.w, COALESCE(a.acc, 0) AS acc, COALESCE(a.glyph, 0) AS glyph, COALESCE(a.watch, 0) AS watch,
             regexp_matches(w1.w, '^[A-Za-z]*$') AS plain,
             length(regexp_replace(w1.w, '[^\\p{L}\\p{S}\\p{No}\\p{Nl}]', '', 'g'))
               - (length(w1.w) - length(regexp_replace(w1.w, '[<>=~|]', '', 'g'))) AS n,
             regexp_matches(regexp_replace(w1.w, '[<>=~|]', '', 'g'), '[\\p{S}\\p{No}\\p{Nl}]') AS sym,
             length(w1.w) - length(regexp_replace(w1.w, '\\p{Lu}', '', 'g')) AS upper,
             regexp_extract(w1.w, '(\\p{L})[^\\p{L}]*$', 1) AS last
      FROM w1 LEFT JOIN acc a USING (wid)),
r AS (SELECT doc_id, n, plain,
             (n >= 4 AND acc * 2 >= n) AS r1,
             (n >= 4 AND acc * 2 < n AND acc > 0 AND last <> '' AND unicode(last) BETWEEN 192 AND 591
              AND strip_accents(last) <> last AND upper(last) = last AND lower(last) <> last AND upper <> n) AS r2,
             glyph, watch, sym, upper FROM m WHERE n > 0),
r3 AS (SELECT *, (n >= 4 AND NOT r1 AND NOT r2 AND glyph = 1) AS r3,
              (n >= 24 AND watch = 1 AND NOT (upper > 0 AND upper * 10 <= n * 3)) AS r4 FROM r),
per AS (SELECT doc_id, COUNT(*) AS words, SUM(n) AS chars,
               SUM(CASE WHEN NOT plain AND (sym OR r1 OR r2 OR r3 OR r4) THEN n ELSE 0 END) AS bad,
               SUM(CASE WHEN plain THEN 0 ELSE CAST(r2 AS INTEGER) + CAST(r3 AS INTEGER) + CAST(r4 AS INTEGER) END) AS fl
        FROM r3 GROUP BY 1)
SELECT d.doc_id,
       CASE WHEN p.doc_id IS NULL OR (p.words <= 10 AND p.fl = 0) THEN 0.0
            ELSE COALESCE(CAST(p.bad AS DOUBLE) / NULLIF(p.chars, 0), 0.0) END AS weird_word_noise
FROM documents d LEFT JOIN per p USING (doc_id)"""


@job("g11_weird_words", G11_SQL)
def g11_weird_words(spark, d):
    docs = T(spark, d).documents
    table = G.weird_word_table(docs)
    return docs.select("doc_id").join(table, "doc_id", "left") \
               .select("doc_id", F.coalesce(F.col("weird_word_noise"), F.lit(0.0)).alias("weird_word_noise"))


def _strip_with(sql: str) -> str:
    return sql.strip()


RARE_CJK_SQL = """
WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents),
han AS (SELECT doc_id, ch FROM c WHERE regexp_matches(ch, '\\p{Han}')),
freq AS (SELECT ch, COUNT(*) AS n FROM han GROUP BY ch),
common AS (SELECT a.ch FROM freq a LEFT JOIN freq b ON b.n > a.n OR (b.n = a.n AND b.ch < a.ch)
           GROUP BY a.ch HAVING COALESCE(SUM(b.n), 0) * 10 < (SELECT COUNT(*) FROM han) * 9),
rc AS (SELECT doc_id, COUNT(*) AS cjk, SUM(CASE WHEN ch IN (SELECT ch FROM common) THEN 0 ELSE 1 END) AS rare
       FROM han GROUP BY 1)
SELECT d.doc_id,
       CASE WHEN regexp_matches(d.text, '[^\\x00-\\x7F]') AND COALESCE(rc.cjk, 0) >= 8
                 AND CAST(rc.rare AS DOUBLE) / rc.cjk > 0.5
            THEN CAST(rc.rare AS DOUBLE) / rc.cjk / 10 ELSE 0.0 END AS rare_cjk_noise
FROM documents d LEFT JOIN rc USING (doc_id)"""

NOISE_SCORES_SQL = f"""
WITH ch AS ({_strip_with(G_CHAR_SQL)}),
cf AS ({_strip_with(G4_SQL)}),
ww AS ({_strip_with(G11_SQL)}),
rc AS ({_strip_with(RARE_CJK_SQL)}),
s AS (SELECT d.doc_id, d.source, d.lang, ch.symbol_noise, ch.accent_noise, ch.unprintable_noise,
             cf.case_flip_noise, ch.duplicate_accent_noise, ch.script_mix_noise, ww.weird_word_noise,
             ch.isolated_form_noise, rc.rare_cjk_noise
      FROM documents d JOIN ch USING (doc_id) JOIN cf USING (doc_id) JOIN ww USING (doc_id) JOIN rc USING (doc_id))
SELECT *, ((((((((((CAST(0.0 AS DOUBLE) + symbol_noise) + accent_noise) + unprintable_noise) + case_flip_noise)
          + duplicate_accent_noise) + script_mix_noise) + weird_word_noise) + isolated_form_noise) + rare_cjk_noise)) AS mess
FROM s"""

ORACLE["g1_noise_scores"] = NOISE_SCORES_SQL.strip()
ORACLE["g5_noise_report"] = f"""
WITH sc AS ({NOISE_SCORES_SQL.strip()})
SELECT source, lang, COUNT(*) AS docs, {S6('AVG(mess)')} AS mean_mess,
       AVG(CAST(mess > 0.2 AS DOUBLE)) * 100 AS noisy_pct
FROM sc GROUP BY 1, 2""".strip()
