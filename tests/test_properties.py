"""Property-based checks (hypothesis) of the column formulas against independent
definitions."""

import datetime as dt
import math
import random

from dateutil.relativedelta import MO, TU, FR, relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.operators.ranking import ntile_from_row_number
from martlet.operators.stats import nice_bins


@settings(max_examples=300, deadline=None)
@given(lo=st.floats(-1e6, 1e6), width=st.floats(1e-3, 1e6), maxbins=st.integers(2, 50))
def test_nice_bins_properties(lo, width, maxbins):
    hi = lo + width
    start, stop, step = nice_bins(lo, hi, maxbins)
    mant = step / 10 ** math.floor(math.log10(step) + 1e-12)
    assert any(abs(mant - m) < 1e-9 for m in (1, 2, 5, 10))
    assert start <= lo + 1e-9 * max(1, abs(lo)) and stop >= hi - 1e-9 * max(1, abs(hi))
    assert math.ceil(width / step - 1e-9) <= maxbins


def _ntile_ref(n, k):
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    out = []
    for b, size in enumerate(sizes, start=1):
        out += [b] * size
    return out


def test_ntile_formula_matches_definition(spark):
    cases = [(n, k) for n in range(1, 60) for k in (1, 2, 3, 4, 5, 7, 10, 64)]
    rows = [(n, k, rn) for n, k in cases for rn in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, k int, rn long")
    got = {}
    for k in sorted({k for _, k in cases}):
        part = df.filter(F.col("k") == k).select("n", "rn", ntile_from_row_number(F.col("rn"), F.col("n"), k).alias("b"))
        for r in part.collect():
            got[(r.n, k, r.rn)] = r.b
    for n, k in cases:
        assert [got[(n, k, rn)] for rn in range(1, n + 1)] == _ntile_ref(n, k)


def _random_ts(rnd):
    base = dt.datetime(1990, 1, 1)
    return base + dt.timedelta(days=rnd.randint(0, 365 * 40), seconds=rnd.randint(0, 86399))


def test_month_diff_matches_relativedelta(spark):
    rnd = random.Random(7)
    pairs = [(_random_ts(rnd), _random_ts(rnd)) for _ in range(400)]
    pairs += [(dt.datetime(2015, 3, 1), dt.datetime(2014, 1, 31)), (dt.datetime(2014, 1, 31), dt.datetime(2015, 3, 1)),
              (dt.datetime(2016, 2, 29), dt.datetime(2015, 2, 28))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    rows = df.select("a", "b", cal.month_diff("a", "b").alias("m")).collect()
    for r in rows:
        rd = relativedelta(r.a, r.b)
        months = rd.years * 12 + rd.months
        ours = r.m.years * 12 + r.m.months
        assert ours == months, (r.a, r.b, r.m, rd)
        secs = rd.days * 86400 + rd.hours * 3600 + rd.minutes * 60 + rd.seconds
        assert abs(r.m.seconds - secs) < 1e-6, (r.a, r.b, r.m, rd)


def test_calendar_shift_matches_relativedelta(spark):
    rnd = random.Random(11)
    specs = [dict(months=1, day=31), dict(years=1, months=-13, weekday=(0, 1)), dict(days=40, hours=30),
             dict(month=2, day=30, weekday=(4, -2)), dict(weeks=3, weekday=(1, 2)), dict(years=-3, day=29, month=2)]
    wd = {0: MO, 1: TU, 4: FR}
    ts = [_random_ts(rnd) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    for spec in specs:
        got = [r.x for r in df.select(cal.calendar_shift("t", **spec).alias("x")).collect()]
        kw = {k: v for k, v in spec.items() if k != "weekday"}
        if "weekday" in spec:
            w, n = spec["weekday"]
            kw["weekday"] = wd[w](n)
        want = [t + relativedelta(**kw) for t in ts]
        assert got == want, spec


def test_recurrence_matches_rrule(spark):
    from dateutil import rrule as R
    start = dt.datetime(2019, 1, 31, 9, 0)
    until = dt.datetime(2022, 12, 31, 23, 0)
    cases = [
        (dict(freq="MONTHLY", bymonthday=[31]), dict(freq=R.MONTHLY, bymonthday=31)),
        (dict(freq="MONTHLY", byweekday=[(4, -1)]), dict(freq=R.MONTHLY, byweekday=R.FR(-1))),
        (dict(freq="MONTHLY", byweekday=[0, 1, 2, 3, 4], bysetpos=[-1]),
         dict(freq=R.MONTHLY, byweekday=(R.MO, R.TU, R.WE, R.TH, R.FR), bysetpos=-1)),
        (dict(freq="YEARLY", bymonth=[2, 8], bymonthday=[29, 1]), dict(freq=R.YEARLY, bymonth=(2, 8), bymonthday=(29, 1))),
        (dict(freq="WEEKLY", interval=2, byweekday=[0, 2]), dict(freq=R.WEEKLY, interval=2, byweekday=(R.MO, R.WE))),
        (dict(freq="DAILY", interval=3), dict(freq=R.DAILY, interval=3)),
        (dict(freq="YEARLY", byeaster=[0, 1]), dict(freq=R.YEARLY, byeaster=(0, 1))),
        (dict(freq="MONTHLY", byweekday=[(0, 2)]), dict(freq=R.MONTHLY, byweekday=R.MO(2))),
        (dict(freq="YEARLY", byyearday=[1, -1]), dict(freq=R.YEARLY, byyearday=(1, -1))),
    ]
    for ours, theirs in cases:
        got = [r.occurrence for r in cal.recurrence(spark, dtstart=start, until=until, **ours)
               .orderBy("occurrence").collect()]
        want = list(R.rrule(dtstart=start, until=until, **theirs))
        assert got == want, ours
    got = [r.occurrence for r in cal.recurrence(spark, "MONTHLY", dt.datetime(2014, 12, 31), count=4)
           .orderBy("occurrence").collect()]
    assert got == list(R.rrule(R.MONTHLY, dtstart=dt.datetime(2014, 12, 31), count=4))


def test_easter_matches_dateutil(spark):
    from dateutil.easter import easter as ref
    years = spark.range(1583, 2401).select(F.col("id").cast("int").alias("y"))
    rows = years.select("y", *[cal.easter("y", m).alias(f"m{m}") for m in (1, 2, 3)]).collect()
    for r in rows:
        assert (r.m1, r.m2, r.m3) == (ref(r.y, 1), ref(r.y, 2), ref(r.y, 3)), r.y


def test_recurrence_time_expansion_matches_rrule(spark):
    from dateutil import rrule as R
    start = dt.datetime(2021, 3, 1, 8, 30)
    until = dt.datetime(2021, 7, 1)
    cases = [
        (dict(freq="WEEKLY", byweekday=[1, 3], byhour=[9, 17], byminute=[0, 30]),
         dict(freq=R.WEEKLY, byweekday=(R.TU, R.TH), byhour=(9, 17), byminute=(0, 30))),
        (dict(freq="MONTHLY", bymonthday=[1, 15], byhour=[6, 18], bysetpos=[-1, 1]),
         dict(freq=R.MONTHLY, bymonthday=(1, 15), byhour=(6, 18), bysetpos=(-1, 1))),
        (dict(freq="DAILY", interval=5, bysecond=[0, 45]), dict(freq=R.DAILY, interval=5, bysecond=(0, 45))),
    ]
    for ours, theirs in cases:
        got = [r.occurrence for r in cal.recurrence(spark, dtstart=start, until=until, **ours)
               .orderBy("occurrence").collect()]
        assert got == list(R.rrule(dtstart=start, until=until, **theirs)), ours


def test_time_parts_and_units_match_python(spark):
    from martlet.functions import timeunits as tu
    rnd = random.Random(3)
    ts = [_random_ts(rnd) for _ in range(300)] + [dt.datetime(2012, 1, 1), dt.datetime(2017, 1, 1),
                                                  dt.datetime(2016, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    rows = df.select("t", tu.date_part("week", "t").alias("week"), tu.date_part("day", "t").alias("day"),
                     tu.date_part("month", "t").alias("month"), tu.date_part("quarter", "t").alias("q"),
                     tu.timeunit("t", "yearweek").alias("yw"), tu.timeunit("t", "yearquarter").alias("yq"),
                     tu.timeunit("t", "monthdatehours").alias("mdh")).collect()
    for r in rows:
        t = r.t
        assert r.week == int(t.strftime("%U"))
        assert r.day == int(t.strftime("%w"))
        assert r.month == t.month - 1 and r.q == (t.month - 1) // 3
        sunday = (t - dt.timedelta(days=int(t.strftime("%w")))).replace(hour=0, minute=0, second=0, microsecond=0)
        assert r.yw == sunday
        assert r.yq == dt.datetime(t.year, 3 * ((t.month - 1) // 3) + 1, 1)
        assert r.mdh == dt.datetime(2012, t.month, t.day, t.hour)


def test_dst_audit_matches_zoneinfo(spark):
    from zoneinfo import ZoneInfo
    tz = ZoneInfo("America/New_York")
    walls = [dt.datetime(y, m, d, h, mi) for y in (2017, 2018) for m, d in ((3, 11), (3, 12), (3, 10), (11, 4), (11, 5))
             for h in (0, 1, 2, 3) for mi in (0, 30)]
    df = spark.createDataFrame([(w,) for w in walls], "w timestamp_ntz")
    rows = df.select("w", cal.dst_audit("w", "America/New_York").alias("a")).collect()
    for r in rows:
        w = r.w
        a = w.replace(tzinfo=tz, fold=0)
        b = w.replace(tzinfo=tz, fold=1)
        imaginary = a.utcoffset() != b.utcoffset() and a.astimezone(dt.timezone.utc).astimezone(tz).replace(tzinfo=None) != w
        ambiguous = a.utcoffset() != b.utcoffset() and not imaginary
        assert r.a.imaginary == imaginary, w
        assert r.a.ambiguous == ambiguous, w
