"""Recurrence rules, as-of and between joins against dateutil and brute force."""

import datetime as dt
import random
import signal
from bisect import bisect_left, bisect_right

import pytest
from dateutil import rrule as R
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.operators import joins as J

FREQ = {"YEARLY": R.YEARLY, "MONTHLY": R.MONTHLY, "WEEKLY": R.WEEKLY, "DAILY": R.DAILY, "HOURLY": R.HOURLY, "MINUTELY": R.MINUTELY, "SECONDLY": R.SECONDLY}
DAYS = (R.MO, R.TU, R.WE, R.TH, R.FR, R.SA, R.SU)


def theirs(freq, dtstart, byweekday=None, wkst=0, within=None, until=None, **kw):
    if byweekday:
        kw["byweekday"] = [DAYS[w[0]](w[1]) if isinstance(w, tuple) else DAYS[w] for w in byweekday]
    rule = R.rrule(FREQ[freq], dtstart=dtstart, until=until, wkst=wkst, **kw)
    return rule.between(*within, inc=True) if within else list(rule)


def ours(spark, freq, dtstart, **kw):
    return [r.occurrence for r in cal.recurrence(spark, freq, dtstart, **kw).orderBy("occurrence").collect()]


@pytest.mark.parametrize(("freq", "start", "until", "rule"), [
    ("MONTHLY", dt.datetime(2024, 1, 10), dt.datetime(2024, 6, 1), dict(byweekday=[(0, 1)])),
    ("MONTHLY", dt.datetime(2024, 1, 10), dt.datetime(2024, 6, 12), dict(byweekday=[(4, -1)])),
    ("MONTHLY", dt.datetime(2024, 1, 10), dt.datetime(2024, 6, 12), dict(byweekday=[0, 1, 2, 3, 4], bysetpos=[-1])),
    ("YEARLY", dt.datetime(2023, 5, 3), dt.datetime(2026, 1, 1), dict(byweekday=[(1, 2)])),
])
def test_first_and_last_period_are_whole(spark, freq, start, until, rule):
    assert ours(spark, freq, start, until=until, **rule) == theirs(freq, start, until=until, **rule)


def _too_long(*_):
    raise ValueError("no end in sight")


def random_rule(rnd, freq):
    kw = {"interval": rnd.choice([1, 1, 2, 3, 5, 7, 11])}
    def some(values, k=3):
        return sorted(rnd.sample(values, rnd.randint(1, k)))
    if rnd.random() < 0.3:
        kw["bymonth"] = some(range(1, 13), 6)
    pick = rnd.choice(["", "monthday", "weekday", "nth", "yearday", "weekno", "easter"])
    if pick == "monthday":
        kw["bymonthday"] = some([*range(1, 32), -1, -2, -31], 5)
    elif pick == "weekday":
        kw["byweekday"] = some(range(7), 4)
    elif pick == "nth":
        kw["byweekday"] = [(rnd.randrange(7), rnd.choice([1, 2, 3, 5, -1, -2, -5])) for _ in range(2)]
    elif pick == "yearday" and freq == "YEARLY":
        kw["byyearday"] = some([1, 60, 100, 366, -1, -366], 4)
    elif pick == "weekno" and freq == "YEARLY":
        kw["byweekno"] = some([1, 2, 20, 52, 53, -1], 3)
    elif pick == "easter" and freq == "YEARLY":
        kw["byeaster"] = some([-2, 0, 1, 39], 2)
    if rnd.random() < 0.4:
        kw["byhour"] = some(range(24), 4)
    if rnd.random() < 0.3:
        kw["byminute"] = some(range(60), 5)
    if rnd.random() < 0.3:
        kw["bysecond"] = some(range(60), 5)
    if rnd.random() < 0.3 and len(kw) > 1:
        kw["bysetpos"] = some([1, 2, 3, -1, -2], 2)
    kw["wkst"] = rnd.choice([0, 0, 6, 3])
    return kw


@pytest.mark.parametrize("freq", list(FREQ))
def test_random_rules_equal_dateutil(spark, freq):
    rnd = random.Random(f"rule {freq}")
    span = {"YEARLY": 4000, "MONTHLY": 1200, "WEEKLY": 400, "DAILY": 400, "HOURLY": 60, "MINUTELY": 12, "SECONDLY": 1}[freq]
    done = 0
    while done < 8:
        kw = random_rule(rnd, freq)
        start = dt.datetime(2019, 1, 1) + dt.timedelta(seconds=rnd.randrange(4 * 365 * 86400))
        until = start + dt.timedelta(days=rnd.randint(span // 2, span), seconds=rnd.randrange(86400))
        signal.signal(signal.SIGALRM, _too_long)
        signal.alarm(2)
        try:
            want = theirs(freq, start, until=until, **kw)
        except ValueError:
            continue  # a rule that can never stand, or none that dateutil finds before the year 9999
        finally:
            signal.alarm(0)
        assert ours(spark, freq, start, until=until, **kw) == want, (freq, start, until, kw)
        done += 1


def test_endless_rules_and_counts(spark):
    start = dt.datetime(2001, 3, 31, 9, 30)
    lo, hi = dt.datetime(2150, 1, 1), dt.datetime(2150, 7, 1)
    for freq, kw in (("MONTHLY", dict(interval=5, bymonthday=[31])), ("HOURLY", dict(interval=77)), ("WEEKLY", dict(interval=3, byweekday=[2], wkst=6)),
                     ("YEARLY", dict(interval=7))):
        step = [x for x in ours(spark, freq, start, within=(lo, hi), **kw)]
        assert step == theirs(freq, start, within=(lo, hi), **kw), freq
    for freq, kw in (("SECONDLY", dict(interval=7919, count=50)), ("YEARLY", dict(bymonth=[2], bymonthday=[29], count=9)), ("MINUTELY", dict(byhour=[3], interval=13, count=40))):
        assert ours(spark, freq, start, **kw) == theirs(freq, start, **kw), freq
    assert ours(spark, "MONTHLY", start, count=20, within=(dt.datetime(2002, 1, 1), dt.datetime(2003, 1, 1))) == [
        x for x in theirs("MONTHLY", start, count=20) if dt.datetime(2002, 1, 1) <= x <= dt.datetime(2003, 1, 1)]
    assert ours(spark, "DAILY", start, within=(dt.datetime(1990, 1, 1), dt.datetime(2000, 1, 1))) == []
    with pytest.raises(ValueError):
        cal.recurrence(spark, "DAILY", start)


@pytest.mark.parametrize("dense", [True, False])
def test_asof_and_between_equal_brute_force(spark, dense):
    rnd = random.Random(4)
    base = dt.datetime(2020, 1, 1)
    times = sorted({base + dt.timedelta(minutes=rnd.randrange(4000 if dense else 4_000_000)) for _ in range(800 if dense else 9)})
    rows = [(k, base + dt.timedelta(minutes=rnd.randrange(-500, 5000)) if k % 50 else None, rnd.choice(times) if k % 3 == 0 else None) for k in range(600)]
    rows = [(k, c or a, (c or a or base) + dt.timedelta(minutes=rnd.randrange(0, 700))) for k, a, c in rows]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, until timestamp_ntz").repartition(5)
    s = spark.createDataFrame([(t,) for t in times] * 2 + [(None,)], "occurrence timestamp_ntz").repartition(3)
    for inclusive in (True, False):
        got = {r.id: (r.a, r.b) for r in J.asof(df, "ts", s, direction="both", inclusive=inclusive, as_=["a", "b"]).collect()}
        one = {r.id: r.a for r in J.asof(df, "ts", s, inclusive=inclusive, as_="a").collect()}
        two = {r.id: r.b for r in J.asof(df, "ts", s, direction="forward", inclusive=inclusive, as_="b").collect()}
        pairs = J.between(df, "ts", "until", s, inclusive=inclusive)
        assert pairs.columns == ["id", "ts", "until", "occurrence"]
        pairs = sorted((r.id, r.occurrence) for r in pairs.collect())
        want = []
        for k, t, u in rows:
            if t is None:
                assert got[k] == (None, None)
                continue
            a = (bisect_right if inclusive else bisect_left)(times, t) - 1
            b = (bisect_left if inclusive else bisect_right)(times, t)
            assert got[k] == (times[a] if a >= 0 else None, times[b] if b < len(times) else None)
            assert got[k] == (one[k], two[k])
            want += [(k, x) for x in times if (t <= x <= u if inclusive else t < x < u)]
        assert len(got) == 600 and pairs == sorted(want)


def test_asof_by_key_with_values_and_one_hot_key(spark):
    rows = [("hot" if k % 3 else f"k{k}", k, dt.datetime(2020, 1, 1) + dt.timedelta(hours=k)) for k in range(900)]
    df = spark.createDataFrame(rows, "key string, id long, ts timestamp_ntz")
    s = df.filter("id % 5 = 0").select("key", F.col("ts").alias("occurrence"), F.col("id").alias("price"))
    got = {r.id: r.p for r in J.asof(df, "ts", s, by=["key"], value="price", as_="p").collect()}
    for key, k, _ in rows:
        assert got[k] == max((j for x, j, _ in rows if x == key and j % 5 == 0 and j <= k), default=None)


def test_asof_plan_has_no_buckets_and_one_sort(spark):
    df = spark.range(50).select(F.col("id"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(dt.datetime(2020, 1, 1))).alias("ts"))
    s = df.filter("id % 7 = 0").select(F.col("ts").alias("occurrence"))
    plan = J.asof(df, "ts", s, direction="both")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("rangepartitioning") == 0  # the sorted rows are checkpointed
