"""Calendar operators (C11-C18): month differences, calendar shifts, recurrence
calendars, Easter dates, DST audit, zone conversion and date normalisation.

Column functions are plain built-in expressions. The recurrence calendar is a
distributed day table (``spark.range`` over the day span, so it is split across
tasks) filtered by calendar parts, with per-period ranks for nth-weekday and
set-position rules.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---------------------------------------------------------------- C11 month_diff

def month_diff(later, earlier) -> Column:
    """(years, months, seconds) such that earlier + years + months + seconds = later,
    months stepped back while the month step overshoots (month ends clip)."""
    a, b = _c(later).cast("timestamp_ntz"), _c(earlier).cast("timestamp_ntz")
    m0 = (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))
    at = lambda m: F.timestamp_add("MONTH", m, b)
    fwd = a >= b
    m1 = F.when(fwd & (at(m0) > a), m0 - 1).when(~fwd & (at(m0) < a), m0 + 1).otherwise(m0)
    m2 = F.when(fwd & (at(m1) > a), m1 - 1).when(~fwd & (at(m1) < a), m1 + 1).otherwise(m1)
    rest = F.timestamp_diff("MICROSECOND", at(m2), a) / 1e6
    sign = F.when(m2 < 0, F.lit(-1)).otherwise(F.lit(1))
    years = (sign * F.floor(F.abs(m2) / 12)).cast("int")
    months = (m2 - years * 12).cast("int")
    return F.struct(years.alias("years"), months.alias("months"), rest.alias("seconds"))


# ---------------------------------------------------------------- C12 calendar_shift

def calendar_shift(d, years=0, months=0, weeks=0, days=0, hours=0, minutes=0, seconds=0,
                   microseconds=0, year=None, month=None, day=None, hour=None, minute=None,
                   second=None, weekday: tuple[int, int] | None = None, leapdays=0) -> Column:
    """Absolute parts replace, relative parts add (years/months first, day clipped to
    the month end), then days and time, then the n-th weekday (0 = Monday) on/after
    (n > 0) or on/before (n < 0)."""
    t = _c(d).cast("timestamp_ntz")
    y = (F.lit(year) if year is not None else F.year(t)) + years
    mo = (F.lit(month) if month is not None else F.month(t)) + months
    y = y + F.floor((mo - 1) / 12).cast("int")
    mo = F.pmod(mo - 1, F.lit(12)) + 1
    first = F.make_date(y.cast("int"), mo.cast("int"), F.lit(1))
    dd = F.least(F.lit(day) if day is not None else F.dayofmonth(t), F.dayofmonth(F.last_day(first)))
    hh = F.lit(hour) if hour is not None else F.hour(t)
    mi = F.lit(minute) if minute is not None else F.minute(t)
    us = F.unix_micros(t.cast("timestamp")) % 1_000_000
    ss = (F.lit(second) if second is not None else F.second(t)) + us / 1e6
    base = F.make_timestamp_ntz(y.cast("int"), mo.cast("int"), dd.cast("int"), hh, mi,
                                ss.cast("decimal(16,6)"))
    extra_days = F.lit(days + 7 * weeks)
    if leapdays:
        leap = (F.pmod(y, F.lit(4)) == 0) & ((F.pmod(y, F.lit(100)) != 0) | (F.pmod(y, F.lit(400)) == 0))
        extra_days = extra_days + F.when((mo > 2) & leap, F.lit(leapdays)).otherwise(F.lit(0))
    total_us = (F.lit(hours).cast("bigint") * 3600 + F.lit(minutes).cast("bigint") * 60
                + F.lit(seconds).cast("bigint")) * 1_000_000 + F.lit(microseconds).cast("bigint")
    out = F.timestamp_add("MICROSECOND", total_us, F.timestamp_add("DAY", extra_days, base))
    if weekday is not None:
        wd, nth = weekday[0], (weekday[1] or 1)
        name, day = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")[wd], out.cast("date")
        nearest = F.next_day(F.date_sub(day, 1 if nth > 0 else 7), name)
        further = 7 * (nth - 1 if nth > 0 else nth + 1)
        jump = F.datediff(nearest, day) + F.lit(further)
        out = F.timestamp_add("DAY", jump, out)
    return out


# ---------------------------------------------------------------- C15 easter

def easter(year, method: int = 3) -> Column:
    """Easter Sunday for a year column: 1 = Julian, 2 = Orthodox (Gregorian date),
    3 = Western (default). The Sunday after the paschal full moon, whose day in March
    comes from the epact (Western) or the 19-year cycle of the Julian calendar."""
    y = _c(year).cast("int")
    golden = F.pmod(y, F.lit(19)) + 1
    century = F.floor(y / 100) + 1
    if method == 3:
        solar = F.floor(3 * century / 4) - 12
        lunar = F.floor((8 * century + 5) / 25) - 5
        epact = F.pmod(11 * golden + 20 + lunar - solar, F.lit(30))
        epact = epact + F.when((epact == 24) | ((epact == 25) & (golden > 11)), F.lit(1)).otherwise(F.lit(0))
        moon = F.when(epact > 23, 74 - epact).otherwise(44 - epact)
        return F.next_day(F.date_add(F.make_date(y, F.lit(3), F.lit(1)), (moon - 1).cast("int")), "Sun")
    # the Julian date's distance to the Gregorian calendar after February
    ahead = (F.floor(y / 100) - F.floor(y / 400) - 2).cast("int")
    moon = F.pmod(19 * (golden - 1) + 15, F.lit(30)).cast("int")
    sunday = F.next_day(F.date_add(F.make_date(y, F.lit(3), F.lit(21)), moon + ahead), "Sun")
    return sunday if method == 2 else F.date_sub(sunday, ahead)


# ---------------------------------------------------------------- C16 dst_audit / C17 zones

def dst_audit(wall, tz: str) -> Column:
    """Wall time in ``tz``: struct(imaginary, ambiguous, resolved).

    imaginary: the wall time does not exist (spring-forward gap); resolved moves
    it forward by the gap. ambiguous: the wall time happens twice (fall-back)."""
    w = _c(wall).cast("timestamp_ntz")
    inst = F.to_utc_timestamp(w.cast("timestamp"), tz)
    back = F.from_utc_timestamp(inst, tz).cast("timestamp_ntz")

    def offset(days: int) -> Column:
        at = F.timestamp_add("DAY", F.lit(days), inst)
        return F.timestamp_diff("MICROSECOND", at.cast("timestamp_ntz"), F.from_utc_timestamp(at, tz).cast("timestamp_ntz"))

    def reads_so(off: Column) -> Column:
        at = F.timestamp_add("MICROSECOND", -off, w.cast("timestamp"))
        return F.from_utc_timestamp(at, tz).cast("timestamp_ntz") == w

    # the offsets in force around the wall time both give it, and differ
    ambiguous = (offset(-1) != offset(1)) & reads_so(offset(-1)) & reads_so(offset(1))
    return F.struct((back != w).alias("imaginary"), ambiguous.alias("ambiguous"),
                    back.alias("resolved"))


def zone_convert(wall, to_tz: str, from_tz=None, default_tz: str = "UTC") -> Column:
    """Wall time in ``from_tz`` (column or name; null -> ``default_tz``) to wall time in ``to_tz``."""
    src = F.coalesce(_c(from_tz) if from_tz is not None else F.lit(None).cast("string"),
                     F.lit(default_tz))
    return F.convert_timezone(src, F.lit(to_tz), _c(wall).cast("timestamp_ntz"))


# ---------------------------------------------------------------- C18 date_normalise

# Ordered format lists tried by the normaliser.
FORMATS_MONTH_FIRST = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm",
                       "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss",
                       "MM/dd/yyyy", "MM-dd-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy",
                       "d MMMM yyyy", "yyyyMMdd"]
FORMATS_DAY_FIRST = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm",
                     "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy HH:mm:ss",
                     "dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "d MMM yyyy", "d MMMM yyyy",
                     "MMM d, yyyy", "yyyyMMdd"]


def parse_date_any(s, dayfirst: bool = False, formats: Sequence[str] | None = None) -> Column:
    fmts = formats or (FORMATS_DAY_FIRST if dayfirst else FORMATS_MONTH_FIRST)
    txt = F.trim(_c(s))
    return F.coalesce(*[F.try_to_timestamp(txt, F.lit(f)) for f in fmts]).cast("timestamp_ntz")


def normalise_dates(df: DataFrame, field: str, as_: str = "parsed", dayfirst: bool = False
                    ) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected rows) for a mixed-format text column; null texts are rejected."""
    out = df.withColumn(as_, parse_date_any(field, dayfirst))
    return out.filter(F.col(as_).isNotNull()), out.filter(F.col(as_).isNull())


# ---------------------------------------------------------------- C13 / C14 recurrence

FREQS = ("YEARLY", "MONTHLY", "WEEKLY", "DAILY", "HOURLY", "MINUTELY", "SECONDLY")
# Sub-daily frequencies: seconds of a step.
_UNIT = {"HOURLY": 3600, "MINUTELY": 60, "SECONDLY": 1}
_LAST_DAY = _dt.datetime(9999, 12, 31, 23, 59, 59)


def day_table(spark: SparkSession, start, end, step_days: int = 1) -> DataFrame:
    """One row per day in [start, end] as a distributed range."""
    start_d = start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start)[:10])
    end_d = end if isinstance(end, _dt.date) else _dt.date.fromisoformat(str(end)[:10])
    if isinstance(start_d, _dt.datetime):
        start_d = start_d.date()
    if isinstance(end_d, _dt.datetime):
        end_d = end_d.date()
    n = (end_d - start_d).days + 1
    return spark.range(0, max(n, 0), step_days).select(
        F.date_add(F.lit(start_d), F.col("id").cast("int")).alias("day"))


def _moment(x) -> _dt.datetime:
    return x if isinstance(x, _dt.datetime) else _dt.datetime.fromisoformat(str(x))


def _whole_periods(freq: str, first: _dt.date, last: _dt.date, wkst: int) -> tuple[_dt.date, _dt.date]:
    """The span of days widened to whole years, months or weeks of the frequency."""
    if freq == "YEARLY":
        return first.replace(month=1, day=1), last.replace(month=12, day=31)
    if freq == "MONTHLY":
        behind = (last.replace(day=28) + _dt.timedelta(days=4)) if last < _dt.date(9999, 12, 1) else None
        return first.replace(day=1), (behind - _dt.timedelta(days=behind.day)) if behind else _LAST_DAY.date()
    if freq == "WEEKLY":
        more = 6 - (last.weekday() - wkst) % 7
        return first - _dt.timedelta(days=(first.weekday() - wkst) % 7), last + _dt.timedelta(days=min(more, (_LAST_DAY.date() - last).days))
    return first, last


def recurrence(spark: SparkSession, freq: str, dtstart, until=None, count: int | None = None,
               interval: int = 1, bymonth: Sequence[int] | None = None,
               bymonthday: Sequence[int] | None = None,
               byweekday: Sequence[int | tuple[int, int]] | None = None,
               byyearday: Sequence[int] | None = None, byweekno: Sequence[int] | None = None,
               bysetpos: Sequence[int] | None = None, byeaster: Sequence[int] | None = None,
               byhour: Sequence[int] | None = None, byminute: Sequence[int] | None = None,
               bysecond: Sequence[int] | None = None, wkst: int = 0, within: tuple | None = None) -> DataFrame:
    """Occurrence table (column ``occurrence``, timestamp_ntz) of a recurrence rule.

    Weekdays are 0 = Monday ... 6 = Sunday; ``(wd, n)`` is the n-th such weekday of
    the month or year (negative from the end; n counts for MONTHLY and YEARLY only);
    weeks start on ``wkst``. Dates that do not exist (the 31st of a short month) are
    skipped, never clipped. Time of day is the start's unless ``byhour`` /
    ``byminute`` / ``bysecond`` expand it; below the frequency's own unit they
    expand, above it they filter. Set positions count the times of a whole period,
    also of those that the start or ``until`` cuts.

    A rule without ``until`` and ``count`` goes on for ever: ``within`` = (lo, hi)
    names the part that is wanted (it may be given with any rule). Only its days are
    made, as the steps of a rule are found from the day number by congruence, not by
    walking from the start. A rule with a count is followed as far as it needs."""
    freq = freq.upper()
    if freq not in FREQS:
        raise ValueError(f"freq must be one of {FREQS}")
    start = _moment(dtstart).replace(microsecond=0)
    if until is None and count is None and within is None:
        raise ValueError("a rule without end needs until, count or within")
    stop = _moment(until) if until is not None else _LAST_DAY
    lo, hi = (_moment(x) for x in within) if within else (start, stop)
    rule = dict(freq=freq, start=start, interval=interval, bymonth=bymonth, bymonthday=bymonthday, byweekday=byweekday,
                byyearday=byyearday, byweekno=byweekno, bysetpos=bysetpos, byeaster=byeaster, byhour=byhour, byminute=byminute,
                bysecond=bysecond, wkst=wkst)
    if count is None:
        return _occurrences(spark, max(start, lo), min(stop, hi), **rule)
    # as far as the count needs: the horizon grows until the rule has given enough
    days = {"YEARLY": 366, "MONTHLY": 31, "WEEKLY": 7, "DAILY": 1}.get(freq, _UNIT.get(freq, 0) / 86400)
    ahead = min(count * interval * days, 3_000_000) + 62
    while True:
        end = min(stop, start + _dt.timedelta(days=ahead)) if ahead < (stop - start).days else stop
        t = _occurrences(spark, start, end, **rule)
        if end == stop or t.count() >= count:
            break
        ahead *= 8
    # the rule's own COUNT: first ``count`` occurrences (the feature, not a cap)
    t = t.orderBy("occurrence").limit(count)
    return t.filter((F.col("occurrence") >= F.lit(lo)) & (F.col("occurrence") <= F.lit(hi))) if within else t


def _occurrences(spark, lo, hi, freq, start, interval, bymonth, bymonthday, byweekday, byyearday, byweekno, bysetpos, byeaster,
                 byhour, byminute, bysecond, wkst) -> DataFrame:
    """The rule's occurrences in [lo, hi], which lies within its bounds."""
    first, last = _whole_periods(freq, lo.date(), hi.date(), wkst) if lo <= hi else (lo.date(), lo.date() - _dt.timedelta(days=1))
    if freq == "WEEKLY":
        first = max(first, start.date())  # the first week counts from the start
    t = day_table(spark, first, last)
    d = F.col("day")
    wd = F.pmod(F.dayofweek(d) + 5, F.lit(7))  # Monday = 0
    # defaults expanded from the start date when no by-rule names the day
    if not any([bymonthday, byweekday, byyearday, byweekno, byeaster]):
        if freq == "YEARLY":
            bymonth, bymonthday = bymonth or [start.month], [start.day]
        elif freq == "MONTHLY":
            bymonthday = [start.day]
        elif freq == "WEEKLY":
            byweekday = [start.weekday()]
    # steps of the rule: the period's number from the start's
    since = F.datediff(d, F.lit(start.date()))
    if freq == "YEARLY":
        step = F.year(d) - start.year
    elif freq == "MONTHLY":
        step = F.year(d) * 12 + F.month(d) - (start.year * 12 + start.month)
    elif freq == "WEEKLY":
        step = F.floor((since + (start.weekday() - wkst) % 7) / 7)
    else:
        step = since
    if freq not in _UNIT:
        t = t.filter((step >= 0) & (F.pmod(step, F.lit(interval)) == 0))
    of_month, of_year = F.dayofmonth(d), F.dayofyear(d)
    month_days, year_days = F.dayofmonth(F.last_day(d)), F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31)))
    if bymonth:
        t = t.filter(F.month(d).isin(list(bymonth)))
    if bymonthday:
        t = t.filter(_any([of_month == (F.lit(k) if k > 0 else month_days + k + 1) for k in bymonthday]))
    if byyearday:
        t = t.filter(_any([of_year == (F.lit(k) if k > 0 else year_days + k + 1) for k in byyearday]))
    if byweekno:
        # a week belongs to the year of its fourth day; negative numbers count from that year's last week
        fourth = F.date_add(d, (3 - F.pmod(wd - wkst, F.lit(7))).cast("int"))
        number = F.floor((F.dayofyear(fourth) - 1) / 7) + 1
        rest = F.dayofyear(F.make_date(F.year(fourth), F.lit(12), F.lit(31))) - F.dayofyear(fourth)
        weeks = number + F.floor(rest / 7)
        t = t.filter(_any([number == (F.lit(k) if k > 0 else weeks + 1 + k) for k in byweekno]))
    if byeaster:
        e = easter(F.year(d))
        t = t.filter(_any([d == F.date_add(e, k) for k in byeaster]))
    if byweekday:
        named = []
        for w in byweekday:
            day, n = w if isinstance(w, tuple) else (w, 0)
            if not n or freq not in ("YEARLY", "MONTHLY"):
                named.append(wd == day)
                continue
            # its number in the month (also of a yearly rule that names months) or year
            at, size = (of_month, month_days) if freq == "MONTHLY" or bymonth else (of_year, year_days)
            place = F.floor((at - 1) / 7) + 1 if n > 0 else F.floor((size - at) / 7) + 1
            named.append((wd == day) & (place == abs(n)))
        t = t.filter(_any(named))
    t = t.withColumn("_second", F.explode(_seconds(freq, start, interval, since, byhour, byminute, bysecond)))
    t = t.withColumn("occurrence", F.timestamp_add("SECOND", F.col("_second"), d.cast("timestamp_ntz")))
    if bysetpos:
        # per-period windows: a period holds at most one year of candidate times
        period = step if freq not in _UNIT else F.floor((since.cast("bigint") * 86400 + F.col("_second")) / _UNIT[freq])
        t = t.withColumn("_period", period)
        up = Window.partitionBy("_period").orderBy("occurrence")
        down = Window.partitionBy("_period").orderBy(F.col("occurrence").desc())
        t = t.withColumn("_up", F.row_number().over(up)).withColumn("_down", F.row_number().over(down))
        t = t.filter(_any([(F.col("_up") == k) if k > 0 else (F.col("_down") == -k) for k in bysetpos]))
    return t.select("occurrence").filter((F.col("occurrence") >= F.lit(lo)) & (F.col("occurrence") <= F.lit(hi)))


def _seconds(freq: str, start: _dt.datetime, interval: int, since: Column, byhour, byminute, bysecond) -> Column:
    """The seconds of a day at which the rule stands, as an array."""
    def times(hours, minutes, seconds):
        return sorted({h * 3600 + m * 60 + x for h in hours for m in minutes for x in seconds})

    if freq not in _UNIT:
        out = times(byhour or [start.hour], byminute or [start.minute], bysecond or [start.second])
        return F.array(*[F.lit(x) for x in out])
    unit = _UNIT[freq]
    per_day = 86400 // unit
    # the day's steps: those congruent to the start's modulo the interval
    at_start = (start.hour * 3600 + start.minute * 60 + start.second) // unit
    lead = F.pmod(F.lit(at_start) - since.cast("bigint") * per_day, F.lit(interval)).cast("int")
    steps = F.when(lead < per_day, F.sequence(lead, F.lit(per_day - 1), F.lit(interval))).otherwise(F.array().cast("array<int>"))
    if byhour:
        steps = F.filter(steps, lambda x: F.floor(x * unit / 3600).isin(list(byhour)))
    if byminute and unit < 3600:
        steps = F.filter(steps, lambda x: F.pmod(F.floor(x * unit / 60), F.lit(60)).isin(list(byminute)))
    if bysecond and unit == 1:
        steps = F.filter(steps, lambda x: F.pmod(x, F.lit(60)).isin(list(bysecond)))
    minutes = (byminute or [start.minute]) if unit == 3600 else [0]
    seconds = (bysecond or [start.second]) if unit > 1 else [0]
    inner = times([0], minutes, seconds)
    return F.flatten(F.transform(steps, lambda x: F.array(*[x * unit + F.lit(k) for k in inner])))


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def recurrence_set(include: Sequence[DataFrame], exclude: Sequence[DataFrame] = ()) -> DataFrame:
    """C14: (rules ∪ dates) minus (exrules ∪ exdates), one ``occurrence`` column each."""
    inc = include[0]
    for x in include[1:]:
        inc = inc.unionByName(x)
    inc = inc.distinct()
    if exclude:
        exc = exclude[0]
        for x in exclude[1:]:
            exc = exc.unionByName(x)
        inc = inc.join(exc.distinct(), "occurrence", "left_anti")
    return inc
