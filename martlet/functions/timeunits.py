"""Time units and date functions of the chart grammar.

Conventions kept from the grammar: month is 0-based, quarter 0-3, day of week
0 = Sunday, weeks are Sunday-based with the days before the first Sunday in week 0,
and units without a year part fold onto the base year 2012.

Naive timestamps (``timestamp_ntz``) are treated as UTC wall time, so each ``utc*``
unit equals its local twin; ``timestamp`` values are read in the session time
zone, which this package pins to UTC.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_YEAR = 2012  # a leap year that starts on a Sunday

_PARTS = ("year", "quarter", "month", "week", "dayofyear", "day", "date", "hours", "minutes",
          "seconds", "milliseconds")
_TOKEN = re.compile("|".join(sorted(_PARTS, key=len, reverse=True)))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_unit(unit: str) -> tuple[set[str], bool, bool]:
    """'utcyearmonthdate' -> ({'year','month','date'}, utc=True, binned=False)."""
    u = unit.lower()
    binned = u.startswith("binned")
    u = u[6:] if binned else u
    utc = u.startswith("utc")
    u = u[3:] if utc else u
    if u == "weeksdayhours":  # spelling used by one entry of the unit list
        u = "weekdayhours"
    parts, pos = set(), 0
    while pos < len(u):
        m = _TOKEN.match(u, pos)
        if not m:
            raise ValueError(f"unknown time unit {unit!r}")
        parts.add(m.group(0))
        pos = m.end()
    return parts, utc, binned


# ---------------------------------------------------------------- C4 / C5 parts

def dow0(d) -> Column:
    """Day of week, 0 = Sunday."""
    return F.dayofweek(_c(d)) - 1


def week0(d) -> Column:
    """Sunday-based week of year: days before the first Sunday are week 0, the
    first Sunday starts week 1."""
    d = _c(d)
    return F.floor((F.dayofyear(d) - 1 + 7 - dow0(d)) / 7).cast("int")


def millis(d) -> Column:
    return (F.unix_micros(_c(d).cast("timestamp")) % 1_000_000 / 1000).cast("int")


def date_part(name: str, d) -> Column:
    """C4 expression functions: year quarter month date day dayofyear week hours ..."""
    d = _c(d)
    name = name.lower()
    if name.startswith("utc"):
        name = name[3:]
    return {
        "year": F.year(d),
        "quarter": F.floor((F.month(d) - 1) / 3).cast("int"),
        "month": F.month(d) - 1,
        "date": F.dayofmonth(d),
        "day": dow0(d),
        "dayofyear": F.dayofyear(d),
        "week": week0(d),
        "hours": F.hour(d),
        "minutes": F.minute(d),
        "seconds": F.second(d),
        "milliseconds": millis(d),
    }[name]


# ---------------------------------------------------------------- C1 / C2 / C3 timeunit

def timeunit(d, unit: str) -> Column:
    """Floor a timestamp to ``unit``; parts not in the unit take their defaults."""
    parts, _utc, binned = parse_unit(unit)
    d = _c(d)
    if binned:
        return d
    y = F.year(d) if "year" in parts else F.lit(BASE_YEAR)
    jan1 = F.make_date(y, F.lit(1), F.lit(1))
    if "month" in parts:
        m = F.month(d)
    elif "quarter" in parts:
        m = F.floor((F.month(d) - 1) / 3).cast("int") * 3 + 1
    else:
        m = F.lit(1)
    if "week" in parts and "year" in parts:
        # the Sunday starting the date's week (plus the weekday when it is a part)
        day = F.date_sub(F.to_date(d), (F.lit(0) if "day" in parts else dow0(d)).cast("int"))
    elif "week" in parts:
        # week w of the base year, which starts on a Sunday: week 1 starts on 1 January
        off = (week0(d) - 1) * 7 + (dow0(d) if "day" in parts else F.lit(0))
        day = F.date_add(jan1, off.cast("int"))
    elif "dayofyear" in parts:
        day = F.date_add(jan1, (F.dayofyear(d) - 1).cast("int"))
    elif "day" in parts and "date" not in parts:
        # weekday only: the matching day of the base year's first week
        day = F.date_add(F.make_date(F.lit(BASE_YEAR), F.lit(1), F.lit(1)), dow0(d).cast("int"))
    else:
        day = F.make_date(y, m, F.dayofmonth(d) if "date" in parts else F.lit(1))
    hh = F.hour(d) if "hours" in parts else F.lit(0)
    mi = F.minute(d) if "minutes" in parts else F.lit(0)
    ss = F.second(d) if "seconds" in parts else F.lit(0)
    ms = millis(d) if "milliseconds" in parts else F.lit(0)
    secs = (ss + ms / 1000).cast("decimal(8,3)")
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hh, mi, secs)


def timeunit_transform(df: DataFrame, field: str, unit: str, as_: str | None = None,
                       end: str | None = None) -> DataFrame:
    """Add the unit start (and optionally the unit end) as columns."""
    out = df.withColumn(as_ or f"{unit}_{field}", timeunit(field, unit))
    if end:
        step = _unit_step(unit)
        out = out.withColumn(end, time_offset(step, F.col(as_ or f"{unit}_{field}"), 1))
    return out


def _unit_step(unit: str) -> str:
    parts, _, _ = parse_unit(unit)
    for p in ("milliseconds", "seconds", "minutes", "hours", "date", "day", "dayofyear", "week",
              "month", "quarter", "year"):
        if p in parts:
            return {"date": "date", "day": "date", "dayofyear": "date"}.get(p, p)
    return "year"


# ---------------------------------------------------------------- C6 build

def datetime_(year, month0=0, day=1, hours=0, minutes=0, seconds=0, ms=0) -> Column:
    """C6 ``datetime``: 0-based month; out-of-range parts roll over like a JS Date."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    base = F.make_timestamp_ntz(lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    t = F.timestamp_add("MONTH", lit(month0), base)
    t = F.timestamp_add("DAY", lit(day) - 1, t)
    t = F.timestamp_add("HOUR", lit(hours), t)
    t = F.timestamp_add("MINUTE", lit(minutes), t)
    t = F.timestamp_add("SECOND", lit(seconds), t)
    return F.timestamp_add("MILLISECOND", lit(ms), t)


utc = datetime_  # naive timestamps are UTC wall time


# ---------------------------------------------------------------- C7 epoch

def time_ms(d) -> Column:
    """C7 ``time``: epoch milliseconds."""
    return F.unix_millis(_c(d).cast("timestamp"))


def timezone_offset(d, tz: str) -> Column:
    """C7 ``timezoneoffset``: minutes UTC minus local for wall time ``d`` in ``tz``."""
    wall = _c(d).cast("timestamp_ntz")
    inst = F.to_utc_timestamp(wall.cast("timestamp"), tz)
    return ((F.unix_seconds(wall.cast("timestamp")) - F.unix_seconds(inst)) / -60).cast("int")


# ---------------------------------------------------------------- C8 / C9 offset, sequence

_ADD_UNIT = {"year": ("MONTH", 12), "quarter": ("MONTH", 3), "month": ("MONTH", 1),
             "week": ("DAY", 7), "date": ("DAY", 1), "day": ("DAY", 1), "dayofyear": ("DAY", 1),
             "hours": ("HOUR", 1), "minutes": ("MINUTE", 1), "seconds": ("SECOND", 1),
             "milliseconds": ("MILLISECOND", 1)}


def time_offset(unit: str, d, step=1) -> Column:
    """C8 ``timeOffset`` / ``utcOffset``."""
    u = unit.lower()
    u = u[3:] if u.startswith("utc") else u
    name, mult = _ADD_UNIT[u]
    st = step if isinstance(step, Column) else F.lit(step)
    return F.timestamp_add(name, st * mult, _c(d).cast("timestamp_ntz"))


def time_sequence(unit: str, start, stop, step: int = 1) -> Column:
    """C9 ``timeSequence``: array of unit steps from start, stop exclusive."""
    u = unit.lower()
    u = u[3:] if u.startswith("utc") else u
    name, mult = _ADD_UNIT[u]
    interval = F.expr(f"make_interval(0, {mult * step if name == 'MONTH' else 0}, 0, "
                      f"{mult * step if name == 'DAY' else 0}, "
                      f"{mult * step if name == 'HOUR' else 0}, "
                      f"{mult * step if name == 'MINUTE' else 0}, "
                      f"{(mult * step) if name == 'SECOND' else (mult * step / 1000 if name == 'MILLISECOND' else 0)})")
    s, e = _c(start).cast("timestamp_ntz"), _c(stop).cast("timestamp_ntz")
    seq = F.when(s < e, F.sequence(s, e, interval)).otherwise(F.array().cast("array<timestamp_ntz>"))
    return F.filter(seq, lambda x: x < e)


# ---------------------------------------------------------------- C10 format / parse

# English day and month names used by the format functions.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
DAY_ABBREV = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]
MONTH_ABBREV = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# d3 time specifier -> Java DateTimeFormatter pattern (fixed mapping).
D3_TO_JAVA = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "e": "d", "H": "HH", "I": "hh",
              "M": "mm", "S": "ss", "L": "SSS", "f": "SSSSSS", "B": "MMMM", "b": "MMM",
              "A": "EEEE", "a": "EEE", "j": "DDD", "p": "a", "Z": "XX", "%": "%"}


def d3_to_java(spec: str) -> str:
    out, lit, i = [], [], 0

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(f"'{text}'" if any(ch.isalpha() for ch in text) else text)
            lit.clear()

    while i < len(spec):
        ch = spec[i]
        if ch == "%" and i + 1 < len(spec):
            k = spec[i + 1]
            if k in ("-", "_", "0") and i + 2 < len(spec):  # padding modifiers
                k = spec[i + 2]
                i += 1
            if k not in D3_TO_JAVA:
                raise ValueError(f"unsupported time specifier %{k}")
            flush()
            out.append(D3_TO_JAVA[k])
            i += 2
        else:
            lit.append(ch)
            i += 1
    flush()
    return "".join(out)


def time_format(d, spec: str) -> Column:
    return F.date_format(_c(d), d3_to_java(spec))


def time_parse(s, spec: str) -> Column:
    return F.try_to_timestamp(_c(s), F.lit(d3_to_java(spec))).cast("timestamp_ntz")


def _pick(names: list[str], i) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (_c(i) + 1).cast("int"))


def day_format(i) -> Column:
    return _pick(DAY_NAMES, i)


def day_abbrev_format(i) -> Column:
    return _pick(DAY_ABBREV, i)


def month_format(i) -> Column:
    return _pick(MONTH_NAMES, i)


def month_abbrev_format(i) -> Column:
    return _pick(MONTH_ABBREV, i)
