"""Scalar expression functions of the chart grammar (E1-E16) as Spark Columns.

Every function returns a built-in Column expression (JVM side, inside whole-stage
codegen); none is a Python UDF. Division and modulo use ``try_divide`` /
``try_mod`` because ANSI mode raises on zero. Null arithmetic follows SQL (null
in, null out), not the script language's coercions.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---------------------------------------------------------------- E1 operators

def div(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def mod(a, b) -> Column:
    return F.try_mod(_c(a), _c(b))


def neg(a) -> Column:
    return -_c(a)


def pow_(a, b) -> Column:
    return F.pow(_c(a), _c(b))


def strict_eq(a, b) -> Column:
    return _c(a).eqNullSafe(_c(b))


def strict_ne(a, b) -> Column:
    return ~_c(a).eqNullSafe(_c(b))


# ---------------------------------------------------------------- E2 field access

def field(path: str) -> Column:
    """``datum.a.b`` / ``datum['a']['b']`` -> nested field access."""
    parts = path.replace("datum.", "").replace("['", ".").replace("']", "").split(".")
    col = F.col(parts[0])
    for p in parts[1:]:
        col = col.getItem(int(p)) if p.isdigit() else col.getField(p)
    return col


# ---------------------------------------------------------------- E3 constants

# The grammar's named constants.
CONSTANTS = {"NaN": float("nan"), "E": math.e, "LN2": math.log(2), "LN10": math.log(10),
             "LOG2E": 1 / math.log(2), "LOG10E": 1 / math.log(10), "PI": math.pi,
             "SQRT1_2": math.sqrt(0.5), "SQRT2": math.sqrt(2)}


def const(name: str) -> Column:
    return F.lit(CONSTANTS[name])


# ---------------------------------------------------------------- E4 type tests (schema-static)

def _number(c: Column) -> Column:
    """The number that a value of any type stands for; null if it stands for none."""
    return c.cast("string").try_cast("double")


def is_valid(x) -> Column:
    """Not null and, for floating types, not NaN (a text is valid whatever it says)."""
    c = _c(x)
    floating = F.typeof(c).isin("float", "double")
    return c.isNotNull() & ~(floating & F.coalesce(F.isnan(_number(c)), F.lit(False)))


def is_nan(x) -> Column:
    return F.coalesce(F.isnan(_number(_c(x))), F.lit(False))


def is_finite(x) -> Column:
    d = _number(_c(x))
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))


def is_defined(x) -> Column:
    return _c(x).isNotNull()


def type_test(dtype: T.DataType, kind: str) -> bool:
    """isArray / isBoolean / isDate / isNumber / isObject / isString on a column type."""
    return {
        "array": isinstance(dtype, T.ArrayType),
        "boolean": isinstance(dtype, T.BooleanType),
        "date": isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)),
        "number": isinstance(dtype, T.NumericType),
        "object": isinstance(dtype, (T.StructType, T.MapType)),
        "string": isinstance(dtype, T.StringType),
    }[kind]


# ---------------------------------------------------------------- E5 coercion

def _blank_null(c: Column) -> Column:
    return F.when(c.cast("string") == "", F.lit(None)).otherwise(c)


def to_number(x) -> Column:
    return _blank_null(_c(x)).try_cast("double")


def to_boolean(x) -> Column:
    c = _blank_null(_c(x))
    s = F.lower(c.cast("string"))
    return F.when(c.isNull(), F.lit(None)) \
            .when(s.isin("false", "0", "0.0"), F.lit(False)).otherwise(F.lit(True))


def to_string(x) -> Column:
    return _blank_null(_c(x)).cast("string")


def to_date(x) -> Column:
    return _blank_null(_c(x)).try_cast("timestamp_ntz")


# ---------------------------------------------------------------- E6 branch

def if_(cond, then, otherwise) -> Column:
    return F.when(_c(cond), _c(then)).otherwise(_c(otherwise))


# ---------------------------------------------------------------- E7 math

def clamp(x, lo, hi) -> Column:
    return F.least(F.greatest(_c(x), _c(lo)), _c(hi))


def js_round(x) -> Column:
    """Round half toward +inf (the grammar's ``round``)."""
    return F.floor(_c(x).cast("double") + 0.5).cast("double")


def hypot(a, b) -> Column:
    return F.hypot(_c(a), _c(b))


def nan_max(*xs) -> Column:
    """``max``: NaN if any argument is NaN (``greatest`` alone treats NaN as largest)."""
    cs = [_c(x).cast("double") for x in xs]
    anynan = reduce(lambda a, b: a | b, [F.isnan(c) for c in cs])
    return F.when(anynan, F.lit(float("nan"))).otherwise(F.greatest(*cs))


def nan_min(*xs) -> Column:
    cs = [_c(x).cast("double") for x in xs]
    anynan = reduce(lambda a, b: a | b, [F.isnan(c) for c in cs])
    return F.when(anynan, F.lit(float("nan"))).otherwise(F.least(*cs))


MATH = {"abs": F.abs, "acos": F.acos, "asin": F.asin, "atan": F.atan, "atan2": F.atan2,
        "ceil": F.ceil, "cos": F.cos, "exp": F.exp, "floor": F.floor, "log": F.log, "sin": F.sin,
        "sqrt": F.sqrt, "tan": F.tan, "pow": F.pow}


# ---------------------------------------------------------------- E8 random

def random(seed: int = 42) -> Column:
    return F.rand(seed)


def sample_normal(mean=0.0, stdev=1.0, seed: int = 42) -> Column:
    return _c(mean) + _c(stdev) * F.randn(seed)


def sample_log_normal(mean=0.0, stdev=1.0, seed: int = 42) -> Column:
    return F.exp(sample_normal(mean, stdev, seed))


def sample_uniform(lo=0.0, hi=1.0, seed: int = 42) -> Column:
    return _c(lo) + (_c(hi) - _c(lo)) * F.rand(seed)


# ---------------------------------------------------------------- E9 distributions

# Coefficients of the published rational approximations used below
# (error function: Abramowitz & Stegun 7.1.26; normal quantile: Acklam's algorithm).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549671010984440e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)


def _poly(coefs, x: Column) -> Column:
    out = F.lit(coefs[0])
    for k in coefs[1:]:
        out = out * x + F.lit(k)
    return out


def erf(x) -> Column:
    """Error function, |error| < 1.5e-7 (not a Spark built-in)."""
    z = _c(x).cast("double")
    a = F.abs(z)
    t = 1.0 / (1.0 + ERF_P * a)
    y = 1.0 - t * _poly(tuple(reversed(ERF_A)), t) * F.exp(-a * a)
    return F.signum(z) * y


def cumulative_normal(x, mean=0.0, stdev=1.0) -> Column:
    return 0.5 * (1.0 + erf((_c(x) - _c(mean)) / (_c(stdev) * math.sqrt(2.0))))


def density_normal(x, mean=0.0, stdev=1.0) -> Column:
    z = (_c(x) - _c(mean)) / _c(stdev)
    return F.exp(-0.5 * z * z) / (_c(stdev) * math.sqrt(2 * math.pi))


def quantile_normal(p, mean=0.0, stdev=1.0) -> Column:
    p = _c(p).cast("double")
    plow = 0.02425
    q = F.sqrt(-2 * F.log(p))
    low = _poly(ACKLAM_C, q) / (_poly(ACKLAM_D, q) * q + 1)
    qc = p - 0.5
    r = qc * qc
    mid = _poly(ACKLAM_A, r) * qc / (_poly(ACKLAM_B, r) * r + 1)
    qh = F.sqrt(-2 * F.log(1 - p))
    high = -_poly(ACKLAM_C, qh) / (_poly(ACKLAM_D, qh) * qh + 1)
    z = F.when((p <= 0) | (p >= 1), F.lit(None)) \
         .when(p < plow, low).when(p > 1 - plow, high).otherwise(mid)
    return _c(mean) + _c(stdev) * z


def cumulative_log_normal(x, mean=0.0, stdev=1.0) -> Column:
    return F.when(_c(x) <= 0, F.lit(0.0)).otherwise(cumulative_normal(F.log(_c(x)), mean, stdev))


def density_log_normal(x, mean=0.0, stdev=1.0) -> Column:
    lx = F.log(_c(x))
    z = (lx - _c(mean)) / _c(stdev)
    return F.when(_c(x) <= 0, F.lit(0.0)).otherwise(
        F.exp(-0.5 * z * z) / (_c(stdev) * math.sqrt(2 * math.pi) * _c(x)))


def quantile_log_normal(p, mean=0.0, stdev=1.0) -> Column:
    return F.exp(quantile_normal(p, mean, stdev))


def cumulative_uniform(x, lo=0.0, hi=1.0) -> Column:
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.when(x < lo, F.lit(0.0)).when(x >= hi, F.lit(1.0)).otherwise((x - lo) / (hi - lo))


def density_uniform(x, lo=0.0, hi=1.0) -> Column:
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.when((x >= lo) & (x < hi), 1.0 / (hi - lo)).otherwise(F.lit(0.0))


def quantile_uniform(p, lo=0.0, hi=1.0) -> Column:
    p = _c(p)
    return F.when((p < 0) | (p > 1), F.lit(None)).otherwise(_c(lo) + p * (_c(hi) - _c(lo)))


# ---------------------------------------------------------------- E10 arrays

def extent(a) -> Column:
    return F.array(F.array_min(_c(a)), F.array_max(_c(a)))


def clamp_range(rng, lo, hi) -> Column:
    """Shift/limit a [a, b] span into [lo, hi] keeping its width when possible."""
    r = _c(rng)
    a, b = F.least(r[0], r[1]), F.greatest(r[0], r[1])
    span = b - a
    lo, hi = _c(lo), _c(hi)
    return F.when(span >= hi - lo, F.array(lo, hi)) \
            .when(a < lo, F.array(lo, lo + span)) \
            .when(b > hi, F.array(hi - span, hi)).otherwise(F.array(a, b))


def indexof(a, v) -> Column:
    """0-based position, -1 when absent (strings: substring position)."""
    return (F.array_position(_c(a), v) - 1).cast("int")


def str_indexof(s, sub: str) -> Column:
    return (F.instr(_c(s), sub) - 1).cast("int")


def lastindexof(a, v) -> Column:
    rev = F.reverse(_c(a))
    pos = F.array_position(rev, v)
    return F.when(pos == 0, F.lit(-1)).otherwise(F.size(_c(a)) - pos).cast("int")


def inrange(x, rng) -> Column:
    r = _c(rng)
    return (_c(x) >= F.least(r[0], r[1])) & (_c(x) <= F.greatest(r[0], r[1]))


def join(a, sep: str = ",") -> Column:
    return F.array_join(_c(a), sep)


def length(a) -> Column:
    return F.size(_c(a))


def lerp(rng, frac) -> Column:
    r = _c(rng)
    return r[0] + _c(frac) * (F.element_at(r, -1) - r[0])


def peek(a) -> Column:
    return F.element_at(_c(a), -1)


def pluck(a, name: str) -> Column:
    return F.transform(_c(a), lambda x: x.getField(name))


def reverse(a) -> Column:
    return F.reverse(_c(a))


def sequence(start, stop=None, step=1) -> Column:
    """``sequence(stop)`` or ``sequence(start, stop, step)``; stop exclusive."""
    if stop is None:
        start, stop = 0, start
    s, e, st = _c(start), _c(stop), _c(step)
    last = F.when(st > 0, e - 1).otherwise(e + 1)
    seq = F.when(((st > 0) & (s < e)) | ((st < 0) & (s > e)), F.sequence(s, last, st))
    return F.coalesce(F.filter(seq, lambda x: F.when(st > 0, x < e).otherwise(x > e)),
                      F.array().cast("array<int>"))


def slice_(a, start, end=None) -> Column:
    """0-based ``slice``; negative indices count from the end; end exclusive."""
    arr = _c(a)
    n = F.size(arr)
    s = _c(start)
    s = F.when(s < 0, F.greatest(n + s, F.lit(0))).otherwise(F.least(s, n))
    if end is None:
        e = n
    else:
        e = _c(end)
        e = F.when(e < 0, F.greatest(n + e, F.lit(0))).otherwise(F.least(e, n))
    return F.when(e > s, F.slice(arr, s + 1, e - s)).otherwise(F.slice(arr, 1, 0))


def sort(a) -> Column:
    return F.array_sort(_c(a))


def span(a) -> Column:
    return F.array_max(_c(a)) - F.array_min(_c(a))


# ---------------------------------------------------------------- E11 strings

def pad(s, n: int, ch: str = " ", align: str = "right") -> Column:
    """Pad to length n; 'right' pads on the right (left-aligned text), 'left' on the left,
    'center' on both sides."""
    c = _c(s).cast("string")
    if align == "left":
        return F.lpad(c, n, ch)
    if align == "center":
        total = F.greatest(F.lit(n) - F.length(c), F.lit(0))
        left = F.floor(total / 2).cast("int")
        return F.rpad(F.lpad(c, (F.length(c) + left).cast("int"), ch), n, ch)
    return F.rpad(c, n, ch)


def parse_float(s) -> Column:
    m = F.regexp_extract(F.trim(_c(s)), r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)", 0)
    return F.when(m == "", F.lit(None)).otherwise(m.try_cast("double"))


def parse_int(s) -> Column:
    m = F.regexp_extract(F.trim(_c(s)), r"^[+-]?\d+", 0)
    return F.when(m == "", F.lit(None)).otherwise(m.try_cast("bigint"))


def replace_first(s, pattern: str, repl: str) -> Column:
    """String pattern: only the first occurrence is replaced."""
    c = _c(s)
    pos = F.instr(c, pattern)
    return F.when(pos == 0, c).otherwise(
        F.concat(F.substring(c, 1, pos - 1), F.lit(repl),
                 F.substring(c, pos + len(pattern), 1 << 30)))


def substring(s, start, end=None) -> Column:
    """0-based, end exclusive; arguments are swapped when start > end."""
    c = _c(s).cast("string")
    n = F.length(c)
    a = F.least(F.greatest(_c(start), F.lit(0)), n)
    b = n if end is None else F.least(F.greatest(_c(end), F.lit(0)), n)
    lo, hi = F.least(a, b), F.greatest(a, b)
    return F.substring(c, lo + 1, hi - lo)


def truncate(s, n: int, align: str = "right", ellipsis: str = "…") -> Column:
    c = _c(s).cast("string")
    keep = max(n - len(ellipsis), 0)
    if align == "left":
        cut = F.concat(F.lit(ellipsis), F.substring(c, -keep, keep) if keep else F.lit(""))
    elif align == "center":
        left = (keep + 1) // 2
        right = keep // 2
        cut = F.concat(F.substring(c, 1, left), F.lit(ellipsis),
                       F.substring(c, -right, right) if right else F.lit(""))
    else:
        cut = F.concat(F.substring(c, 1, keep), F.lit(ellipsis))
    return F.when(F.length(c) > n, cut).otherwise(c)


def btoa(s) -> Column:
    return F.base64(F.encode(_c(s), "UTF-8"))


def atob(s) -> Column:
    return F.decode(F.try_to_binary(_c(s), F.lit("base64")), "UTF-8")


# ---------------------------------------------------------------- E12 objects

def merge(*maps) -> Column:
    """Later keys win (session sets mapKeyDedupPolicy=LAST_WIN)."""
    return F.map_concat(*[_c(m) for m in maps])


# ---------------------------------------------------------------- E13 number format

def number_format(x, spec: str) -> Column:
    """Number specifiers ``[,][.n][f|%|e|s|d]``: fixed, percent, exponent, SI prefix with ``n``
    significant digits (6 without), integer; without a type up to 12 significant digits
    and no trailing zeros."""
    c = _c(x).cast("double")
    m = re.fullmatch(r"(,)?(?:\.(\d+))?([f%esd])?", spec)
    if not m:
        raise ValueError(f"unsupported number format {spec!r}")
    comma, kind = m.group(1) or "", m.group(3)
    p = int(m.group(2)) if m.group(2) is not None else None
    if kind == "%":
        p = 6 if p is None else p
        v = F.floor(c * 100 * 10 ** p + 0.5) / 10 ** p
        return F.concat(F.format_string(f"%{comma}.{p}f", v.cast("double")), F.lit("%"))
    if kind == "e":
        # one digit at least in the exponent, as in 4.2e+1
        return F.regexp_replace(F.format_string(f"%.{6 if p is None else p}e", c), r"e([+-])0(\d)$", "e$1$2")
    if kind == "s":
        return _si(c, max(6 if p is None else p, 1))
    if kind is None:
        digits = 12 if p is None else max(p, 1)
        exponent = F.when(c == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(c)))).cast("int")
        scale = F.pow(F.lit(10.0), F.lit(digits - 1) - exponent)
        v = F.when(c == 0, c).otherwise(F.round(c * scale) / scale)
        return F.regexp_replace(F.regexp_replace(F.format_string(f"%{comma}.12f", v), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    p = 0 if kind == "d" else 6 if p is None else p
    v = F.floor(c * 10 ** p + 0.5) / 10 ** p
    return F.format_string(f"%{comma}.{p}f", v.cast("double"))


def _si(c: Column, p: int) -> Column:
    """``p`` significant digits with an SI prefix."""
    prefixes = ["y", "z", "a", "f", "p", "n", "µ", "m", "", "k", "M", "G", "T", "P", "E", "Z", "Y"]

    def exponent(v: Column) -> Column:
        return F.when(v == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(v)))).cast("int")

    scale = F.pow(F.lit(10.0), F.lit(p - 1) - exponent(c))
    rounded = F.when(c == 0, c).otherwise(F.round(c * scale) / scale)  # 999.9 may become 1000
    e = exponent(rounded)
    k = F.least(F.greatest(F.floor(e / 3), F.lit(-8)), F.lit(8)).cast("int")
    scaled = rounded / F.pow(F.lit(1000.0), k)
    decimals = F.greatest(F.lit(p - 1) - (e - 3 * k), F.lit(0))
    body = F.format_string("%.0f", scaled)
    for n in range(1, p + 3):
        body = F.when(decimals == n, F.format_string(f"%.{n}f", scaled)).otherwise(body)
    return F.concat(body, F.element_at(F.array(*[F.lit(s) for s in prefixes]), k + 9))


# ---------------------------------------------------------------- E14 regex

def test(s, pattern: str) -> Column:
    return _c(s).rlike(pattern)


def regexp_replace(s, pattern: str, repl: str) -> Column:
    return F.regexp_replace(_c(s), pattern, repl)


def regexp_count(s, pattern: str) -> Column:
    return F.regexp_count(_c(s), F.lit(pattern))
