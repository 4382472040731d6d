"""Aggregate operations by name (A1-A17), usable in aggregate, joinaggregate and window.

``agg_column(op, field, df)`` returns a Spark aggregate Column. All are built-in
aggregates (partial + final, so they combine map-side). Ops that are no aggregate of
their own - percentiles by selection, bootstrap bounds, exponential averages - are
done by ``transforms.aggregate`` and ``transforms.window``; as a Column a percentile
is Spark's ``percentile`` (exact; for window frames) or ``percentile_approx`` when
the caller asks for ``approx=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)

# Fixed list of operation names accepted by aggregate / joinaggregate / window.
AGG_OPS = (
    "count", "valid", "missing", "distinct", "sum", "product", "mean", "average",
    "variance", "variancep", "stdev", "stdevp", "stderr", "min", "max", "median", "q1", "q3",
    "argmin", "argmax", "values", "ci0", "ci1", "exponential", "exponentialb",
)


def _dtype(df: DataFrame | None, field: str | None):
    if df is None or field is None or "." in field:
        return None
    for f in df.schema.fields:
        if f.name == field:
            return f.dataType
    return None


def is_valid(c: Column, dtype=None) -> Column:
    """Not null and, for floating types, not NaN."""
    if dtype is None or isinstance(dtype, FLOATING):
        return c.isNotNull() & ~F.isnan(c.cast("double")) if dtype is not None else c.isNotNull()
    return c.isNotNull()


def is_missing(c: Column, dtype=None) -> Column:
    """Null, or the empty string for text columns (our definition)."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def agg_column(op: str, field: str | None = None, df: DataFrame | None = None,
               approx: bool = False, param=None) -> Column:
    op = op.lower()
    dtype = _dtype(df, field)
    c = F.col(field) if field is not None else None
    if op == "count":
        return F.count(F.lit(1))
    if c is None:
        raise ValueError(f"aggregate op {op!r} needs a field")
    if op == "valid":
        return F.count(F.when(is_valid(c, dtype), F.lit(1)))
    if op == "missing":
        return F.count(F.when(is_missing(c, dtype), F.lit(1)))
    if op == "distinct":
        return F.countDistinct(c)
    if op == "sum":
        return F.sum(c)
    if op == "product":
        return F.product(c.cast("double"))
    if op in ("mean", "average"):
        return F.avg(c)
    if op == "variance":
        return F.var_samp(c)
    if op == "variancep":
        return F.var_pop(c)
    if op == "stdev":
        return F.stddev_samp(c)
    if op == "stdevp":
        return F.stddev_pop(c)
    if op == "stderr":
        return F.stddev_samp(c) / F.sqrt(F.count(c))
    if op == "min":
        return F.min(c)
    if op == "max":
        return F.max(c)
    if op in ("median", "q1", "q3"):
        p = {"median": 0.5, "q1": 0.25, "q3": 0.75}[op]
        return F.percentile_approx(c, p, 10000) if approx else F.percentile(c, F.lit(p))
    if op in ("argmin", "argmax"):
        cols = [F.col(n) for n in df.columns] if df is not None else [c]
        row = F.struct(*cols)
        # ties on the field are broken by the whole row, so the pick is deterministic; rows
        # whose field is null or NaN have a null key and are never picked
        key = F.when(is_valid(c, dtype), F.struct(c, row))
        return F.min_by(row, key) if op == "argmin" else F.max_by(row, key)
    if op == "values":
        cols = [F.col(n) for n in df.columns] if df is not None else [c]
        return F.collect_list(F.struct(*cols))
    raise ValueError(f"aggregate op {op!r} has no Column form; use aggregate, joinaggregate or window")
