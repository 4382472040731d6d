"""Field predicates, predicate algebra and selections.

Selections are tables or predicates: a point selection is a left-semi join to the
chosen tuples (so it scales with both sides), an interval selection is a
conjunction of range / membership predicates, an index selection uses a stable
global row number (computed without a single-partition window).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import global_row_number


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- P12 field predicates

def field_equal(f: str, v) -> Column:
    return _c(f) == F.lit(v)


def field_range(f: str, lo=None, hi=None) -> Column:
    """Inclusive range; a missing bound is open."""
    c = _c(f)
    parts = [c >= F.lit(lo)] if lo is not None else []
    parts += [c <= F.lit(hi)] if hi is not None else []
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def field_one_of(f: str, values: Sequence) -> Column:
    return _c(f).isin(list(values))


def field_lt(f, v) -> Column:
    return _c(f) < F.lit(v)


def field_lte(f, v) -> Column:
    return _c(f) <= F.lit(v)


def field_gt(f, v) -> Column:
    return _c(f) > F.lit(v)


def field_gte(f, v) -> Column:
    return _c(f) >= F.lit(v)


def field_valid(f: str, valid: bool = True) -> Column:
    from ..functions.expr import is_valid
    ok = is_valid(_c(f))
    return ok if valid else ~ok


# ---------------------------------------------------------------- P13 algebra

def not_(p: Column) -> Column:
    return ~p


def and_(*ps: Column) -> Column:
    return reduce(lambda a, b: a & b, ps)


def or_(*ps: Column) -> Column:
    return reduce(lambda a, b: a | b, ps)


# ---------------------------------------------------------------- P11 when/then/otherwise

def when_chain(cases: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    out = None
    for cond, val in cases:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if otherwise is not None:
        out = out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return out


# ---------------------------------------------------------------- P14 named params

def sql_with_params(spark: SparkSession, text: str, **params) -> DataFrame:
    """Parameters referenced as ``:name`` in SQL text (bound, not spliced)."""
    return spark.sql(text, args=params)


# ---------------------------------------------------------------- P15 point selection

def point_select(df: DataFrame, chosen: DataFrame, fields: Sequence[str],
                 empty_all: bool = True) -> DataFrame:
    """Rows whose (fields) tuple is among ``chosen``; an empty selection keeps all
    rows unless ``empty_all=False``."""
    keys = chosen.select(*fields).distinct()
    hit = df.join(keys, list(fields), "left_semi")
    if not empty_all:
        return hit
    is_empty = ~keys.select(F.lit(1)).exists()
    return df.filter(is_empty).unionByName(hit)


def point_predicate(fields: Sequence[str], tuples: Sequence[Sequence], empty_all: bool = True) -> Column:
    """Point selection over a small literal set of tuples, as a predicate."""
    if not tuples:
        return F.lit(empty_all)
    rows = [and_(*[F.col(f).eqNullSafe(F.lit(v)) for f, v in zip(fields, t)]) for t in tuples]
    return or_(*rows)


# ---------------------------------------------------------------- P16 interval selection

def interval_predicate(spec: Mapping[str, Sequence]) -> Column:
    """``{"x": [lo, hi], "c": ["a", "b", "c"]}``: 2 numbers/dates = inclusive range,
    otherwise a value list; AND over dimensions."""
    parts = []
    for f, v in spec.items():
        v = list(v)
        if len(v) == 2 and not all(isinstance(x, str) for x in v):
            lo, hi = min(v), max(v)
            parts.append(F.col(f).between(lo, hi))
        else:
            parts.append(F.col(f).isin(v))
    return and_(*parts) if parts else F.lit(True)


# ---------------------------------------------------------------- P17 index selection

def index_select(df: DataFrame, order: Sequence, indices: DataFrame | Sequence[int],
                 index_col: str = "_index") -> DataFrame:
    """Rows at 0-based positions of a stable total order."""
    ranked = global_row_number(df, order, index_col)
    ranked = ranked.withColumn(index_col, F.col(index_col) - 1)
    if not isinstance(indices, DataFrame):
        spark = df.sparkSession
        indices = spark.createDataFrame([(int(i),) for i in indices], f"{index_col} long")
    return ranked.join(indices.select(index_col).distinct(), index_col, "left_semi")


# ---------------------------------------------------------------- P18 resolve

def resolve(predicates: Sequence[Column], how: str = "global") -> Column:
    """global: the last selection wins; union: any; intersect: all."""
    if not predicates:
        return F.lit(True)
    if how == "global":
        return predicates[-1]
    return or_(*predicates) if how == "union" else and_(*predicates)


# ---------------------------------------------------------------- P20 invalid filter

def drop_invalid(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Remove rows whose plotted value is null, or NaN for floating fields."""
    preds = []
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for f in fields:
        c = F.col(f)
        p = c.isNotNull()
        if types.get(f) in ("double", "float"):
            p = p & ~F.isnan(c)
        preds.append(p)
    return df.filter(and_(*preds)) if preds else df
