"""Table transforms of the chart grammar (T1-T29) as ``DataFrame -> DataFrame`` functions.

Each transform is declarative: it returns a new DataFrame and leaves the physical
plan to Catalyst. A chain of transforms is ``df.transform(f1).transform(f2)`` (T21).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import agg_column
from .keys import join_on
from .scan import running

Ops = dict[str, tuple]  # output name -> (op, field[, param])


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _sort_cols(sort) -> list[Column]:
    """Sort spec: 'f' / '-f' (descending) / Column / (field, 'descending')."""
    out = []
    for s in _as_list(sort):
        if isinstance(s, Column):
            out.append(s)
        elif isinstance(s, tuple):
            f, order = s
            out.append(F.col(f).desc() if order.startswith("desc") else F.col(f).asc())
        elif s.startswith("-"):
            out.append(F.col(s[1:]).desc())
        else:
            out.append(F.col(s).asc())
    return out


# ------------------------------------------------------------------ T1 aggregate

QUANTILE_OPS = {"median": 0.5, "q1": 0.25, "q3": 0.75}


def aggregate(df: DataFrame, ops: Ops, groupby: Sequence[str] | None = None,
              approx: bool = False) -> DataFrame:
    """``ops = {"mean_x": ("mean", "x"), "n": ("count",)}``; one group if no groupby.

    Percentile ops (median, q1, q3) are exact and selected from the ordered values of
    all groups at once; ``approx=True`` asks for the mergeable sketch instead.
    ``ci0`` / ``ci1`` are bootstrap bounds of the mean; ``("exponential", field, alpha,
    order)`` and ``exponentialb`` need the fields that order the rows."""
    from . import stats
    from .selecting import exact_quantiles
    g = _as_list(groupby)
    plain, parts, quantiles, bounds, averages = [], [], {}, {}, {}
    for name, spec in ops.items():
        op, field = spec[0].lower(), spec[1] if len(spec) > 1 else None
        if op in QUANTILE_OPS and not approx:
            quantiles.setdefault(field, {})[name] = QUANTILE_OPS[op]
        elif op in ("ci0", "ci1"):
            bounds.setdefault(field, {})[name] = op
        elif op in ("exponential", "exponentialb"):
            if len(spec) < 4:
                raise ValueError(f"{op!r} needs the fields that order the rows: ({op!r}, field, alpha, order)")
            averages.setdefault((field, 0.5 if spec[2] is None else spec[2], tuple(_as_list(spec[3]))), {})[name] = op
        else:
            plain.append(agg_column(op, field, df, approx).alias(name))
    for field, names in quantiles.items():
        q = exact_quantiles(df, F.col(field), list(names.values()), g, "_q")
        parts.append(q.select(*g, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))
    for field, names in bounds.items():
        ci = stats.bootstrap_ci(df, field, g)
        parts.append(ci.select(*g, *[F.col(op).alias(n) for n, op in names.items()]))
    for (field, alpha, order), names in averages.items():
        both = stats.exponential_both(df, field, order, alpha, g)
        parts.append(both.select(*g, *[F.col(op).alias(n) for n, op in names.items()]))
    plain = plain or [F.count(F.lit(1)).alias("_rows")]
    out = df.groupBy(*g).agg(*plain) if g else df.agg(*plain)
    for part in parts:
        # without groups both sides are single rows
        out = join_on(out, part, g, "left") if g else out.join(F.broadcast(part), F.lit(True), "left")
    return out.select(*g, *ops)


# ------------------------------------------------------------------ T5 joinaggregate

def joinaggregate(df: DataFrame, ops: Ops, groupby: Sequence[str] | None = None) -> DataFrame:
    """T5: aggregates attached to every input row.

    Written as aggregate + equi-join on the group keys rather than an aggregate
    window: the aggregate combines map-side and the join lets AQE split a hot group,
    where a window would hold a whole group in one task."""
    g = _as_list(groupby)
    agg = aggregate(df, ops, g)
    if not g:
        # one-row aggregate: each value becomes a scalar subquery
        return df.select("*", *[agg.select(n).scalar().alias(n) for n in ops])
    agg = agg.select(*[F.col(k).alias(f"_jk{i}") for i, k in enumerate(g)], *ops)
    cond = [F.col(k).eqNullSafe(F.col(f"_jk{i}")) for i, k in enumerate(g)]
    return df.join(agg, cond, "left").select(*df.columns, *ops)


# ------------------------------------------------------------------ T6 extent

def extent(df: DataFrame, field: str) -> DataFrame:
    """One-row [min, max] of a field (the 'param' value)."""
    return df.agg(F.array(F.min(field), F.max(field)).alias(f"{field}_extent"))


# ------------------------------------------------------------------ T7 flatten

def flatten(df: DataFrame, fields: Sequence[str], as_: Sequence[str] | None = None,
            index: str | None = None) -> DataFrame:
    """Parallel arrays -> one row per position; shorter arrays are null-padded."""
    as_ = list(as_ or fields)
    keep = [c for c in df.columns if c not in fields]
    z = F.arrays_zip(*[F.col(f).alias(a) for f, a in zip(fields, as_)])
    exploded = df.select(*keep, F.posexplode(z).alias("_pos", "_z"))
    extra = [F.col("_pos").alias(index)] if index else []
    return exploded.select(*keep, *extra, *[F.col("_z")[a].alias(a) for a in as_])


# ------------------------------------------------------------------ T8 fold

def fold(df: DataFrame, fields: Sequence[str], as_: tuple[str, str] = ("key", "value")) -> DataFrame:
    """Wide -> long (key, value) rows; other columns are kept."""
    keep = [c for c in df.columns if c not in fields]
    return df.unpivot(keep, list(fields), as_[0], as_[1])


# ------------------------------------------------------------------ T10 pivot

def pivot(df: DataFrame, pivot_field: str, value: str, groupby: Sequence[str] | None = None,
          limit: int = 0, op: str = "sum") -> DataFrame:
    """Long -> wide. Pivot names are the sorted distinct values (first ``limit``).

    The distinct values are read once (a bounded list: it becomes the column set)."""
    names_df = df.select(F.col(pivot_field).cast("string").alias("v")).dropna().distinct().orderBy("v")
    if limit:
        names_df = names_df.limit(limit)
    # the names become columns: read at most Spark's own pivot bound (+1 to detect overflow)
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    names = [r.v for r in names_df.limit(bound + 1).collect()]
    if len(names) > bound:
        raise ValueError(f"pivot: more than {bound} distinct values of {pivot_field!r}")
    g = _as_list(groupby)
    agg = agg_column(op, value, df) if op not in (*QUANTILE_OPS, "ci0", "ci1") else None
    if agg is None:
        # not a Spark aggregate: computed per cell first
        df = aggregate(df.filter(F.col(pivot_field).isNotNull()), {"_cell": (op, value)}, [*g, pivot_field])
        agg = F.first("_cell")
    gd = df.groupBy(*g) if g else df.groupBy()
    return gd.pivot(pivot_field, names).agg(agg)


# ------------------------------------------------------------------ T11 quantile

def quantile(df: DataFrame, field: str, probs: Sequence[float] | None = None, step: float = 0.01,
             groupby: Sequence[str] | None = None, as_: tuple[str, str] = ("prob", "value"),
              approx: bool = False) -> DataFrame:
    """Quantiles at ``probs`` or at step/2, 3·step/2, ... < 1 (exact unless the
    caller asks for ``approx=True``)."""
    if probs is None:
        n = int(math.floor((1 - step / 2) / step + 1e-9)) + 1
        probs = [round(step / 2 + i * step, 12) for i in range(n) if step / 2 + i * step < 1]
    g = _as_list(groupby)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        out = (df.groupBy(*g) if g else df.groupBy()).agg(F.percentile_approx(field, arr, 10000).alias("_q"))
    else:
        from .selecting import exact_quantiles
        out = exact_quantiles(df, F.col(field), probs, g, "_q")
    return out.select(*g, F.posexplode("_q").alias("_i", as_[1])) \
              .select(*g, arr[F.col("_i")].alias(as_[0]), as_[1])


# ------------------------------------------------------------------ T13 sample

def sample(df: DataFrame, n: int = 1000, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """At most ``n`` rows without replacement.

    Rows are ranked by a seeded hash of ``key`` (default: all columns) and the n
    smallest kept: a top-n (TakeOrderedAndProject keeps n rows per task), so no
    full sort and the same rows every run."""
    cols = [F.col(c) for c in (key or df.columns)]
    h = F.xxhash64(F.lit(seed), *cols)
    return df.withColumn("_h", h).orderBy("_h", *cols).limit(n).drop("_h")


def sample_fraction(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    """T13 (frac form): Bernoulli sample."""
    return df.sample(withReplacement=False, fraction=frac, seed=seed)


# ------------------------------------------------------------------ T14 stack

def stack(df: DataFrame, field: str, groupby: Sequence[str], sort: Sequence | None = None,
          offset: str = "zero", as_: tuple[str, str] | str = ("y0", "y1"), distributed: bool = False) -> DataFrame:
    """Running start/end of ``field`` within each stack (``groupby`` = the stack id).

    Negative values stack downward apart from positives (offset 'zero');
    'normalize' divides by the stack's absolute total; 'center' shifts each stack
    by (max total - total) / 2."""
    g = _as_list(groupby)
    if isinstance(as_, str):  # one name: start field, end field gets "_end"
        as_ = (as_, f"{as_}_end")
    order = _sort_cols(sort) or [F.monotonically_increasing_id()]
    v = F.col(field).cast("double")
    sign = F.when(v < 0, F.lit(-1)).otherwise(F.lit(1))
    signed = df.withColumn("_sign", sign)
    if sort and distributed:
        out = running(signed.withColumn("_v", v), {as_[1]: ("sum", "_v")}, [*g, "_sign"], order) \
            .drop("_v")
    else:
        w = Window.partitionBy(*g, "_sign").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = signed.withColumn(as_[1], F.sum(v).over(w))
    out = out.withColumn(as_[0], F.col(as_[1]) - v)
    if offset == "normalize":
        tot = F.sum(F.abs(v)).over(Window.partitionBy(*g))
        out = out.withColumn(as_[0], F.try_divide(F.col(as_[0]), tot)) \
                 .withColumn(as_[1], F.try_divide(F.col(as_[1]), tot))
    elif offset == "center":
        tot = F.sum(F.abs(v)).over(Window.partitionBy(*g))
        out = out.withColumn("_tot", tot)
        mx = out.agg(F.max("_tot")).scalar()
        shift = (mx - F.col("_tot")) / 2
        neg = F.sum(F.when(v < 0, -v).otherwise(F.lit(0.0))).over(Window.partitionBy(*g))
        out = out.withColumn(as_[0], F.col(as_[0]) + shift + neg) \
                 .withColumn(as_[1], F.col(as_[1]) + shift + neg).drop("_tot")
    return out.drop("_sign")


# ------------------------------------------------------------------ T16 window

RANK_OPS = {"row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile"}
VALUE_OPS = {"lag", "lead", "first_value", "last_value", "nth_value"}


def window(df: DataFrame, ops: Ops, sort: Sequence | None = None,
           groupby: Sequence[str] | None = None, frame: tuple = (None, 0),
           ignore_peers: bool = False, tiebreak: Sequence[str] | None = None,
           distributed: bool = False) -> DataFrame:
    """``ops = {"cum": ("sum", "x"), "rk": ("rank",), "prev": ("lag", "x", 1)}``.

    ``frame`` = (lo, hi) row offsets, None = unbounded, default (None, 0).
    With ``ignore_peers=False`` and a sort, frames ending at the current row widen
    to the whole peer group (a RANGE frame); numeric frames with peers, and running
    exponential averages, are done by ``dwindow.window_distributed``. A window without sort has no peers (W15) and needs an
    explicit order to be deterministic, so a sort is required.

    Spark's window operator gives each group to one task. For few or skewed
    groups pass ``distributed=True`` (``dwindow.window_distributed``; the caller's choice,
    never made by size): row numbers
    from a range-partitioned scan, everything else by joins on row numbers.
    """
    g = _as_list(groupby)
    order = _sort_cols(sort)
    if not order:
        raise ValueError("window needs an explicit sort (row order is not defined otherwise)")
    from .dwindow import distributable, window_distributed
    if distributed:
        # skewed / low-cardinality group keys: no group is ever held by one task
        return window_distributed(df, ops, sort, g, frame, _as_list(tiebreak), ignore_peers)
    base = Window.partitionBy(*g).orderBy(*order + _sort_cols(tiebreak))

    def framed_for(fr):
        """The window for a (lo, hi) frame; None for a numeric frame with peers."""
        lo, hi = fr
        start = Window.unboundedPreceding if lo is None else lo
        end = Window.unboundedFollowing if hi is None else hi
        if (not ignore_peers) and (lo is None or lo == 0) and (hi is None or hi == 0):
            # frames ending at the current row include its peers: a RANGE frame
            return Window.partitionBy(*g).orderBy(*order).rangeBetween(
                start if lo is None else Window.currentRow, end if hi is None else Window.currentRow)
        if not ignore_peers:
            return None
        return base.rowsBetween(start, end)

    cols, scanned, whole = [], {}, {}
    for name, spec in ops.items():
        op = spec[0]
        field = spec[1] if len(spec) > 1 else None
        param = spec[2] if len(spec) > 2 else None
        fr = spec[3] if len(spec) > 3 else frame  # an op may carry its own frame
        if op in RANK_OPS:
            rank_w = Window.partitionBy(*g).orderBy(*order) if op in ("rank", "dense_rank", "percent_rank",
                                                                      "cume_dist") else base
            fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank,
                  "percent_rank": F.percent_rank, "cume_dist": F.cume_dist}.get(op)
            col = F.ntile(int(param or 1)).over(base) if op == "ntile" else fn().over(rank_w)
        elif op in ("lag", "lead"):
            fn = F.lag if op == "lag" else F.lead
            col = fn(field, int(param or 1)).over(base)
        elif op in ("ci0", "ci1"):
            if fr != (None, None):
                raise NotImplementedError("bootstrap bounds are taken over whole groups: frame=(None, None)")
            whole[name] = (op, field)
            continue
        elif op in ("exponential", "exponentialb"):
            # averages in row order: peers don't count; a running one is a scan
            if tuple(fr) == (None, 0):
                scanned[name] = (op, field, param, fr)
                continue
            lo, hi = fr
            frame_rows = base.rowsBetween(Window.unboundedPreceding if lo is None else lo, Window.unboundedFollowing if hi is None else hi)
            values = F.when(~F.isnan(F.col(field).cast("double")), F.col(field).cast("double"))
            col = _exponential(F.collect_list(values).over(frame_rows), op, 0.5 if param is None else float(param))
        else:
            framed = framed_for(fr)
            if framed is None:
                # a numeric frame with peers
                if not distributable(op, *fr, False):
                    raise NotImplementedError(f"{op!r} over a numeric frame widened to peers; pass ignore_peers=True")
                scanned[name] = (op, field, param, fr)
                continue
            if op == "first_value":
                col = F.first(field).over(framed)
            elif op == "last_value":
                col = F.last(field).over(framed)
            elif op == "nth_value":
                col = F.nth_value(field, int(param or 1)).over(framed)
            else:
                col = agg_column(op, field, df).over(framed)
        cols.append(col.alias(name))
    out = df.select("*", *cols)
    averages = {n: x for n, x in scanned.items() if x[0].startswith("exponential")}
    if averages:
        out = window_distributed(out, averages, sort, g, frame, _as_list(tiebreak), True)
    peers = {n: x for n, x in scanned.items() if n not in averages}
    if peers:
        out = window_distributed(out, peers, sort, g, frame, _as_list(tiebreak), False)
    if whole:
        out = joinaggregate(out, whole, g)
    return out.select(*df.columns, *ops)


def _exponential(values: Column, op: str, alpha: float) -> Column:
    """The exponential average of an array of values, oldest first."""
    if op == "exponential":
        return F.aggregate(values, F.lit(None).cast("double"), lambda e, v: F.coalesce(alpha * v + (1 - alpha) * e, v))
    total = F.aggregate(values, F.lit(0.0), lambda e, v: alpha * v + (1 - alpha) * e)
    return F.try_divide(total, 1 - F.pow(F.lit(1 - alpha), F.size(values).cast("double")))


# ------------------------------------------------------------------ T19 calculate / T18 filter

def calculate(df: DataFrame, **exprs: Column | str) -> DataFrame:
    """Named formulas applied in order; later ones see earlier ones."""
    for name, e in exprs.items():
        df = df.withColumn(name, F.expr(e) if isinstance(e, str) else e)
    return df


def filter_(df: DataFrame, *predicates: Column | str, **equals) -> DataFrame:
    """AND of positional predicates and ``field == value`` keywords."""
    preds = [F.expr(p) if isinstance(p, str) else p for p in predicates]
    preds += [F.col(k) == F.lit(v) for k, v in equals.items()]
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


# ------------------------------------------------------------------ T21 transform chain / U2 registry

def chain(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply transforms in order."""
    for f in steps:
        df = df.transform(f)
    return df


class TransformRegistry:
    """Named, enable-able ``DataFrame -> DataFrame`` transformers."""

    def __init__(self):
        self._items: dict[str, Callable[[DataFrame], DataFrame]] = {}
        self.active: str | None = None

    def register(self, name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
        self._items[name] = fn

    def enable(self, name: str) -> None:
        if name not in self._items:
            raise KeyError(name)
        self.active = name

    def names(self) -> list[str]:
        return sorted(self._items)

    def apply(self, df: DataFrame) -> DataFrame:
        return df if self.active is None else df.transform(self._items[self.active])


# ------------------------------------------------------------------ T24 repeat / T25 facet

def repeat_columns(df: DataFrame, fields: Sequence[str], ops: Ops, groupby: Sequence[str] | None = None,
                   as_: tuple[str, str] = ("repeat", "value")) -> DataFrame:
    """The same aggregate for each named column: one unpivot, grouped by column name."""
    keep = _as_list(groupby)
    long = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in fields]) \
             .unpivot(keep, list(fields), as_[0], as_[1])
    ops2 = {n: (s[0], as_[1] if len(s) > 1 else None) for n, s in ops.items()}
    return aggregate(long, ops2, [as_[0], *keep])


def facet_aggregate(df: DataFrame, facet: Sequence[str], ops: Ops,
                    groupby: Sequence[str] | None = None) -> DataFrame:
    """Per-facet results = facet columns added to the group key."""
    return aggregate(df, ops, [*_as_list(facet), *_as_list(groupby)])


# ------------------------------------------------------------------ T27 sort by other field

def sort_by_field(df: DataFrame, field: str, by: str, op: str | None = "sum",
                  descending: bool = False) -> DataFrame:
    """Order categories of ``field`` by ``op(by)``; returns (field, sort_value, rank)."""
    agg = aggregate(df, {"sort_value": (op, by)}, [field]) if op else \
        df.groupBy(field).agg(F.min(by).alias("sort_value"))
    key = F.col("sort_value").desc() if descending else F.col("sort_value").asc()
    # one row per category: bounded by the category count
    return agg.withColumn("order", F.row_number().over(Window.orderBy(key, F.col(field))))


# ------------------------------------------------------------------ T28 layered datasets

def layered(df: DataFrame, views: dict[str, Callable[[DataFrame], DataFrame]],
            cache: bool = False) -> dict[str, DataFrame]:
    """One transformed table per named view over a shared input."""
    base = df.cache() if cache else df
    return {name: base.transform(f) for name, f in views.items()}
