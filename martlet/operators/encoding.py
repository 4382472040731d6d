"""Encoded aggregation (T29) and the keyword form of the field shorthand.

Channels name what a chart encodes; channels that carry an aggregate op are
aggregated, every other encoded field (raw, time unit or binned) becomes part of
the group key, exactly like the grammar's implicit grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeunits import parse_unit, timeunit
from .aggregates import AGG_OPS


def _is_timeunit(op: str) -> bool:
    try:
        parse_unit(op)
        return True
    except ValueError:
        return False


def channel(spec) -> tuple[str, str | None, str | None]:
    """'field' | (op, field[, as]) -> (kind-op, field, output name)."""
    if isinstance(spec, str):
        return ("field", spec, spec)
    op, fld = spec[0], spec[1] if len(spec) > 1 else None
    name = spec[2] if len(spec) > 2 else (f"{op}_{fld}" if fld else op)
    return (op, fld, name)


def chart_aggregate(df: DataFrame, bin_maxbins: int = 10, **channels) -> DataFrame:
    """``chart_aggregate(df, x=("yearmonth", "ts"), y=("mean", "value"), color="kind")``."""
    from .transforms import aggregate
    keys: list[tuple[Column, str]] = []
    aggs: dict[str, tuple] = {}
    for _, spec in channels.items():
        op, fld, name = channel(spec)
        if op == "field":
            keys.append((F.col(fld), name))
        elif op in AGG_OPS:
            # behind the name: what an ordered op needs (its parameter and the order)
            aggs[name] = (op, fld, *spec[3:])
        elif op == "bin":
            from .stats import bin_expr, nice_bins
            r = df.agg(F.min(fld).alias("lo"), F.max(fld).alias("hi")).first()
            s, e, st = nice_bins(float(r.lo), float(r.hi), bin_maxbins)
            keys.append((bin_expr(F.col(fld), s, e, st), name))
        elif _is_timeunit(op):
            keys.append((timeunit(fld, op), name))
        else:
            raise ValueError(f"unknown encoding op {op!r}")
    if not aggs:
        return df.select(*[c.alias(n) for c, n in keys]).distinct()
    held = [f"_key{i}" for i in range(len(keys))]
    out = aggregate(df.select("*", *[c.alias(h) for (c, _), h in zip(keys, held)]), aggs, held)
    return out.select(*[F.col(h).alias(n) for (_, n), h in zip(keys, held)], *aggs)


def agg(df: DataFrame, groupby=None, **outputs) -> DataFrame:
    """T20 keyword shorthand: ``agg(df, ["k"], mean_x=("mean", "x"), n=("count",))``."""
    from .transforms import aggregate
    return aggregate(df, outputs, groupby)
