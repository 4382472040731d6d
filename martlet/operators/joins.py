"""Lookup, membership, as-of and range joins.

Lookup and membership are equi-joins on real keys, so Spark can hash-partition both
sides (or broadcast a side whose estimated size is under the session threshold).
As-of and between put rows and schedule into one order and scan it; the tolerance
join turns its condition into an equi-join on a time bucket plus a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .ranking import global_row_number
from .scan import running


def _as_list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------- J5 lookup

def lookup(df: DataFrame, from_df: DataFrame, key: str | Sequence[str], from_key=None,
           fields: Sequence[str] | None = None, as_: Sequence[str] | None = None,
           default=None) -> DataFrame:
    """Left equi lookup. The secondary table is de-duplicated on its key (first
    row by key order of the remaining columns) so the row count never grows.
    ``default`` (a value, or one per output field in a dict) stands in where no row
    matches; a null of a matched row stays null. A text default makes its field a text."""
    keys = _as_list(key)
    fkeys = _as_list(from_key) if from_key is not None else keys
    fields = list(fields or [c for c in from_df.columns if c not in fkeys])
    as_ = list(as_ or fields)
    right = from_df.select(*[F.col(k).alias(f"_lk{i}") for i, k in enumerate(fkeys)],
                           *[F.col(f).alias(a) for f, a in zip(fields, as_)])
    # one row per key: a min_by over the key group combines map-side
    first = right.groupBy(*[f"_lk{i}" for i in range(len(fkeys))]).agg(
        F.min(F.struct(*as_)).alias("_v"))
    cond = [df[k] == first[f"_lk{i}"] for i, k in enumerate(keys)]
    out = df.join(first, cond, "left")
    vals = [F.col("_v")[a] for a in as_]
    if default is not None:
        per = default if isinstance(default, dict) else dict.fromkeys(as_, default)
        kinds = {a: from_df.schema[f].dataType for f, a in zip(fields, as_)}

        def filled(v: Column, a: str) -> Column:
            if per.get(a) is None:
                return v
            if isinstance(per[a], str) and not isinstance(kinds[a], T.StringType):
                v = v.cast("string")
            return F.when(F.col("_v").isNotNull(), v).otherwise(F.lit(per[a]))

        vals = [filled(v, a) for v, a in zip(vals, as_)]
    return out.select(*[df[c] for c in df.columns], *[v.alias(a) for v, a in zip(vals, as_)])


# ---------------------------------------------------------------- J6 membership

def semi(df: DataFrame, other: DataFrame, on, keep: bool = True) -> DataFrame:
    """Rows whose key is (``keep``) or is not present in ``other``."""
    return df.join(other, on, "left_semi" if keep else "left_anti")


def indata(df: DataFrame, other: DataFrame, field: str, other_field: str | None = None,
           as_: str = "indata") -> DataFrame:
    """E15 ``indata``: boolean column, does ``other`` hold this value."""
    of = other_field or field
    keys = other.select(F.col(of).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return df.join(keys, df[field] == keys["_k"], "left") \
             .select(*[df[c] for c in df.columns], F.coalesce(F.col("_hit"), F.lit(False)).alias(as_))


# ---------------------------------------------------------------- J7 as-of

def asof(df: DataFrame, ts: str, schedule: DataFrame, occ: str = "occurrence",
         direction: str = "backward", inclusive: bool = True, as_: str | Sequence[str] | None = None,
         by: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """For each row, the last schedule time <= ts (backward), the first >= ts
    (forward), or ``both`` in two columns; strict with ``inclusive=False``. ``by``
    matches within equal keys; ``value`` returns that schedule column instead of the time.

    Rows and schedule are put into one time order and a segmented scan carries the
    nearest schedule row to each row: one sort whatever the direction, no time buckets,
    and neither a dense schedule nor a hot key meets in one task. A null time finds
    nothing; null schedule times are left out. Of equal schedule times the largest
    ``value`` counts."""
    if direction not in ("backward", "forward", "both"):
        raise ValueError(f"direction {direction!r}: backward, forward or both")
    by = _as_list(by)
    names = [f"backward_{occ}", f"forward_{occ}"] if direction == "both" else [f"{direction}_{occ}"]
    if as_ is not None:
        names = _as_list(as_)
    # at equal times a schedule row stands before the rows (0), after them (2), or on both sides
    wanted = {d: (0 if (d == "backward") == inclusive else 2) for d in (("backward", "forward") if direction == "both" else (direction,))}
    keys = [f"_by{i}" for i in range(len(by))]
    time = F.col(occ).cast("timestamp_ntz")
    found = F.col(value) if value else time
    times = schedule.select(*[F.col(k).alias(a) for k, a in zip(by, keys)], time.alias("_t"), found.alias("_v")).filter(F.col("_t").isNotNull())
    times = times.groupBy(*keys, "_t").agg(F.max("_v").alias("_v"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    both = df.select(*[F.col(k).alias(a) for k, a in zip(by, keys)], F.col(ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"), row.alias("_row"))
    for side in sorted(set(wanted.values())):
        marks = [F.when(F.lit(wanted.get(d) == side), F.struct("_v")).alias(f"_{d}") for d in wanted]
        both = both.unionByName(times.select(*keys, "_t", F.lit(side).alias("_side"), *marks), allowMissingColumns=True)
    ops = {f"_got_{d}": ("last", f"_{d}", "before" if d == "backward" else "after") for d in wanted}
    out = running(both, ops, keys, ["_t", "_side"]).filter("_side = 1")
    return out.select("_row.*", *[F.when(F.col("_t").isNotNull(), F.col(f"_got_{d}._v")).alias(n) for d, n in zip(wanted, names)])


# ---------------------------------------------------------------- J8 occurrences between

def between(df: DataFrame, lo: str, hi: str, schedule: DataFrame, occ: str = "occurrence",
            inclusive: bool = False) -> DataFrame:
    """One output row per (input row, schedule time in (lo, hi) or [lo, hi]).

    The schedule times are numbered in order and both ends of a row are ranked among
    them by the as-of scan; the numbers between the ranks are then the row's
    occurrences, looked up by number. The work beside the sorts is that of the output."""
    times = schedule.select(F.col(occ).cast("timestamp_ntz").alias(occ)).filter(F.col(occ).isNotNull()).distinct()
    times = cut_lineage(global_row_number(times, [occ], "_k"))
    ranked = asof(df, lo, times, occ, inclusive=not inclusive, as_="_a", value="_k")
    ranked = asof(ranked, hi, times, occ, inclusive=inclusive, as_="_b", value="_k")
    first, last = F.coalesce("_a", F.lit(0)) + 1, F.coalesce("_b", F.lit(0))
    some = ranked.filter(F.col(lo).isNotNull() & F.col(hi).isNotNull() & (first <= last))
    each = some.withColumn("_k", F.explode(F.sequence(first, last))).drop("_a", "_b")
    return each.join(times, "_k").drop("_k")


# ---------------------------------------------------------------- P19 tolerance match

def within_delta(a, b, delta_seconds: float) -> Column:
    """P19 predicate: |a - b| <= delta."""
    diff = F.timestamp_diff("MICROSECOND", F.col(a) if isinstance(a, str) else a,
                            F.col(b) if isinstance(b, str) else b)
    return F.abs(diff) <= int(delta_seconds * 1_000_000)


def tolerance_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
                   delta_seconds: float, on: Sequence[str] = ()) -> DataFrame:
    """P19 as a join: pairs with |left_ts - right_ts| <= delta.

    Time is cut into buckets of width delta; a right row joins the left rows of its
    own and the two neighbouring buckets (right side replicated ×3), then the exact
    distance filter."""
    width = max(int(delta_seconds * 1_000_000), 1)
    lb = F.floor(F.unix_micros(F.col(left_ts).cast("timestamp")) / width).cast("bigint")
    rb = F.floor(F.unix_micros(F.col(right_ts).cast("timestamp")) / width).cast("bigint")
    L = left.withColumn("_b", lb)
    R = right.withColumn("_b", F.explode(F.array(rb - 1, rb, rb + 1)))
    j = L.join(R, ["_b", *on])
    return j.filter(within_delta(F.col(left_ts), F.col(right_ts), delta_seconds)).drop("_b")
