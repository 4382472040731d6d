"""Distributed running aggregates (a segmented prefix scan).

``sum(x) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)`` runs each
group in one task; with a low-cardinality ``g`` (a handful of event types) a whole
group - possibly a third of the table - lands on one executor. Here the rows are
range-partitioned by (g, o) instead, so a big group is spread over many
partitions:

1. ``orderBy(g, o)``: range partitions, each sorted;
2. running values inside each (partition, group) segment - a segment is at most
   one partition's rows;
3. one total per (partition, group) segment (a table of at most
   partitions + groups rows), turned into per-segment offsets by a running
   aggregate over that small table;
4. offsets joined back and combined with the in-segment values.

The numbered rows are checkpointed (reliably, into ``spark.checkpoint.dir``)
before they are used twice: partition ids come from a sampled range partitioning
and ``monotonically_increasing_id``, which must not be recomputed differently.

Supported ops are the associative ones: count, sum, mean, min, max, row_number,
last and first (the nearest and the earliest value that is not null), and decayed
(an exponentially weighted sum; associative as (sum, number of values), though the
order matters). Every op but row_number and decayed also runs from the group's end
(``"after"``). The order must be total (add a unique tie-break) unless equal rows
may stand in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .keys import join_on

_LOW33 = (1 << 33) - 1
SCAN_OPS = ("count", "sum", "mean", "average", "min", "max", "row_number", "last", "first", "decayed")


def _fold(op: str, c: Column) -> Column:
    """The aggregate (usable over a window) that an op folds its values with."""
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max,
            "last": lambda x: F.last(x, ignorenulls=True), "first": lambda x: F.first(x, ignorenulls=True)}[op](c)


def _join(op: str, near: Column, far: Column) -> Column:
    """Values of a segment up to a row (``near``) and of all segments before it (``far``)."""
    if op in ("count", "sum"):
        # null as long as no value has been seen, here or in the segments before
        return F.when(near.isNotNull() | far.isNotNull(), F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0)))
    if op == "min":
        return F.least(near, far)
    if op == "max":
        return F.greatest(near, far)
    return F.coalesce(near, far) if op == "last" else F.coalesce(far, near)


def running(df: DataFrame, ops: dict[str, tuple], groupby: Sequence[str], order: Sequence) -> DataFrame:
    """``ops = {"cum": ("sum", "x"), "rn": ("row_number",), "left": ("count", "x", "after"),
    "ema": ("decayed", "x", 0.5)}`` -> running values per group."""
    g = list(groupby)
    cols = list(df.columns)
    s = df.orderBy(*g, *order)
    parts: list[tuple[str, str, Column, bool]] = []  # (column, op, value, from the end)
    out: list[Column] = []
    decayed = []
    for name, spec in ops.items():
        op = spec[0]
        field = spec[1] if len(spec) > 1 else None
        after = len(spec) > 2 and spec[2] == "after"
        if op not in SCAN_OPS:
            raise ValueError(f"running op {op!r} not supported; use transforms.window")
        if op == "row_number":
            parts.append((f"_{name}", "count", F.lit(1), False))
            out.append(F.col(f"_{name}").alias(name))
        elif op in ("mean", "average"):
            v = F.col(field).cast("double")
            parts += [(f"_{name}", "sum", v, after), (f"_n_{name}", "count", v, after)]
            out.append(F.try_divide(F.col(f"_{name}"), F.col(f"_n_{name}").cast("double")).alias(name))
        elif op == "decayed":
            decayed.append((name, field, float(spec[2])))
            parts.append((f"_n_{name}", "count", _finite(field), False))
            out.append(F.col(f"_{name}").alias(name))
        else:
            v = F.col(field).cast("double") if op == "sum" else F.col(field)
            parts.append((f"_{name}", op, v, after))
            out.append(F.col(f"_{name}").alias(name))
    if decayed:
        s = _decayed_within(s, decayed, g)
    s = s.withColumn("_mid", F.monotonically_increasing_id())
    s = s.withColumn("_pid", F.shiftright("_mid", 33))
    up = Window.partitionBy("_pid", *g).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_pid", *g).orderBy(F.col("_mid").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # the numbered rows feed two branches (segment totals and the final join): they
    # are materialised once, so both see the same partition ids even if Spark would
    # re-run the sort (its range bounds are sampled) or lose an executor
    s = cut_lineage(s.select("*", *[_fold(op, v).over(down if after else up).alias(f"_l{c}") for c, op, v, after in parts]))
    totals = [F.max_by(F.struct(f"_l{c}"), F.when(F.lit(after), -F.col("_mid")).otherwise(F.col("_mid")))[f"_l{c}"].alias(f"_t{c}")
              for c, _, _, after in parts]
    totals += [F.max_by(f"_d_{name}", "_mid").alias(f"_td_{name}") for name, _, _ in decayed]
    segments = s.groupBy("_pid", *g).agg(*totals)
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*g).orderBy(F.col("_pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # one row per (partition, group) segment: partitions + groups rows at most
    offsets = segments.select("_pid", *g, *[_fold("sum" if op == "count" else op, F.col(f"_t{c}")).over(behind if after else before).alias(f"_o{c}")
                                            for c, op, _, after in parts])
    if decayed:
        offsets = join_on(offsets, _decayed_before(segments, decayed, g), ["_pid", *g])
    j = join_on(s, offsets, ["_pid", *g], "left")
    j = j.select("*", *[_join(op, F.col(f"_l{c}"), F.col(f"_o{c}")).alias(c) for c, op, _, _ in parts],
                 *[(F.col(f"_d_{name}") + F.pow(F.lit(1 - alpha), F.col(f"_l_n_{name}")) * F.col(f"_od_{name}")).alias(f"_{name}")
                   for name, _, alpha in decayed])
    return j.select(*cols, *out)


# ------------------------------------------------------------------ exponentially weighted sums

def _finite(field: str) -> Column:
    """The values that count: neither null nor NaN."""
    v = F.col(field).cast("double")
    return F.when(~F.isnan(v), v)


def _decayed_within(s: DataFrame, decayed: list, g: list[str]) -> DataFrame:
    """Per row and op the sum of alpha (1 - alpha)**k v over the values of its group so far in its
    sorted partition, k values back each. Spans of 1, 2, 4, ... values are added up, as long as a
    weight is of any size; the last sum of a batch is carried to the next."""
    s = s.withColumn("_key", F.struct(*g) if g else F.lit(1))
    s = s.withColumn("_key", F.xxhash64(F.to_json(F.struct("_key"))))
    s = s.select("*", *[_finite(field).alias(f"_v_{name}") for name, field, _ in decayed])
    keep = len(s.columns) - len(decayed) - 1
    schema = T.StructType([*s.schema.fields[:keep], *[T.StructField(f"_d_{name}", T.DoubleType()) for name, _, _ in decayed]])

    def run(batches):
        key, sums = None, [0.0] * len(decayed)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(keep).to_numpy()
            found = []
            for k, (_, _, alpha) in enumerate(decayed):
                v = b.column(keep + 1 + k).to_numpy(zero_copy_only=False).astype(float)
                some = np.flatnonzero(~np.isnan(v))
                total = np.zeros(b.num_rows)
                same = keys[some]
                x = alpha * v[some]
                # values of the batch's first group go on from the batch before
                lead = same == key
                back = np.cumsum(lead)
                step, weight = 1, 1 - alpha
                while step < len(x) and weight > 1e-300:
                    add = np.where(same[step:] == same[:-step], weight * x[:-step], 0.0)
                    x[step:] += add
                    step, weight = 2 * step, weight * weight
                x = x + np.where(lead, sums[k] * (1 - alpha) ** np.minimum(back, 1 << 40).astype(float), 0.0)
                # rows without a value repeat the sum before them in their group
                at = np.searchsorted(some, np.arange(b.num_rows), "right") - 1
                has = (at >= 0) & (same[np.maximum(at, 0)] == keys) if len(some) else np.zeros(b.num_rows, bool)
                total[has] = x[at[has]]
                rest = ~has & (keys == key)
                total[rest] = sums[k]
                sums[k] = float(total[-1])
                found.append(pa.array(total))
            key = keys[-1]
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], *found], names=schema.names)

    return s.mapInArrow(run, schema)


def _decayed_before(segments: DataFrame, decayed: list, g: list[str]) -> DataFrame:
    """Per segment the weighted sums of all segments before it: (sum, values) pairs folded in
    order. A group has at most one row per partition here."""
    cols = [x for name, _, _ in decayed for x in (f"_td_{name}", f"_t_n_{name}")]
    rows = segments.select("_pid", *g, *cols)
    schema = T.StructType([rows.schema["_pid"], *[rows.schema[k] for k in g], *[T.StructField(f"_od_{name}", T.DoubleType()) for name, _, _ in decayed]])

    def fold(pdf):
        pdf = pdf.sort_values("_pid", ignore_index=True)
        out = pdf[["_pid", *g]].copy()
        for name, _, alpha in decayed:
            so_far, held = 0.0, []
            for total, n in zip(pdf[f"_td_{name}"], pdf[f"_t_n_{name}"]):
                held.append(so_far)
                so_far = total + (1 - alpha) ** float(n) * so_far
            out[f"_od_{name}"] = held
        return out

    if g:
        return rows.groupBy(*g).applyInPandas(fold, schema)
    return rows.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(fold, schema)
