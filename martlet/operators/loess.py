"""Locally weighted linear regression (T9) over any number of x values.

Every x is fitted from its nearest points, ``bandwidth`` of all, with tricube weights.
Neither a group nor a neighbourhood is held by one task:

* rows are reduced to distinct (x, count, sum of y), numbered in order by the
  segmented scan;
* the nearest k points of x start at the first place L whose window's midpoint
  (X[L] + X[L + k]) / 2 is not below x. These midpoints grow with L and change only
  where one of both ends does, so two scans - one that makes the midpoints, one that
  looks every x up among them - find all starts, and a third turns places into the
  numbers of x values;
* a weight (1 - d^3)^3 is a polynomial in d on either side of x. Blocks of 2, 4, 8, ...
  neighbouring x values keep their moments about their own centre; a neighbourhood is
  cut into a few such blocks on each side (twice the logarithm of its length), and its
  weighted sums are the blocks' moments shifted and scaled to x. Centred moments keep
  the sums as exact as direct ones.

Work: x values times the logarithm of their number, in joins on (group, level, block).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .keys import join_on
from .scan import running

#: log2 of the x values whose blocks one task builds at a time; highest powers in the sums.
TIER = 10
POWERS_W, POWERS_Y = 11, 10


def _moments(u: np.ndarray, weight: np.ndarray, first: np.ndarray, powers: int) -> np.ndarray:
    """Per block (from ``first`` on) the sums of weight * u**p."""
    terms, out = weight.astype(float), []
    for _ in range(powers + 1):
        out.append(np.add.reduceat(terms, first))
        terms = terms * u
    return np.column_stack(out)


def _shifted(m: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Moments in scale * u + shift from the moments in u."""
    n = m.shape[1]
    out = np.zeros_like(m)
    up, by = scale[:, None] ** np.arange(n), shift[:, None] ** np.arange(n)
    for q in range(n):
        for p in range(q + 1):
            out[:, q] += comb(q, p) * by[:, q - p] * up[:, p] * m[:, p]
    return out


def _frame(level: int, block, lo, hi, a, b) -> pd.DataFrame:
    return pd.DataFrame({"_level": level, "_node": block, "_c": (lo + hi) / 2, "_s": (hi - lo) / 2, "_mw": list(a), "_my": list(b)})


def _leaves(pdf: pd.DataFrame) -> pd.DataFrame:
    """The blocks of up to 2**TIER neighbouring x values, from the values themselves."""
    pdf = pdf.sort_values("_i")
    at = pdf["_i"].to_numpy() - 1
    x, w, y = (pdf[c].to_numpy(float) for c in ("_x", "_w", "_sy"))
    out = []
    for level in range(TIER + 1):
        block, first = np.unique(at >> level, return_index=True)
        last = np.append(first[1:], len(at)) - 1
        lo, hi = x[first], x[last]
        c, s = np.repeat((lo + hi) / 2, last - first + 1), np.repeat((hi - lo) / 2, last - first + 1)
        u = np.divide(x - c, s, out=np.zeros_like(x), where=s > 0)
        out.append(_frame(level, block, lo, hi, _moments(u, w, first, POWERS_W), _moments(u, y, first, POWERS_Y)))
    return pd.concat(out, ignore_index=True)


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """The next 2**1 ... 2**TIER times longer blocks, from blocks of one level."""
    pdf = pdf.sort_values("_node")
    base, at = int(pdf["_level"].iloc[0]), pdf["_node"].to_numpy()
    c, s = pdf["_c"].to_numpy(float), pdf["_s"].to_numpy(float)
    a, b = np.array(list(pdf["_mw"]), float), np.array(list(pdf["_my"]), float)
    out = []
    for level in range(1, TIER + 1):
        block, first = np.unique(at >> level, return_index=True)
        size = np.diff(np.append(first, len(at)))
        lo, hi = (c - s)[first], (c + s)[first + size - 1]
        cc, ss = np.repeat((lo + hi) / 2, size), np.repeat((hi - lo) / 2, size)
        ok = ss > 0
        scale = np.divide(s, ss, out=np.zeros_like(s), where=ok)
        shift = np.divide(c - cc, ss, out=np.zeros_like(s), where=ok)
        out.append(_frame(base + level, block, lo, hi, np.add.reduceat(_shifted(a, scale, shift), first), np.add.reduceat(_shifted(b, scale, shift), first)))
    return pd.concat(out, ignore_index=True)


def _blocks(points: DataFrame, g: list[str], most: int) -> DataFrame:
    """Moments of all blocks: (group, _level, _node, _c: centre, _s: half width, _mw, _my)."""
    fields = [T.StructField("_level", T.IntegerType()), T.StructField("_node", T.LongType()), T.StructField("_c", T.DoubleType()), T.StructField("_s", T.DoubleType()),
              T.StructField("_mw", T.ArrayType(T.DoubleType())), T.StructField("_my", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*[points.schema[k] for k in g], *fields])

    def per_chunk(make):
        def run(key, pdf):
            out = make(pdf)
            for k, name in enumerate(g):
                out.insert(k, name, [key[k]] * len(out))
            return out
        return run

    level = cut_lineage(points.groupBy(*g, F.shiftright(F.col("_i") - 1, TIER).alias("_chunk")).applyInPandas(per_chunk(_leaves), schema))
    out, top = level, TIER
    while most >> top > 0:
        level = cut_lineage(level.filter(F.col("_level") == top).groupBy(*g, F.shiftright("_node", TIER).alias("_chunk")).applyInPandas(per_chunk(_joined), schema))
        out, top = out.unionByName(level), top + TIER
    return out


def _sums(batches):
    """Per (x, block) row the five weighted sums of the fit, about x in units of h."""
    for pdf in batches:
        left, h = pdf["_left"].to_numpy(bool), pdf["_h"].to_numpy(float)
        sign = np.where(left, -1.0, 1.0)
        a = np.divide(sign * (pdf["_c"] - pdf["_x"]).to_numpy(float), h, out=np.zeros_like(h), where=h > 0)
        b = np.divide(sign * pdf["_s"].to_numpy(float), h, out=np.zeros_like(h), where=h > 0)
        # sums of d**q, with d the distance from x in units of h
        w = _shifted(np.array(list(pdf["_mw"]), float).reshape(len(pdf), POWERS_W + 1), b, a)
        y = _shifted(np.array(list(pdf["_my"]), float).reshape(len(pdf), POWERS_Y + 1), b, a)

        def tricube(m, r):
            return m[:, r] - 3 * m[:, r + 3] + 3 * m[:, r + 6] - m[:, r + 9]

        keep = [c for c in pdf.columns if c not in ("_left", "_h", "_c", "_s", "_mw", "_my")]
        yield pdf[keep].assign(_s0=tricube(w, 0), _s1=sign * tricube(w, 1), _s2=tricube(w, 2), _y0=tricube(y, 0), _y1=sign * tricube(y, 1))


def loess(df: DataFrame, x: str, y: str, groupby: Sequence[str] | None = None,
          bandwidth: float = 0.3) -> DataFrame:
    """Local linear fit of y on x, one output row per group and distinct x.

    The neighbourhood holds the nearest points until they are ``bandwidth`` of the group's (two
    at least; of two equally near the left one first; equal x come together); distances count in
    units of its farthest point. No robustness iterations (our definition). Rows without x or y
    are left out."""
    g = [groupby] if isinstance(groupby, str) else list(groupby or [])
    base = df.select(*g, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna(subset=["_x", "_y"])
    points = base.groupBy(*g, "_x").agg(F.count(F.lit(1)).alias("_w"), F.sum("_y").alias("_sy"))
    points = cut_lineage(running(points, {"_i": ("row_number",), "_upto": ("sum", "_w")}, g, ["_x"]))
    total = points.groupBy(*g).agg(F.max("_upto").alias("_n"))
    need = F.least(F.col("_n"), F.ceil(F.greatest(F.lit(float(bandwidth)) * F.col("_n"), F.lit(2.0))))
    total = total.withColumn("_k", need.cast("double"))
    sized = join_on(points, total, g) if g else points.crossJoin(F.broadcast(total))  # one row without groups
    before = F.col("_upto") - F.col("_w")

    # the midpoints of the windows, at each place where one of their ends changes
    none = F.lit(None).cast("double")
    ends = sized.select(*g, "_n", "_k", before.alias("_at"), F.col("_x").alias("_a"), none.alias("_b")).unionByName(
        sized.select(*g, "_n", "_k", (before - F.col("_k")).alias("_at"), none.alias("_a"), F.col("_x").alias("_b")))
    ends = running(ends, {"_la": ("last", "_a"), "_lb": ("last", "_b")}, g, ["_at"])
    middle = ends.filter("_la IS NOT NULL AND _lb IS NOT NULL AND _at < _n - _k").select(
        *g, ((F.col("_la") + F.col("_lb")) / 2).alias("_x"), F.lit(1).alias("_side"), F.col("_at").alias("_start"))

    # every x among the midpoints: its window's first place
    asked = sized.select(*g, "_x", F.lit(0).alias("_side"), "_i", "_n", "_k")
    found = running(middle.unionByName(asked, allowMissingColumns=True), {"_first": ("last", "_start", "after")}, g, ["_x", "_side", "_start"])
    found = found.filter("_side = 0").select(*g, "_i", "_x", "_k", F.least(F.coalesce("_first", F.col("_n") - F.col("_k")), F.col("_n") - F.col("_k")).alias("_first"))

    # the window's first and last place among the x values
    values = points.select(*g, before.alias("_at"), F.lit(0).alias("_side"), F.struct("_i", "_x").alias("_v"))
    places = F.explode(F.array(F.struct(F.lit(1).alias("_side"), F.col("_first").alias("_at")), F.struct(F.lit(2).alias("_side"), (F.col("_first") + F.col("_k") - 1).alias("_at"))))
    asked = found.select(*g, F.struct("_i", "_x").alias("_of"), places.alias("_p")).select(*g, "_of", "_p._side", "_p._at")
    edges = running(values.unionByName(asked, allowMissingColumns=True), {"_e": ("last", "_v")}, g, ["_at", "_side"]).filter("_side > 0")
    edges = edges.groupBy(*g, "_of").agg(F.min(F.when(F.col("_side") == 1, F.col("_e"))).alias("_lo"), F.max(F.when(F.col("_side") == 2, F.col("_e"))).alias("_hi"))
    targets = edges.select(*g, F.col("_of._i").alias("_i"), F.col("_of._x").alias("_x"), (F.col("_lo._i") - 1).alias("_from"), F.col("_hi._i").alias("_to"),
                           F.greatest(F.col("_of._x") - F.col("_lo._x"), F.col("_hi._x") - F.col("_of._x")).alias("_h"))

    # its blocks on both sides; x itself counts to the right
    most = points.agg(F.max("_i")).first()[0] or 0

    def side(left: bool, a, b):
        def at(level):
            size = F.pow(F.lit(2.0), level)
            lo, hi = F.ceil(a / size), F.floor(b / size)
            odd = (lo < hi) & (F.pmod(lo, F.lit(2)) == 1), (lo < hi) & (F.pmod(hi, F.lit(2)) == 1)
            return F.array(*[F.struct(F.lit(left).alias("_left"), level.cast("int").alias("_level"), F.when(ok, n.cast("bigint")).alias("_node"))
                             for ok, n in zip(odd, (lo, hi - 1))])
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(most.bit_length())), at))

    nodes = F.concat(side(True, F.col("_from"), F.col("_i") - 1), side(False, F.col("_i") - 1, F.col("_to")))
    rows = targets.select(*g, "_i", "_x", "_h", F.explode(F.filter(nodes, lambda b: b["_node"].isNotNull())).alias("_b")).select(*g, "_i", "_x", "_h", "_b.*")
    parts = join_on(rows, _blocks(points, g, most), [*g, "_level", "_node"]).select(*g, "_i", "_x", "_left", "_h", "_c", "_s", "_mw", "_my")
    schema = T.StructType([*[parts.schema[c] for c in (*g, "_i", "_x")], *[T.StructField(c, T.DoubleType()) for c in ("_s0", "_s1", "_s2", "_y0", "_y1")]])
    fit = parts.mapInPandas(_sums, schema).groupBy(*g, "_i", "_x").agg(*[F.sum(c).alias(c) for c in ("_s0", "_s1", "_s2", "_y0", "_y1")])
    mean = F.col("_s1") / F.col("_s0")
    spread = F.col("_s2") - F.col("_s1") * mean
    slope = F.when(spread > 1e-13 * F.col("_s0"), (F.col("_y1") - mean * F.col("_y0")) / spread).otherwise(0.0)
    return fit.select(*g, F.col("_x").alias(x), (F.col("_y0") / F.col("_s0") - slope * mean).alias(y))
