"""Window transform for skewed or low-cardinality group keys (W1-W14, distributed).

``transforms.window`` uses Spark's window operator: right for many small groups,
but every group is processed by one task. This variant never needs a whole group
in one task:

* row numbers, and what a frame that reaches to its group's begin or end holds,
  come from one segmented scan (``scan.running``) over a range-partitioned sort;
* the numbered rows of a group are cut into blocks of ``block`` rows. A block also
  gets the few rows of its neighbours that frames and offsets reach into, so Spark's
  own window functions, run per (group, block), see every bounded frame whole: lag,
  lead, value ops and every aggregate op;
* peer groups (rows equal in the sort fields) are one aggregate row each, with
  their first and last row number, extremes, values and running sums. A frame widened
  to peers is its rows plus the peer groups of its first and its last row.

Rank ops keep the usual peer semantics; value and frame ops count rows with
``ignore_peers=True`` and widen to whole peer groups without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import AGG_OPS, agg_column
from .keys import join_on
from .ranking import ntile_from_row_number
from .scan import running

ADDITIVE = ("sum", "count", "valid", "missing", "mean", "average")
EXTREMES = ("min", "max")
RANKS = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")
VALUES = ("first_value", "last_value", "nth_value")
#: Rows of a block (more if a frame reaches farther).
BLOCK = 1 << 15


def _names(sort) -> list[str]:
    out = []
    for s in ([sort] if isinstance(sort, str) else list(sort)):
        if isinstance(s, tuple):
            out.append(s[0])
        else:
            out.append(s.lstrip("-"))
    return out


def _order(sort) -> list[Column]:
    out = []
    for s in ([sort] if isinstance(sort, str) else list(sort)):
        if isinstance(s, tuple):
            out.append(F.col(s[0]).desc() if s[1].startswith("desc") else F.col(s[0]).asc())
        elif s.startswith("-"):
            out.append(F.col(s[1:]).desc())
        else:
            out.append(F.col(s).asc())
    return out


def distributable(op: str, lo: int | None, hi: int | None, ignore_peers: bool) -> bool:
    """Whether an op over a frame has a distributed form."""
    if op in (*RANKS, "lag", "lead", *VALUES, *ADDITIVE, *EXTREMES):
        return True
    if op in ("exponential", "exponentialb"):
        return lo is None and hi == 0 and ignore_peers
    return ignore_peers and op in AGG_OPS and op not in ("ci0", "ci1") and lo is not None and hi is not None


def _counted(df: DataFrame, op: str, field: str | None) -> Column:
    """1 where a row counts for count, valid and missing, else null."""
    from .aggregates import _dtype, is_missing, is_valid
    if field is None:
        return F.lit(1)
    c, kind = F.col(field), _dtype(df, field)
    return F.when({"valid": is_valid, "missing": is_missing}.get(op, lambda x, _: x.isNotNull())(c, kind), 1)


def window_distributed(df: DataFrame, ops: dict[str, tuple], sort: Sequence, groupby: Sequence[str],
                       frame: tuple = (None, 0), tiebreak: Sequence[str] = (), ignore_peers: bool = True,
                       block: int = BLOCK) -> DataFrame:
    """``ops`` values are (op, field, param[, frame]); an op's own frame overrides
    ``frame``. One range-partitioned sort, checkpointed, feeds everything else."""
    g, keys = list(groupby), _names(sort)
    cols = list(df.columns)
    specs = {name: (s[0], s[1] if len(s) > 1 else None, s[2] if len(s) > 2 else None, *(s[3] if len(s) > 3 else frame)) for name, s in ops.items()}
    for name, (op, _, _, lo, hi) in specs.items():
        if not distributable(op, lo, hi, ignore_peers):
            raise ValueError(f"op {op!r} of {name!r} has no distributed form for this frame")
    framed = {n: x for n, x in specs.items() if x[0] not in (*RANKS, "lag", "lead")}
    scans: dict[str, tuple] = {"_rn": ("row_number",)}
    inner: list[Column] = []  # columns that the scans read
    for i, (op, field, param, lo, hi) in enumerate(framed.values()):
        sums = op in ADDITIVE and (not ignore_peers or lo is None or hi is None)
        if sums:
            # the running count and sum; NaN and the infinities are counted apart, as a
            # difference of running sums could not take them back
            inner.append(_counted(df, op, field).alias(f"_x{i}_c"))
            scans[f"_s{i}_c"] = ("count", f"_x{i}_c")
            if op in ("sum", "mean", "average"):
                v = F.col(field).cast("double")
                odd = {"n": F.isnan(v), "p": v == float("inf"), "m": v == float("-inf")}
                inner += [F.when(~(odd["n"] | odd["p"] | odd["m"]), v).alias(f"_x{i}_s"), *[F.when(o, 1).alias(f"_x{i}_{k}") for k, o in odd.items()]]
                scans |= {f"_s{i}_s": ("sum", f"_x{i}_s")} | {f"_s{i}_{k}": ("count", f"_x{i}_{k}") for k in odd}
        elif op in EXTREMES:
            if lo is None:
                scans[f"_s{i}_b"] = (op, field)
            if hi is None:
                scans[f"_s{i}_a"] = (op, field, "after")
        elif op in ("exponential", "exponentialb"):
            v = F.col(field).cast("double")
            inner.append(F.when(~F.isnan(v), v).alias(f"_x{i}"))
            scans |= {f"_s{i}_d": ("decayed", f"_x{i}", 0.5 if param is None else param), f"_s{i}_k": ("count", f"_x{i}"), f"_s{i}_f": ("first", f"_x{i}")}
        elif (op == "first_value" and lo is None) or (op == "last_value" and hi is None):
            # the group's first or last row, whatever its value
            inner.append(F.struct(field).alias(f"_x{i}"))
            scans[f"_s{i}"] = ("first", f"_x{i}") if op == "first_value" else ("first", f"_x{i}", "after")
    base = running(df.select("*", *inner), scans, g, _order(sort) + _order(list(tiebreak)))

    need_size = any(x[0] in ("percent_rank", "cume_dist", "ntile") for x in specs.values())
    totals = [i for i, (op, _, _, lo, hi) in enumerate(framed.values()) if op in ADDITIVE and hi is None]
    if need_size or totals:
        sizes = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), *[F.max_by(c, "_rn").alias(f"_all{c}") for i in totals for c in _sums(scans, i)])
        t = join_on(base, sizes, g) if g else base.crossJoin(F.broadcast(sizes))  # one row without groups
    else:
        t = base
    if any(x[0] in ("rank", "dense_rank", "percent_rank", "cume_dist") for x in specs.values()) or (framed and not ignore_peers):
        t = _with_peers(t, base, specs, framed, scans, g, keys, sort, ignore_peers)

    back = max([0, *[-lo for *_, lo, hi in framed.values() if lo is not None], *[-hi for *_, lo, hi in framed.values() if hi is not None],
                *[int(x[2] or 1) for x in specs.values() if x[0] == "lag"]])
    ahead = max([0, *[hi for *_, lo, hi in framed.values() if hi is not None], *[lo for *_, lo, hi in framed.values() if lo is not None],
                 *[int(x[2] or 1) for x in specs.values() if x[0] == "lead"]])
    size = max(block, back, ahead, 1)
    own = F.floor((F.col("_rn") - 1) / size)
    at = F.pmod(F.col("_rn") - 1, F.lit(size))
    blocks = F.array(own, F.when(at >= size - back, own + 1) if back else F.lit(None), F.when(at < ahead, own - 1) if ahead else F.lit(None))
    t = t.withColumn("_block", F.explode(F.array_compact(blocks)))
    w = Window.partitionBy(*g, "_block").orderBy("_rn")
    down = Window.partitionBy(*g, "_block").orderBy(F.desc("_rn"))
    out, lookups = [], []
    place = {n: i for i, n in enumerate(framed)}
    for name, spec in specs.items():
        op, field, param, lo, hi = spec
        if op in RANKS:
            rn, n, p0, p1 = (F.col(c) for c in ("_rn", "_n", "_p0", "_p1"))
            out.append({"row_number": lambda: rn, "rank": lambda: p0.cast("int"), "dense_rank": lambda: F.col("_dense").cast("int"),
                        "percent_rank": lambda: F.when(n > 1, (p0 - 1) / (n - 1)).otherwise(F.lit(0.0)), "cume_dist": lambda: p1 / n,
                        "ntile": lambda: ntile_from_row_number(rn, n, int(param or 1))}[op]().alias(name))
        elif op in ("lag", "lead"):
            out.append((F.lag if op == "lag" else F.lead)(field, int(param or 1)).over(w).alias(name))
        else:
            if hi is None and lo is not None:
                # Spark goes through all that follows for every row of a frame without end; read
                # from the end, the frame has no begin and grows row by row
                rows = down.rowsBetween(Window.unboundedPreceding, -lo)
            else:
                rows = w.rowsBetween(Window.unboundedPreceding if lo is None else lo, Window.unboundedFollowing if hi is None else hi)
            if op == "nth_value" and not (ignore_peers and lo is not None and hi is not None):
                # the number of the row that is wanted; its value is looked up behind
                e0 = F.lit(1) if lo is None else (F.last if hi is None else F.first)("_rn" if ignore_peers else "_p0").over(rows)
                e1 = F.last("_rn" if ignore_peers else "_p1").over(rows) if hi is not None else F.lit(None)
                target = e0 + int(param or 1) - 1
                out.append((target if hi is None else F.when(target <= e1, target)).alias(name))
                lookups.append((name, field))
            else:
                out.append(_frame_value(df, place[name], spec, rows, scans, ignore_peers).alias(name))
    keep = [*cols, *(["_rn"] if lookups else [])]
    t = t.select(*keep, "_block", own.alias("_own"), *out).filter("_block = _own")
    for name, field in lookups:
        src = base.select(*[F.col(k).alias(f"_lk{j}") for j, k in enumerate(g)], F.col("_rn").alias("_at"), F.col(field).alias("_found"))
        cond = [F.col(k).eqNullSafe(F.col(f"_lk{j}")) for j, k in enumerate(g)] + [F.col(name) == F.col("_at")]
        t = t.join(src, cond, "left").withColumn(name, F.col("_found")).drop("_at", "_found", *[f"_lk{j}" for j in range(len(g))])
    return t.select(*cols, *ops)


def _sums(scans: dict, i: int) -> list[str]:
    return [f"_s{i}_{k}" for k in "csnpm" if f"_s{i}_{k}" in scans]


def _with_peers(t: DataFrame, base: DataFrame, specs: dict, framed: dict, scans: dict, g: list, keys: list, sort, ignore_peers: bool) -> DataFrame:
    """``t`` with what its rows' peer groups hold."""
    held = [F.min("_rn").alias("_p0"), F.max("_rn").alias("_p1")]
    if not ignore_peers:
        for i, (op, field, _, lo, hi) in enumerate(framed.values()):
            if op in ADDITIVE:
                for c in _sums(scans, i):
                    x = f"_x{i}_{c[-1]}"
                    one = F.coalesce(F.col(x), F.lit(0)) if c[-1] == "s" else F.when(F.col(x).isNotNull(), 1).otherwise(0)
                    held += [F.max_by(c, "_rn").alias(f"_e{c}"), F.min_by(F.coalesce(F.col(c), F.lit(0)) - one, "_rn").alias(f"_b{c}")]
            elif op in EXTREMES:
                held.append((F.min if op == "min" else F.max)(field).alias(f"_x{i}_p"))
                held += [F.max_by(f"_s{i}_b", "_rn").alias(f"_e{i}")] if lo is None else []
                held += [F.min_by(f"_s{i}_a", "_rn").alias(f"_b{i}")] if hi is None else []
            elif op in ("first_value", "last_value"):
                held.append((F.min_by if op == "first_value" else F.max_by)(F.struct(field), "_rn").alias(f"_x{i}_p"))
    peers = base.groupBy(*g, *[k for k in keys if k not in g]).agg(*held)
    if any(x[0] == "dense_rank" for x in specs.values()):
        peers = running(peers, {"_dense": ("row_number",)}, g, _order(sort))
    return join_on(t, peers, list(dict.fromkeys([*g, *keys])))


def _frame_value(df: DataFrame, i: int, spec: tuple, rows, scans: dict, ignore_peers: bool) -> Column:
    """The value of op ``i`` over its frame, ``rows`` being the frame within the block, read from
    its end if it has a begin and no end."""
    op, field, param, lo, hi = spec

    def first(c):
        return (F.last if hi is None and lo is not None else F.first)(c).over(rows)

    def last(c):
        return F.last(c).over(rows)

    if op in ("exponential", "exponentialb"):
        weight = F.pow(F.lit(1 - (0.5 if param is None else float(param))), F.col(f"_s{i}_k").cast("double"))
        if op == "exponential":
            return F.col(f"_s{i}_d") + weight * F.col(f"_s{i}_f")
        return F.try_divide(F.col(f"_s{i}_d"), 1 - weight)
    if op in ADDITIVE and f"_s{i}_c" in scans:
        some = F.count(F.lit(1)).over(rows) > 0
        parts = {}
        for c in _sums(scans, i):
            up = F.col(f"_all{c}") if hi is None else last(c if ignore_peers else f"_e{c}")
            x = f"_x{i}_{c[-1]}"
            if lo is None:
                down = F.lit(0)
            elif ignore_peers:
                down = first(F.coalesce(F.col(c), F.lit(0)) - (F.coalesce(F.col(x), F.lit(0)) if c[-1] == "s" else F.when(F.col(x).isNotNull(), 1).otherwise(0)))
            else:
                down = first(f"_b{c}")
            parts[c[-1]] = F.when(some, F.coalesce(up, F.lit(0)) - F.coalesce(down, F.lit(0))).otherwise(0)
        if op not in ("sum", "mean", "average"):
            return parts["c"].cast("bigint")
        total = (F.when((parts["n"] > 0) | ((parts["p"] > 0) & (parts["m"] > 0)), float("nan"))
                 .when(parts["p"] > 0, float("inf")).when(parts["m"] > 0, float("-inf")).otherwise(parts["s"]))
        # a frame without values has neither sum nor mean
        return F.when(parts["c"] > 0, total if op == "sum" else total / parts["c"].cast("double"))
    if op in EXTREMES:
        pick = F.least if op == "min" else F.greatest
        if lo is None and hi is None:
            # the whole group: what stands before a row and what stands behind
            return pick(F.col(f"_s{i}_b"), F.col(f"_s{i}_a"))
        if lo is None:
            return last(f"_s{i}_b" if ignore_peers else f"_e{i}")
        if hi is None:
            return first(f"_s{i}_a" if ignore_peers else f"_b{i}")
        inside = (F.min if op == "min" else F.max)(field).over(rows)
        return inside if ignore_peers else pick(inside, first(f"_x{i}_p"), last(f"_x{i}_p"))
    if op in ("first_value", "last_value"):
        at_edge = lo is None if op == "first_value" else hi is None
        if not ignore_peers and not at_edge:
            return (first if op == "first_value" else last)(f"_x{i}_p")[field]
        if not at_edge:
            return (first if op == "first_value" else last)(field)
        return F.when(F.count(F.lit(1)).over(rows) > 0, F.col(f"_s{i}")[field])
    if op == "nth_value":
        return F.nth_value(field, int(param or 1)).over(rows)
    if op == "sum":
        return F.sum(F.col(field).cast("double")).over(rows)
    if op == "count" and field is not None:
        return F.count(field).over(rows)
    return agg_column(op, field, df).over(rows)
