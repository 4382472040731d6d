"""Periodic runs of words, by a sparse dynamic programme over the diagonals of a text.

Cell (i, d) holds for how many words up to word ``i`` every word has equalled the one ``d`` words
before it: one more than cell (i - 1, d) if words ``i`` and ``i - d`` are equal, else nothing. Only
earlier occurrences of a word make cells, and the lag ``d`` is their diagonal. A diagonal that ends
after ``m >= d`` equal words is a stretch of ``m + d`` words of period ``d``; the smallest lag that
gives a stretch is its period, and the stretch is a run as soon as the diagonal ends.

All pairs of earlier occurrences of one frequent word would grow with its square. But a diagonal of
lag ``d`` counts only if it holds ``d`` equal words, so a cell of lag ``g <= d < 2g`` is opened only
where the whole block of the next ``g`` words has occurred at that lag. Blocks are named by rank,
each of ``2g`` words from the two names of ``g`` (exact, no fingerprints), and only blocks that
occur again in their text are carried on. A block of period ``q <= g / 2`` lies in one known run;
its cells within that run only repeat the run, and a diagonal from one such run into another enters
where one of them begins, so of these blocks only the first of each run opens cells. Occurrences of
any other block are more than ``g / 2`` words apart, so at most three of them lie within the lags at
hand. Cells thus stay within words times the logarithm of the longest text, also in texts of one word.

A text is worked on in one piece, in one task, and needs some 150 bytes a word; texts are handled
one Arrow batch after the other, without a shuffle.

Defined cases: a null text has no words, no runs, and stays null when collapsed; an empty or blank
text collapses to an empty one; ids are not looked at, so repeated rows and null ids are rows like
all others; columns named like a new one are replaced, all others are kept; an empty table gives an
empty table.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import free_name, prepare, table

#: Fewest words of a run, and words that are worked on together (more if one text has more).
LEAST, TOGETHER = 12, 1 << 16
#: Lags below this are compared word by word; blocks start at this length.
FIRST_BLOCK = 8

RUN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False), T.StructField("period", T.LongType(), False)])
_RUN = pa.struct([pa.field("start", pa.int64(), False), pa.field("length", pa.int64(), False), pa.field("period", pa.int64(), False)])


def _stretches(w: np.ndarray, d: int, least: int) -> np.ndarray:
    """Rows (start, end, d) of the diagonal of lag ``d``, word by word."""
    same = np.zeros(len(w) - d + 2, np.int8)
    same[1:-1] = w[d:] == w[:-d]
    turn = np.diff(same)
    lo, hi = np.flatnonzero(turn > 0), np.flatnonzero(turn < 0)
    long = hi - lo >= max(d, least - d)
    return np.column_stack([lo[long], hi[long] + d, np.full(long.sum(), d)])


def _zones(g: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the blocks of ``g`` words inside each run of period up to ``g / 2``,
    by place. A block lies in one such run at most, so the zones are disjoint."""
    runs = runs[(2 * runs[:, 2] <= g) & (runs[:, 1] - runs[:, 0] >= g)]
    lo, first = np.unique(runs[:, 0], return_index=True)
    return lo, runs[first, 1] - g


def _cells(name: np.ndarray, g: int, zones: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Cells (i, d) with g <= d < 2g whose block of ``g`` words occurred ``d`` words before, sorted
    by lag, then word: all of blocks outside zones, and of those inside the ones where a zone begins."""
    n = len(name)
    lo, hi = zones
    edge = np.zeros(n + 1, np.int64)
    edge[lo] += 1
    np.add.at(edge, hi + 1, -1)
    zone = np.where(np.cumsum(edge[:n]) > 0, np.cumsum(np.bincount(lo, minlength=n)[:n]), 0)
    every = np.flatnonzero(name >= 0)
    every = every[np.argsort(name[every], kind="stable")]
    at = every[zone[every] == 0]
    kind = name[at]
    here, lag, s = [at[:0]], [at[:0]], 1
    while s < len(at):
        d = np.where(kind[s:] == kind[:-s], at[s:] - at[:-s], 2 * g)
        if not (d < 2 * g).any():
            break
        ok = (d >= g) & (d < 2 * g)
        here.append(at[s:][ok])
        lag.append(d[ok])
        s += 1
    # where a zone begins: the same block in other zones, on both sides
    at = every[zone[every] > 0]
    start = lo[name[lo] >= 0]
    if len(start):
        key = name[at].astype(np.int64) * (4 * n) + at
        for a, b in ((start - 2 * g + 1, start - g), (start + g, start + 2 * g - 1)):
            base = name[start].astype(np.int64) * (4 * n)
            first = np.searchsorted(key, base + np.maximum(a, 0))
            many = np.maximum(np.searchsorted(key, base + b, "right") - first, 0)
            many[b < 0] = 0
            own = np.repeat(start, many)
            other = at[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
            ok = zone[own] != zone[other]
            here.append(np.maximum(own, other)[ok])
            lag.append(np.abs(own - other)[ok])
    both = np.unique(np.concatenate(lag) * n + np.concatenate(here)) if n else np.zeros(0, np.int64)
    return both % max(n, 1), both // max(n, 1)


def _extended(names: list[tuple[int, np.ndarray]], lo: np.ndarray, hi: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The diagonals' matched words ``lo:hi`` carried on to both ends by the named blocks, longest
    blocks first (as often as they fit), shorter ones once."""
    n = len(names[0][1])
    top = names[-1][0]
    for g, name in reversed(names):
        for side in (1, -1):
            todo = np.arange(len(d))
            while len(todo):
                at = hi[todo] if side > 0 else lo[todo] - g
                ok = (at + g <= n) & (at - d[todo] >= 0)
                todo, at = todo[ok], at[ok]
                a = name[at]
                ok = (a >= 0) & (a == name[at - d[todo]])
                todo = todo[ok]
                if side > 0:
                    hi[todo] += g
                else:
                    lo[todo] -= g
                if g != top:
                    break
    return lo, hi


def find_runs(w: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period), by start and period, of the maximal stretches of smallest period
    q and at least max(least, 2q) of the numbers ``w``."""
    n = len(w)
    short = min(least, FIRST_BLOCK)
    found = [np.zeros((0, 3), np.int64)] + [_stretches(w, d, short) for d in range(1, min(FIRST_BLOCK, n))]
    names = [(1, w)]
    while len(names[-1][1]) and 2 * names[-1][0] <= n:
        g, name = names[-1]
        at = np.flatnonzero(name[:-g] >= 0)
        at = at[name[at + g] >= 0]
        if not len(at):
            break
        key, count = np.unique(name[at].astype(np.int64) * (int(name.max()) + 1) + name[at + g], return_inverse=True, return_counts=True)[1:]
        again = count[key] > 1
        if not again.any():
            break
        longer = np.full(n, -1, np.int32)
        longer[at[again]] = key[again]
        g *= 2
        names.append((g, longer))
        if g >= FIRST_BLOCK:
            i, d = _cells(longer, g, _zones(g, np.concatenate(found)))
            if len(i):
                # neighbouring cells of a diagonal are one piece of it
                new = np.concatenate([[True], (np.diff(d) != 0) | (np.diff(i) != 1)])
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(i)]]) - 1
                lo, hi = _extended(names, i[first].copy(), i[last] + g, d[first])
                ends = hi - lo >= d[first]
                found.append(np.column_stack([(lo - d[first])[ends], hi[ends], d[first][ends]]))
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # of the lags of one stretch the smallest is its period
    keep = np.ones(len(runs), bool)
    keep[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[keep]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _texts_runs(texts: list[bytes | None], least: int) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Per text its runs (start, length, period) and its words without the repeats."""
    runs: list[np.ndarray] = []
    out: list[bytes | None] = []
    k = 0
    while k < len(texts):
        parts, ids, ends = [], [], [0]
        while k < len(texts) and (not parts or len(ids) < TOGETHER):
            words = (texts[k] or b"").split()  # at bytes 0x20 and 0x09-0x0D
            base, seen = len(ids), {}
            # names of their own per text, so that no cell joins two texts
            ids.extend([base + seen.setdefault(x, len(seen)) for x in words])
            parts.append((texts[k] is None, words))
            ends.append(len(ids))
            k += 1
        got = find_runs(np.array(ids, np.int32), least)
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, got[:, 0] + got[:, 2], 1)
        np.add.at(edge, got[:, 1], -1)
        kept = np.cumsum(edge[:-1]) == 0
        bounds = np.searchsorted(got[:, 0], ends)
        for j, (none, words) in enumerate(parts):
            mine = got[bounds[j]:bounds[j + 1]]
            runs.append(np.column_stack([mine[:, 0] - ends[j], mine[:, 1] - mine[:, 0], mine[:, 2]]))
            out.append(None if none else b" ".join(words if not len(mine) else compress(words, kept[ends[j]:ends[j + 1]])))
    return runs, out


def periodic_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", least: int = LEAST) -> DataFrame:
    """``df`` with two more columns: the text's runs (start, length, period: words) by start and
    period, and its words joined by one space without those that a run repeats."""
    prepare(df.sparkSession)
    new = [runs, collapsed]
    keep = [c for c in df.columns if c not in new]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(free_name(df, "__text")))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(runs, T.ArrayType(RUN, False)), T.StructField(collapsed, T.StringType())])

    def run(batches):
        for b in batches:
            found, left = _texts_runs(b.column(len(keep)).cast(pa.large_binary()).to_pylist(), least)
            sizes = np.array([0, *[len(r) for r in found]])
            flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
            structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), structs)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], lists, pa.array(left, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text that the query looks at: with h = crc32(id), g = h // 10, one text in ten (h % 10 =
    0) goes on from word a = g % n with the p = 1 + (n - a) // (3 + g % 8) words that stand there,
    over and over."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    # one element, so that the words are made once for all their uses
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(text)), 0)
    return F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs: their number, the longest one, and digests of all and of what is left."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    got = periodic_runs(docs).withColumn("top", F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    all_runs = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    length = -F.col("top.less")
    return got.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("top.start").alias("start"), length.alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * length / F.col("top.period")).alias("exponent_milli"), F.sha2(all_runs, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE: dict[str, str] = {}
