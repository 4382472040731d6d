"""Line deduplication within an edit bound by deletion neighbourhoods.

Two lines are near if one becomes the other by at most ``MAX_EDITS`` (one) insertion, deletion or
replacement of a character. Deleting one character of each of two near lines, or of none, gives a
common variant. All variants of a line are emitted as hashed keys, equal keys are joined, and the
edit distance of the pairs is verified on the lines themselves. A line is removed if an equal or
near line stands earlier: in a document of smaller id, or further up in the same one.

Equal lines are one line from the start, whatever their number: an aggregate finds the earliest
place of every distinct line. Variants are needed only for lines that can have a near line at all.
By the pigeonhole, two lines one edit apart agree in all of one half, so lines are first keyed by
the hashes of their halves (for their own length and for one character less); a line that shares
no such key with a different line is near no other, and no variant of it leaves its task. Different lines
that share one variant are at most as many as there are ways to put one character into it, so the
lists that are joined stay short however often the lines occur.

A removed line is always judged on the input, so the result does not depend on an order of work.
Lines shorter than ``SHORT`` characters are compared for equality only: one edit would join unlike
words. Blank lines stay.

Defined cases: a null text stays null and has no lines; an empty text has none to lose; rows that
repeat an id are told apart by their text, equal rows are kept all alike, each judged as the id's
lines; a row with a null id is a document of its own behind all others, and such rows are ordered by
their texts' digests; ids are integers or strings; an empty table gives an empty table. All columns of the
table are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut, free_name, likely_rows, own_ids, prepare, release, table

#: Edits between near lines, and characters of the shortest line that is compared by edits.
MAX_EDITS, SHORT = 1, 12


def _lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def _half_keys(line: str) -> list[int]:
    """Keys of which two lines one edit apart share one: the first and the last half of the shorter
    of the two lengths, with that length and the side."""
    out = []
    for n in (len(line), len(line) - 1):
        h = n // 2
        out.append(xxhash.xxh64_intdigest(f"{n}<{line[:h]}"))
        out.append(xxhash.xxh64_intdigest(f"{n}>{line[len(line) - h:]}"))
    return out


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def _line_rows(rows: DataFrame, with_keys: bool = True) -> DataFrame:
    """(id, k: line number, h1, h2: hash of the line, keys of its halves) of all lines but blank
    ones; a line's repeats within its document are left to ``rebuilt``."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                at, k, h1, h2, keys = [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    seen = set()
                    for n, line in enumerate(_lines(text.as_py())):
                        if line.strip() and line not in seen:
                            seen.add(line)
                            d = xxhash.xxh128_intdigest(line.encode())
                            at.append(i)
                            k.append(n)
                            h1.append(d >> 64)
                            h2.append(d & (1 << 64) - 1)
                            keys.append(np.array(_half_keys(line), np.uint64).view(np.int64) if with_keys and len(line) >= SHORT else None)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int32())), pa.array(k, pa.int32()), _signed(h1), _signed(h2),
                                                  pa.array(keys, pa.list_(pa.int64()))], names=["id", "k", "h1", "h2", "keys"])
        release()

    return rows.mapInArrow(run, f"id {kind}, k int, h1 bigint, h2 bigint, keys array<bigint>")


def _with_lines(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, line) of the wanted lines, read at their earliest place (id, k)."""
    per = wanted.groupBy("id").agg(F.collect_list(F.struct("k", "h1", "h2")).alias("at"))
    both = likely_rows(rows, per).join(per, "id").select("text", "at")

    def run(batches):
        for b in batches:
            h1, h2, found = [], [], []
            for text, at in zip(b.column(0), b.column(1)):
                lines = _lines(text.as_py())
                for a in at.as_py():
                    if a["k"] < len(lines) and _halves(lines[a["k"]]) == (a["h1"], a["h2"]):
                        h1.append(a["h1"])
                        h2.append(a["h2"])
                        found.append(lines[a["k"]])
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(found, pa.string())], names=["h1", "h2", "line"])
        release()

    return both.mapInArrow(run, "h1 bigint, h2 bigint, line string")


def _variants(lines: DataFrame) -> DataFrame:
    """(v: hashed key, h1, h2, n) of every variant of every line: the line itself, and the line
    without one of its characters."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                line = b.column(2)[i].as_py()
                keys = {xxhash.xxh64_intdigest(line)} | {xxhash.xxh64_intdigest(line[:j] + line[j + 1:]) for j in range(len(line))}
                n = len(keys)
                yield pa.RecordBatch.from_arrays([_signed(sorted(keys)), pa.array([b.column(0)[i].as_py()] * n, pa.int64()),
                                                  pa.array([b.column(1)[i].as_py()] * n, pa.int64())], names=["v", "h1", "h2"])
        release()

    return lines.mapInArrow(run, "v bigint, h1 bigint, h2 bigint")


def near_lines(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines to which an earlier line is near: ``firsts`` has the earliest
    place (id, k) and half keys of every distinct line."""
    places = firsts.select("h1", "h2", "id", "k")
    halves = firsts.select("h1", "h2", F.explode("keys").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("l"), F.max("h1").alias("h")).filter("l <> h").select("key")
    some = cut(halves.join(shared, "key").select("h1", "h2").distinct().join(places, ["h1", "h2"]))
    lines = cut(_with_lines(rows, some).dropDuplicates(["h1", "h2"]))
    variants = _variants(lines)
    # each variant's earliest line and the others: only keys of two lines or more
    many = variants.groupBy("v").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("v")
    kept = cut(variants.join(many, "v"))
    pairs = (kept.join(kept.select("v", F.col("h1").alias("g1"), F.col("h2").alias("g2")), "v")
             .filter("h1 < g1 OR (h1 = g1 AND h2 < g2)").select("h1", "h2", "g1", "g2").distinct())
    text = lines.select("h1", "h2", "line")
    other = lines.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("line").alias("line2"))
    close = pairs.join(text, ["h1", "h2"]).join(other, ["g1", "g2"]).filter(F.levenshtein("line", "line2", MAX_EDITS) >= 0)
    here = some.select("h1", "h2", F.col("id").alias("ia"), F.col("k").alias("ka"))
    there = some.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("id").alias("ib"), F.col("k").alias("kb"))
    placed = close.select("h1", "h2", "g1", "g2").join(here, ["h1", "h2"]).join(there, ["g1", "g2"])
    earlier = F.struct("ia", "ka") < F.struct("ib", "kb")
    return placed.select(F.when(earlier, F.struct(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("ia").alias("i0"), F.col("ka").alias("k0")))
                         .otherwise(F.struct("h1", "h2", F.col("ib").alias("i0"), F.col("kb").alias("k0"))).alias("x")) \
        .select("x.*").groupBy("h1", "h2").agg(F.min(F.struct("i0", "k0")).alias("near"))


def line_dedup(df: DataFrame, id_column: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``df`` with the lines removed from its texts, and two more columns (of the names ``counts``,
    replacing columns of these names): lines of the input and lines removed."""
    prepare(df.sparkSession)
    key, other, lost = (free_name(df, c) for c in ("__own", "__id", "__gone"))
    own = own_ids(df, key, id_column, text)
    rows = own.select(F.col(key).alias("id"), F.col(text).alias("text"))
    lines = _line_rows(rows)
    # the earliest place of every distinct line; equal rows of an id share their lines
    first = lines.groupBy("h1", "h2", "id").agg(F.min("k").alias("k"), F.first("keys").alias("keys"))
    places = cut(first.groupBy("h1", "h2").agg(F.min(F.struct("id", "k")).alias("p"), F.count(F.lit(1)).alias("docs"), F.first("keys").alias("keys"))
                 .select("h1", "h2", "p.id", "p.k", "docs", "keys"))
    near = cut(near_lines(rows, places.filter("keys IS NOT NULL")))
    # lines with an equal or near line before them somewhere: where the first allowed place is
    base = places.select("h1", "h2", "id", "k", "docs").join(near, ["h1", "h2"], "left")
    verdict = cut(base.filter("docs > 1 OR near IS NOT NULL").select(
        "h1", "h2", F.least(F.struct(F.col("id").alias("i0"), F.col("k").alias("k0")), F.coalesce("near", F.struct(F.col("id").alias("i0"), F.col("k").alias("k0")))).alias("near")))
    hit = _line_rows(rows, with_keys=False).select("id", "k", "h1", "h2").join(verdict, ["h1", "h2"])
    gone = hit.filter(F.col("near") < F.struct(F.col("id").alias("i0"), F.col("k").alias("k0"))).select("id", "k", "h1")
    per = gone.groupBy(F.col("id").alias(other)).agg(F.collect_set(F.struct("k", "h1")).alias(lost))
    joined = own.join(per, own[key] == per[other], "left").drop(other, key)
    return _rebuilt(joined, text, df, counts, lost)


def _rebuilt(joined: DataFrame, text: str, df: DataFrame, counts: tuple[str, str], lost: str) -> DataFrame:
    """Texts without the lines in the column ``lost`` and without their own repeats."""
    keep = [c for c in df.columns if c not in counts]
    joined = joined.select(*keep, lost)
    at = keep.index(text)
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in counts]])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts, n, cut_away = [], [], []
                for t, gone in zip(part.column(at), part.column(len(keep))):
                    t = t.as_py()
                    lines = _lines(t)
                    drop = {(g["k"], g["h1"]) for g in gone.as_py() or ()}
                    seen, out = set(), []
                    for k, line in enumerate(lines):
                        if line.strip():
                            if line in seen:
                                continue
                            seen.add(line)
                            if drop and (k, _halves(line)[0]) in drop:
                                continue
                        out.append(line)
                    texts.append("\n".join(out) if lines else t)
                    n.append(len(lines))
                    cut_away.append(len(lines) - len(out))
                cols = [*part.columns[:at], pa.array(texts, b.schema.field(at).type), *part.columns[at + 1:len(keep)]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(cut_away, pa.int64())], names=schema.names)
        release()

    return joined.mapInArrow(run, schema)


def _halves(line: str) -> tuple[int, int]:
    """The two signed halves of a line's 128-bit hash."""
    d = xxhash.xxh128_intdigest(line.encode())
    return tuple(h - (1 << 64) if h >> 63 else h for h in (d >> 64, d & (1 << 64) - 1))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines deduplicated: (doc_id, n_lines, n_removed, text)."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLE: dict[str, str] = {}
