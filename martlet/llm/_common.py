"""Helpers shared by the operators of this subpackage.

Text kernels work on the UTF-8 bytes of Arrow batches with numpy, a bounded number of bytes at a
time, so that a task's memory depends neither on the batch nor on the corpus. Fixed-size bitmaps
stand in for semi-joins on a scan (an exact join always follows): their size is a constant, so
they may be broadcast at any input size.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package

#: Bytes of text that a numpy kernel handles at once.
CHUNK_BYTES = 1 << 19
#: Bits of a scan bitmap (4 MB).
BITMAP_BITS = 25
#: Rows of an Arrow batch where the session has Spark's default: documents are long rows.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder of the session, Arrow batches of moderate size, and the package for the
    Python workers."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows are written once to the shared checkpoint folder. What was
    shuffled for them is then of no use; Spark drops it when the driver collects its garbage, which
    is asked for here, so that the disks hold one step's shuffles and not all."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return out


def drop(df: DataFrame) -> None:
    """Delete the files of a checkpoint from ``cut`` that nothing reads any more."""
    spark = df.sparkSession
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        _remove(spark, file.get())


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as a Parquet table in the checkpoint folder: for many narrow rows it takes
    a fraction of a checkpoint's room. The table goes when the driver's Python ends."""
    spark, schema = df.sparkSession, df.schema
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release() -> None:
    """Give a worker's freed memory, Arrow's too, back to the system: the worker stays for the tasks that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows ``lo:hi`` with the bytes of their texts (null: none) and their offsets."""
    col = batch.column(column).cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    n = len(col)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


# --- fingerprints -----------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * CHUNK_BYTES)
            one = np.ones(1, np.uint64)
            cls.up = np.cumprod(np.concatenate([one, np.full(size - 1, _BASE)]), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate([one, np.full(size - 1, _INVERSE)]), dtype=np.uint64)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span`` turns them into fingerprints of any substring."""
    up, _ = _Powers.get(len(values) + 1)
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * up[:len(values)], dtype=np.uint64, out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprint (not yet mixed) of the values ``start:end``, independent of where they stand."""
    _, down = _Powers.get(len(sums))
    return (sums[end] - sums[start]) * down[start]


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(_BYTE_VALUE[data])


def words(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than space and 0x09-0x0D: (document, start, end, 64-bit hash) per word,
    A-Z lower-cased; a word never crosses a document's end."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    inside = ~WHITE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offs[:-1]] = True
    before = np.concatenate([[False], inside[:-1]]) & ~breaks[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~breaks[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    sums = byte_sums(_LOWER[data] if lower else data)
    h = mix(span(sums, start, end) + (end - start).astype(np.uint64))
    doc = np.searchsorted(offs, start, "right") - 1
    return doc, start, end, h


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of a sequence of equally long hash columns."""
    h = np.full(len(parts[0]), 0x51ED270B9F3A2D17 + len(parts), np.uint64)
    for p in parts:
        h = mix(h * _BASE + p)
    return h


# --- fixed-size bitmaps over hashed keys ------------------------------------------------------

def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of 2**bits bits with the top bits of every 64-bit hash in ``column`` set. Its size
    is fixed; a full one only lets more rows through to the exact join that follows."""
    at = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = (keys.select(F.shiftright(at, 5).alias("w"), F.expr("1L").alias("one"), at.bitwiseAND(F.lit(31)).cast("int").alias("b"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("v")))
    got = rows.toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy().astype(np.uint32)
    return out


def in_bitmap(bm: np.ndarray, h: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    at = h.view(np.uint64) >> np.uint64(64 - bits)
    return (bm[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def split_rows(rows: DataFrame, wanted: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are probably in ``wanted``: all that are, and few others; all other rows).
    The first are what a join with ``wanted`` has to shuffle."""
    some = rows.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64(*keys).alias("h")), "h"))
    n = len(rows.columns)

    def part(inside: bool):
        def run(batches):
            for b in batches:
                hit = in_bitmap(some.value, b.column(n).to_numpy())
                yield pa.RecordBatch.from_arrays(b.columns[:n], names=b.schema.names[:n]).filter(pa.array(hit == inside))
        return rows.withColumn(free_name(rows, "__h"), F.xxhash64(*keys)).mapInArrow(run, rows.schema)

    return part(True), part(False)


def likely_rows(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys are probably in ``wanted``."""
    return split_rows(rows, wanted, *(keys or ("id",)))[0]


def own_ids(df: DataFrame, name: str, id_column: str = "doc_id", text: str = "text", repeats: bool = False) -> DataFrame:
    """``df`` with a column ``name``: the id, and for rows without one (with ``repeats`` also for
    rows whose id other rows have) an id of the row's own behind all others, by the texts' digests.
    Only such rows, and with ``repeats`` few others, are stored for it; their old id stays."""
    prepare(df.sparkSession)
    col = F.col(id_column)
    kind = df.schema[id_column].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise TypeError(f"{id_column}: ids are integers or strings, not {kind.simpleString()}")
    whole = isinstance(kind, T.IntegralType)
    plain = col.cast("bigint") if whole else col
    if repeats:
        odd = cut(df.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | col.isNull()).select(id_column))
        if odd.isEmpty():
            return df.withColumn(name, plain)
        some, rest = split_rows(df, odd, id_column)
    else:
        if df.filter(col.isNull()).isEmpty():
            return df.withColumn(name, plain)
        some, rest = df.filter(col.isNull()), df.filter(col.isNotNull())
    top = df.agg(F.max(plain)).first()[0]
    place = free_name(df, "__at")
    # in one order whatever the partitions; equal rows are dealt over tasks by the last column
    order = [F.sha2(F.coalesce(text, F.lit("")), 256), F.xxhash64(*df.columns), F.col(place)]
    at = F.monotonically_increasing_id()
    some = some.withColumn(place, at).orderBy(*order).drop(place)
    own = F.lit(top or 0) + 1 + at if whole else F.concat(F.lit(top or ""), F.lpad(at.cast("string"), 20, "0"))
    return rest.withColumn(name, plain).unionByName(stored(some.withColumn(name, own)))


# --- connected components -----------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of ``edges`` (a, b): comp is the smallest id it reaches.

    Every vertex hooks to the smallest neighbour's label, then labels jump to their label's label.
    After each round the edges are those between different labels, each once, so a large component
    leaves the work as soon as it is found; what is left shrinks by half or more. The labels of the
    rounds are then followed from the last to the first. A vertex with very many links is an
    aggregate over its edges, split map-side."""
    rounds: list[DataFrame] = []
    left = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not left.isEmpty():
        both = left.filter("a <> b").select(F.col("a").alias("id"), F.col("b").alias("to")).unionAll(left.select(F.col("b").alias("id"), F.col("a").alias("to")))
        first = label = cut(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("comp")))
        # a vertex's label is smaller than itself, so the chains of labels end; two jumps a round
        for _ in range(2):
            up = label.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
            label = label.join(up, "comp", "left").select("id", F.coalesce("up", "comp").alias("comp"))
        label = cut(label)
        drop(first)
        rounds.append(label)
        a, b = (label.select(F.col("id").alias(c), F.col("comp").alias(f"{c}2")) for c in ("a", "b"))
        new = left.join(a, "a").join(b, "b").filter("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        before, left = left, cut(new)
        drop(before)
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("comp")).limit(0)
    out = rounds[-1]
    for label in reversed(rounds[:-1]):
        up = out.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        out = cut(label.join(up, "comp", "left").select("id", F.coalesce("up", "comp").alias("comp")))
    return out
