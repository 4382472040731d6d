"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, lower-cased. A seed is the hash of ``MIN_TILE`` consecutive
words. Seeds that a document shares with the benchmark are found in one pass over the documents
(a fixed-size bitmap of the benchmark's seeds lets only likely ones leave the scan), joined to the
benchmark's seeds, and give the (document, item) pairs that can match at all. Each pair is then
tiled: of all common word sequences that don't overlap words already marked, the longest is marked
on both sides, again and again, until none of ``MIN_TILE`` words is left. The common sequences come
from running Karp-Rabin hashes of the words. The words of the item that are marked, over all its
words, are its coverage; passages in another order still count in full. A document with an item
covered to ``COVERAGE`` or more is contaminated.

Work is spread by (document, item) pair; a seed that a third of the documents share is one row of
the benchmark's side, and the documents' side of that join may be split. Items shorter than
``MIN_TILE`` words are one seed as a whole.

Defined cases: null or empty texts and items have no words and match nothing; repeated document
rows are judged together (the largest coverage counts); every distinct text of an item id, a null
id too, is a passage of its own that is searched, and the best covered one is reported for the id;
an empty benchmark contaminates nothing. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import _LOWER, bitmap, byte_sums, combine, cut, in_bitmap, mix, prepare, span, table, text_chunks

#: Words of the shortest tile, and the share of an item's words that makes a match.
MIN_TILE, COVERAGE = 5, 0.5

_INSIDE = np.zeros(256, bool)
_INSIDE[[c for c in range(128) if chr(c).isalnum()]] = True
_INSIDE[128:] = True


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word, in order."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _INSIDE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offs[:-1]] = True
    start = np.flatnonzero(inside & ~(np.concatenate([[False], inside[:-1]]) & ~breaks[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate([inside[1:], [False]]) & ~breaks[1:])) + 1
    h = mix(span(byte_sums(_LOWER[data]), start, end) + (end - start).astype(np.uint64))
    return np.searchsorted(offs, start, "right") - 1, h


def seeds_of(doc: np.ndarray, h: np.ndarray, n_docs: int, whole_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(document, seed) of every MIN_TILE consecutive words of one document."""
    size = MIN_TILE
    count = max(0, len(h) - size + 1)
    same = doc[:count] == doc[size - 1:] if count else np.zeros(0, bool)
    out = doc[:count][same], combine([h[k:k + count] for k in range(size)])[same] if count else np.zeros(0, np.uint64)
    if not whole_short:
        return out
    many = np.bincount(doc, minlength=n_docs)
    extra = [(d, combine([w[None] for w in h[doc == d]])[0]) for d in np.flatnonzero((many > 0) & (many < size))]
    return (np.concatenate([out[0], np.array([d for d, _ in extra], np.int64)]),
            np.concatenate([out[1], np.array([x for _, x in extra], np.uint64)]))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def common_runs(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal common sequences of at least ``size`` words: (length, start in a, start in b). Starts
    come from running hashes of ``size`` words; equal ones on one diagonal join to one sequence."""
    if len(a) < size or len(b) < size:
        return []
    na, nb = len(a) - size + 1, len(b) - size + 1
    ha, hb = (combine([x[k:k + n] for k in range(size)]) for x, n in ((a, na), (b, nb)))
    order = np.argsort(hb, kind="stable")
    lo, hi = np.searchsorted(hb[order], ha), np.searchsorted(hb[order], ha, "right")
    i = np.repeat(np.arange(na), hi - lo)
    if not len(i):
        return []
    j = order[np.concatenate([np.arange(x, y) for x, y in zip(lo, hi) if y > x])]
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    new = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j - i) != 0)])
    first = np.flatnonzero(new)
    length = np.diff(np.concatenate([first, [len(i)]])) + size - 1
    return list(zip(length.tolist(), i[first].tolist(), j[first].tolist()))


def tile(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: the tiles (length, start in a, start in b).
    The longest common sequence of unmarked words is marked first; of equally long ones, the one
    that begins first in ``b``, then in ``a``."""
    import heapq

    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    heap = [(-n, j, i) for n, i, j in common_runs(a, b, size)]
    heapq.heapify(heap)
    tiles = []
    while heap:
        n, j, i = heapq.heappop(heap)
        n = -n
        free = free_a[i:i + n] & free_b[j:j + n]
        if free.all():
            free_a[i:i + n] = free_b[j:j + n] = False
            tiles.append((n, i, j))
            continue
        # what other tiles have left of it, in unmarked pieces
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        for x, y in zip(edge[::2], edge[1::2]):
            if y - x >= size:
                heapq.heappush(heap, (-int(y - x), j + int(x), i + int(x)))
    return tiles


def _items(benchmark: DataFrame, item_column: str, text: str) -> DataFrame:
    """(passage: a number of its own, item, words, seeds) of every distinct (item id, text)."""
    rows = benchmark.select(F.col(item_column).alias("item"), F.col(text).alias("text")).distinct()
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                doc, h = word_hashes(data, offs)
                d, s = seeds_of(doc, h, hi - lo, True)
                words = np.split(_signed(h), np.searchsorted(doc, np.arange(1, hi - lo)))
                seeds = [np.unique(_signed(s[d == k])) for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.slice(lo, hi - lo).column(0), pa.array(words, pa.list_(pa.int64())),
                                                  pa.array(seeds, pa.list_(pa.int64()))], names=["item", "words", "seeds"])

    return cut(rows.mapInArrow(run, f"item {kind}, words array<bigint>, seeds array<bigint>")
               .withColumn("passage", F.monotonically_increasing_id()))


def match_items(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
                item_text: str = "text") -> DataFrame:
    """Every (id, item) pair with a common tile: n_words, n_covered, n_tiles and coverage of the
    item's best covered passage."""
    spark = prepare(docs.sparkSession)
    items = _items(benchmark, item_column, item_text)
    seeds = items.select("passage", F.explode("seeds").alias("seed"))
    size = MIN_TILE
    known = spark.sparkContext.broadcast(bitmap(seeds, "seed"))  # 2**BITMAP_BITS bits
    # items of fewer words than a tile: their whole sequence is looked for, by its length
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).filter(f"n > 0 AND n < {size}").distinct().collect())  # below MIN_TILE
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                doc, h = word_hashes(data, offs)
                found = []
                for n in [*short, size]:
                    count = max(0, len(h) - n + 1)
                    if count:
                        same = doc[:count] == doc[n - 1:]
                        s = combine([h[k:k + count] for k in range(n)])
                        keep = np.flatnonzero(same & in_bitmap(known.value, s))
                        found.append(np.stack([doc[keep], _signed(s[keep])]))
                if not found:
                    continue
                hits = np.concatenate(found, axis=1)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                ids = b.slice(lo, hi - lo).column(0)
                at = np.unique(hits[0])
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array([_signed(h[ends[d]:ends[d + 1]]) for d in at], pa.list_(pa.int64())),
                         pa.array([np.unique(hits[1][hits[0] == d]) for d in at], pa.list_(pa.int64()))], names=["id", "words", "seeds"])

    # the documents with a likely seed, whole, as word hashes
    likely = cut(rows.mapInArrow(run, f"id {kind}, words array<bigint>, seeds array<bigint>")
                 .withColumn("row", F.monotonically_increasing_id()))
    pairs = (likely.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
             .select("row", "passage").distinct())
    both = (pairs.join(likely.select("row", "id", F.col("words").alias("a")), "row")
            .join(items.select("passage", "item", F.col("words").alias("b")), "passage").select("id", "item", "a", "b"))

    def tiled(batches):
        for b in batches:
            n_words, n_covered, n_tiles = [], [], []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
                tiles = tile(x, y, min(size, len(y)))
                n_words.append(len(y))
                n_covered.append(sum(t[0] for t in tiles))
                n_tiles.append(len(tiles))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(n_covered, pa.int64()),
                                              pa.array(n_tiles, pa.int64())], names=["id", "item", "n_words", "n_covered", "n_tiles"])

    item_kind = items.schema["item"].dataType.simpleString()
    out = both.mapInArrow(tiled, f"id {kind}, item {item_kind}, n_words bigint, n_covered bigint, n_tiles bigint")
    return (out.withColumn("coverage", F.col("n_covered") / F.col("n_words"))
            .groupBy(F.col("id").alias(id_column), F.col("item").alias(item_column))
            .agg(F.max(F.struct("coverage", "n_covered", "n_words", "n_tiles")).alias("best"))
            .select(id_column, item_column, "best.n_words", "best.n_covered", "best.n_tiles", "best.coverage"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id", **columns) -> DataFrame:
    """The pairs whose item is covered to COVERAGE or more."""
    return match_items(docs, benchmark, id_column=id_column, item_column=item_column, **columns).filter(F.col("coverage") >= COVERAGE)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark item in it: (doc_id, item_id, n_words, n_covered, n_tiles, coverage)."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontamination": op10_decontamination}
ORACLE: dict[str, str] = {}
