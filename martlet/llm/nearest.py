"""Nearest neighbours by a hash-prefix forest.

Every vector gets one long bit string per tree (signs of random projections). A tree is the sorted
array of these strings. A query goes down each tree to the vectors whose strings have the longest
common prefix with its own, by binary search, and then goes up in all trees at once: as long as it
has seen too few candidates, the prefix is shortened by one bit in every tree. The candidates are
ranked by their exact distance, in double precision on the original vectors.

The index is dealt into blocks of about ``BLOCK`` vectors by a hash of their id, each with a forest
of its own, and every vector is in one. Queries are dealt into blocks too; a task holds one index
block and one query block, so its memory is bounded whatever the table's size, and many equal
vectors spread over all blocks. A query takes ``SHARE`` of each block as candidates, and the best of
each block are merged. The work is queries times rows, as the stated query set (one row in a
hundred) grows with the table.

The vectors of the given table have next to no structure (their ten nearest stand at 1.03 where the
median stands at 1.41), so a large share is needed for the recall that the tests ask for. The bits
are signs, so vectors are told apart by direction: lengths should not differ much within a table.

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component take no
part; vectors of another length are never compared; rows with a null id take no part; rows that
repeat an id are all candidates, and none for a query of that id; ties go to the smaller id; an
empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import cut, prepare, table

#: Trees, bits of a string, share of the vectors that are candidates, and the rows of a block of
#: the index and of the queries.
TREES, DEPTH, SHARE, BLOCK, QUERY_BLOCK = 32, 32, 0.5, 6000, 1000


def projections(dim: int, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """The random directions, the same in every task."""
    return np.random.default_rng([9, dim]).standard_normal((dim, trees * depth)).astype(np.float64)


def strings(x: np.ndarray, directions: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """One bit string per row and tree, as an integer with the first bit on top."""
    bits = (x @ directions > 0).reshape(len(x), trees, depth)
    return bits @ (np.uint64(1) << np.arange(depth - 1, -1, -1, dtype=np.uint64))


class Forest:
    """Sorted arrays of the strings of one block."""

    def __init__(self, x: np.ndarray, directions: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        s = strings(x, directions, trees, depth)
        self.depth, self.size = depth, len(x)
        self.order = [np.argsort(s[:, t], kind="stable") for t in range(trees)]
        self.sorted = [s[o, t] for t, o in enumerate(self.order)]

    def candidates(self, strings_of_queries: np.ndarray, wanted: int):
        """Per query the rows with the longest prefixes: of all trees at the greatest prefix length
        at which they hold ``wanted`` rows together."""
        n = len(strings_of_queries)
        level = np.zeros(n, np.int64)
        lo = np.zeros((n, len(self.sorted)), np.int64)
        hi = np.full((n, len(self.sorted)), self.size, np.int64)
        open_ = np.ones(n, bool)
        for length in range(self.depth, 0, -1):  # up from the longest prefix, all trees at once
            shift = np.uint64(self.depth - length)
            at = np.flatnonzero(open_)
            a = np.empty((len(at), len(self.sorted)), np.int64)
            b = np.empty_like(a)
            for t, array in enumerate(self.sorted):
                prefix = strings_of_queries[at, t] >> shift
                a[:, t] = np.searchsorted(array, prefix << shift)
                b[:, t] = np.searchsorted(array, (prefix + np.uint64(1)) << shift)
            enough = (b - a).sum(axis=1) >= wanted
            done = at[enough]
            lo[done], hi[done], level[done] = a[enough], b[enough], length
            open_[done] = False
            if not open_.any():
                break
        for q in range(n):
            yield [self.order[t][lo[q, t]:hi[q, t]] for t in range(len(self.sorted))] if level[q] else [np.arange(self.size)]


def _usable(vector: str) -> Column:
    v = F.col(vector)
    x = F.transform(v, lambda a: a.cast("double"))
    fine = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(x, lambda a: a != 0)


def nearest(df: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding", share: float = SHARE) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest candidates of every row that ``queries`` holds for."""
    prepare(df.sparkSession)
    rows = df.filter(F.col(id_column).isNotNull() & _usable(vector)).select(
        F.col(id_column).alias("id"), F.transform(vector, lambda a: a.cast("double")).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = cut(rows.withColumn("dim", F.size("v")))
    n, n_asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    n_blocks, q_blocks = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(n_asking / QUERY_BLOCK))
    deal = lambda blocks, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(blocks)).cast("int")
    index = rows.select("dim", deal(n_blocks, 0).alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"), "id", "v")
    asking = rows.filter("asks").dropDuplicates(["id", "v"])
    asking = asking.select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("ib"), deal(q_blocks, 1).alias("qb"), "id", "v")
    kind = df.schema[id_column].dataType.simpleString()

    def block(key, left, right):
        import pandas as pd
        names = ["query_id", "id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": left["id"][:0], "id": left["id"][:0], "score": pd.Series([], dtype=float)})
        x, q = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        directions = projections(x.shape[1])
        forest = Forest(x, directions)
        ids = left["id"].to_numpy()
        wanted = TREES * max(k, math.ceil(share * len(x))) / _overlap(share)
        out = []
        for j, lists in enumerate(forest.candidates(strings(q, directions), wanted)):
            seen = np.zeros(len(x), bool)
            for rows_of_tree in lists:
                seen[rows_of_tree] = True
            seen &= ids != right["id"].iloc[j]
            at = np.flatnonzero(seen)
            if len(at) < k:  # too few to choose from: all
                at = np.flatnonzero(ids != right["id"].iloc[j])
            d = np.sqrt(((x[at] - q[j]) ** 2).sum(axis=1))
            best = np.lexsort((ids[at], d))[:k]
            out.append(pd.DataFrame({"query_id": right["id"].iloc[j], "id": ids[at[best]], "score": d[best]}))
        return pd.concat(out)[names]

    found = (index.groupBy("dim", "ib", "qb").cogroup(asking.groupBy("dim", "ib", "qb"))
             .applyInPandas(block, f"query_id {kind}, id {kind}, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_column), "score")


def _overlap(share: float) -> float:
    """Rows of all trees together per distinct row and tree, for lists that cover ``share`` of a block."""
    # independent lists of p of the rows each cover 1 - (1 - p) ** TREES of them
    p = 1 - (1 - share) ** (1 / TREES)
    return share / p


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op9_nearest": op9_nearest}
ORACLE: dict[str, str] = {}
