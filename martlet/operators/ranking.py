"""Global ranking without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row into one
task. Here the total order comes from a range-partitioned sort instead:
``orderBy`` gives sorted, range-ordered partitions; ``monotonically_increasing_id``
encodes (partition index, position in partition); one count per partition (a table
whose size is bounded by the partition count, so it is safe to broadcast) turns
positions into global row numbers. Callers must give a total order (unique
tie-break) for deterministic results. The numbered rows are checkpointed before
they are read twice, so both reads see the same partition ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOW33 = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_number",
                      with_total: str | None = None) -> DataFrame:
    cols = list(df.columns)
    ranked = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    ranked = ranked.withColumn("_pid", F.shiftright("_mid", 33)) \
                   .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    # read twice below (counts and join): materialise the numbered rows once so both
    # see the same partition ids (range bounds are sampled; executors can be lost)
    ranked = cut_lineage(ranked)
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    # one row per partition: a size bound fixed by the partition count
    out = ranked.join(F.broadcast(offsets), "_pid")
    extra = [F.col("_total").alias(with_total)] if with_total else []
    return out.select(*cols, (F.col("_off") + F.col("_pos") + 1).alias(name), *extra)


def ntile_from_row_number(rn: Column, total: Column, k: int) -> Column:
    """NTILE(k) from a 1-based row number: the first ``total % k`` buckets hold one extra row."""
    q = F.floor(total / k).cast("bigint")
    r = (total % k).cast("bigint")
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, k: int, order: Sequence[Column | str], name: str = "ntile") -> DataFrame:
    """NTILE(k) OVER (ORDER BY order), distributed."""
    ranked = global_row_number(df, order, "_rn", with_total="_tot")
    return ranked.withColumn(name, ntile_from_row_number(F.col("_rn"), F.col("_tot"), k)) \
                 .drop("_rn", "_tot")
