"""Exact quantiles by distributed selection.

A percentile aggregate keeps a map of a group's values in one task. Here equal values
are counted first, the (group, value, count) rows are put in order by the segmented
scan, and the running counts tell which rows hold the order statistics that the
probabilities ask for. Only those rows, two per group and probability, go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import join_on
from .scan import running


def exact_quantiles(df: DataFrame, value: Column, probs: Sequence[float], groupby: Sequence[str] = (),
                    as_: str = "quantiles") -> DataFrame:
    """Per group (those with a value that is not null) the array of quantiles at ``probs``,
    interpolated between the two nearest values; NaN counts as the largest value."""
    g = list(groupby)
    probs = [float(p) for p in probs]
    counts = df.select(*g, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull()) \
        .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(counts, {"_upto": ("sum", "_n")}, g, ["_v"])
    total = ranked.groupBy(*g).agg(F.max("_upto").alias("_all"))
    place = (F.col("_all") - 1) * F.col("_p")
    # the wanted places of a group: two per probability
    wanted = F.transform(F.array(*[F.lit(p) for p in probs]), lambda p, i: F.struct(
        i.alias("i"), F.floor((F.col("_all") - 1) * p).alias("lo"), F.ceil((F.col("_all") - 1) * p).alias("hi")))
    total = total.withColumn("_want", wanted)
    j = join_on(ranked, total, g) if g else ranked.crossJoin(F.broadcast(total))  # one row without groups
    first = F.col("_upto") - F.col("_n")

    def here(k: Column) -> Column:
        return (k >= first) & (k < F.col("_upto"))

    hits = j.select(*g, "_v", "_all", F.explode(F.filter("_want", lambda w: here(w["lo"]) | here(w["hi"]))).alias("_w"))
    # of a probability's one or two rows the smaller value is the lower statistic
    pairs = hits.groupBy(*g, F.col("_w.i").alias("_i")).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.max("_all").alias("_all"))
    pairs = pairs.withColumn("_p", F.get(F.array(*[F.lit(p) for p in probs]), F.col("_i")))
    part = place - F.floor(place)
    between = F.when((F.col("_lo") == F.col("_hi")) | (part == 0), F.col("_lo")).otherwise((1 - part) * F.col("_lo") + part * F.col("_hi"))
    out = pairs.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("_i", between.alias("_x")))).alias("_l"))  # one per probability
    return out.select(*g, F.transform("_l", lambda x: x["_x"]).alias(as_))
