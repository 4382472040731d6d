"""N-gram Jaccard join by grouped prefixes: near duplicates and their components.

A document's set holds the 64-bit hashes of its distinct n-word shingles (A-Z lower-cased; a text of
fewer words is one shingle). Two sets are linked if their intersection is at least ``t`` of their
union. The work, step by step:

1. Documents with the same set are one class, whatever their number (a plain aggregate).
2. All shingles are counted into a sketch of fixed size; shingles that stand out are ordered last,
   all others by their hash. Any fixed order gives right results; this one keeps frequent passages
   out of the prefixes.
3. Linked sets share at least ``l`` of their first ``n - ceil(t n) + l`` shingles (prefix), and so
   do their sizes fit. Classes with identical prefixes and size are one group; groups are joined on
   prefix shingles, shared shingles are counted, and pairs whose count cannot reach the required
   overlap are dropped. Pairs of groups are expanded to their classes and verified on whole sets.
   Each set has a signature of ``SIGN_BITS`` bits, the parities of its shingles by their lowest
   bits. Two signatures differ in no more bits than the sets differ in shingles, so pairs whose
   signatures are too far apart cannot be linked and leave the second join at once.
4. Only components are asked for, so the join runs twice: first between neighbours in each list of
   groups with one shingle, and between each group and the list's hub, which is linear and finds most
   links; then between all groups of fitting size that are still in different components. No link between
   different components can be missed, and a large group of copies never produces all its pairs. The
   hub has the fewest rarer shingles: if copies were changed each in its own way, it is the text that
   they were made from or close to it, and those that are not linked to it have more shingles of their
   own than the second join's prefixes, cut for each pair of sizes, hold.

Sets are read from the text again for the classes that are to be verified; a fixed-size bitmap
limits that scan and an exact join follows. Equal hashes count as equal shingles.

Defined cases: a null or empty text, or one of white space, has no shingles and no links; of rows
that repeat an id, the largest set and the smallest component are reported; rows with a null id link
nothing and have one row together; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import combine, components, cut, drop, likely_rows, mix, prepare, release, table, text_chunks, words

#: log2 of the counters of the frequency sketch, and the shared shingles that a pair needs at least.
SKETCH_BITS, LEAST_SHARED = 21, 4
#: Neighbours of a group that the first join verifies; what they leave apart is left to the second.
NEIGHBOURS = 8
#: Bits of a set's signature, held in two numbers.
SIGN_BITS = 128


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    doc, _, _, h = words(data, offs)
    n = len(offs) - 1
    count = max(0, len(h) - size + 1)
    grams = combine([h[k:k + count] for k in range(size)]) if count else np.zeros(0, np.uint64)
    ends = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for d in range(n):
        lo, hi = int(ends[d]), int(ends[d + 1])
        if hi - lo >= size:
            g = np.sort(grams[lo:hi - size + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif hi > lo:
            out.append(combine([h[k:k + 1] for k in range(lo, hi)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """For each value of the lowest bits whether an odd number of the shingles have it."""
    odd = np.bincount((s & np.uint64(SIGN_BITS - 1)).astype(np.int64), minlength=SIGN_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(rows: DataFrame, size: int) -> np.ndarray:
    """A level for each of 2**SKETCH_BITS counters: 0 for most, higher for those whose count over
    all documents stands out. Tasks count all their shingles and report the counters that are well
    above their mean; the reports are summed. At most 2**SKETCH_BITS rows reach the driver."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        waiting, many = [], 0
        for b in batches:
            for _, _, data, offs in text_chunks(b, 1):
                waiting += [(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32) for s in shingle_sets(data, offs, size)]
                many += len(data)
                if many > 8 << 20:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, many = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        mean = total.mean()
        at = np.flatnonzero(total > mean + 6 * math.sqrt(mean) + 3)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])

    got = rows.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    level = np.zeros(1 << SKETCH_BITS, np.uint8)
    n = got.column("n").to_numpy()
    level[got.column("at").to_numpy()] = 1 + np.log2(np.maximum(n, 1)).astype(np.uint8)
    return level


def _least_prefix(n: int, num: int, den: int) -> tuple[int, int]:
    """(shared shingles needed, prefix length) of a set of n shingles."""
    own = -(-num * n // den)  # smallest overlap of a linked pair
    need = min(LEAST_SHARED, own)
    return need, min(n, n - own + need)


def _features(rows: DataFrame, level: np.ndarray, size: int, num: int, den: int) -> DataFrame:
    """(id, n, d1, d2: digest of the set, q1, q2: its signature, prefix) of every row."""
    kind = rows.schema["id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(level)  # 2**SKETCH_BITS bytes

    def run(batches):
        lv = shared.value
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                n, d1, d2, signs, prefix = [], [], [], [], []
                for s in shingle_sets(data, offs, size):
                    n.append(len(s))
                    d1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                    d2.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                    signs.append(signature(s))
                    order = lv[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    first = s[np.argsort(order, kind="stable")] if order.any() else s
                    prefix.append(first[:_least_prefix(len(s), num, den)[1]].view(np.int64))
                q1, q2 = np.array(signs, np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([b.slice(lo, hi - lo).column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                                                  pa.array(d2, pa.int64()), pa.array(q1), pa.array(q2), pa.array(prefix, pa.list_(pa.int64()))],
                                                 names=["id", "n", "d1", "d2", "q1", "q2", "prefix"])
        release()

    return rows.mapInArrow(run, f"id {kind}, n bigint, d1 bigint, d2 bigint, q1 bigint, q2 bigint, prefix array<bigint>")


def _sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, set) of the ids in ``wanted``."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                sets = [s.view(np.int64) for s in shingle_sets(data, offs, size)]
                yield pa.RecordBatch.from_arrays([b.slice(lo, hi - lo).column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])
        release()

    return likely_rows(rows, wanted).mapInArrow(run, f"id {kind}, set array<bigint>").join(wanted, "id", "left_semi")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The linked pairs (a, b) among class pairs, by their whole sets."""
    pairs = cut(pairs.select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = cut(_sets(rows, wanted, size).dropDuplicates(["id"]))
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))
    inter = F.size(F.array_intersect("sa", "sb"))
    linked = cut(both.filter(den * inter >= num * (F.size("sa") + F.size("sb") - inter)).select("a", "b"))
    drop(sets)
    drop(pairs)
    return linked


def jaccard_components(df: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id, class_id) of every document: class_id is the smallest id with
    the very same set, component_id the smallest id reachable by links of num/den or more."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    feats = cut(_features(rows, sketch(rows, size), size, num, den))
    some = feats.filter("n > 0 AND id IS NOT NULL")
    classes = cut(some.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix"), F.first("q1").alias("q1"), F.first("q2").alias("q2")))
    # groups: classes of one size with one prefix
    key = F.xxhash64("prefix")
    member = classes.select("n", key.alias("p1"), F.xxhash64("prefix", F.lit(1)).alias("p2"), "rep", "prefix", "q1", "q2")
    groups = cut(member.groupBy("n", "p1", "p2").agg(F.min("rep").alias("g"), F.first("prefix").alias("prefix")))
    members = cut(member.select("n", "p1", "p2", "rep", "q1", "q2").join(groups.select("n", "p1", "p2", "g"), ["n", "p1", "p2"]).select("g", "n", "rep", "q1", "q2"))
    posts = groups.select("g", "n", F.posexplode("prefix").alias("k", "s"))
    # of use in a shingle's list are groups with another one of fitting size: if any fits, the next by size does
    by = Window.partitionBy("s").orderBy("n", "g")
    posts = cut(posts.withColumn("less", F.lag("n").over(by)).withColumn("more", F.lead("n").over(by))
                .filter((den * F.col("less") >= num * F.col("n")) | (den * F.col("n") >= num * F.col("more"))).drop("less", "more"))
    fits = den * F.least("n", "n2") >= num * F.greatest("n", "n2")

    # first join: in each shingle's list of groups the neighbours by size and the hub, the group with
    # the fewest rarer shingles; and within each group
    lists = Window.partitionBy("s", "part")
    last, hub = F.lag(F.struct("g", "n")).over(lists.orderBy("n", "g")), F.min(F.struct("k", "g", "n")).over(lists)
    near = (posts.withColumn("part", F.floor(F.log2(F.col("n")) * 8))  # a list is split by size
            .withColumn("last", last).withColumn("hub", hub)
            .withColumn("to", F.explode(F.array_distinct(F.array("last", F.struct("hub.g", "hub.n")))))
            .select("g", "n", F.col("to.g").alias("g2"), F.col("to.n").alias("n2")).filter("g2 <> g").filter(fits)
            .groupBy("g2", "g", "n2", "n").agg(F.count(F.lit(1)).alias("c")).filter(_enough("n", "n2", F.col("c"), num, den)))
    # of each group's neighbours (at most one a prefix shingle) those that share most
    best = Window.partitionBy("g").orderBy(F.desc("c"), "g2")
    near = near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= NEIGHBOURS)
    chain = members.withColumn("a", F.lag("rep").over(Window.partitionBy("g").orderBy("rep"))).filter("a IS NOT NULL")
    links = _verified(near.select(F.least("g", "g2").alias("a"), F.greatest("g", "g2").alias("b")).union(chain.select("a", F.col("rep").alias("b"))),
                      rows, size, num, den)
    comp = components(links)
    placed = cut(members.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")))

    # second join: all groups with a shingle in common that are not within one component
    alone = F.count(F.lit(1)) == 1  # the signature of a group with one class
    spread = placed.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), *[F.when(alone, F.max(q)).alias(q) for q in ("q1", "q2")])
    needed = F.least(F.lit(LEAST_SHARED), F.ceil(num * F.col("n") / den))  # lists in common with any partner
    open_posts = posts.join(spread, "g").withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("g"))).filter(F.col("c") >= needed)
    mixed = open_posts.groupBy("s").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).filter("l <> h").select("s")
    # sizes of linked sets are of one class or of neighbouring ones
    kind = F.floor(F.log(F.col("n").cast("double")) / math.log(1.001 * den / num)).cast("int")
    open_posts, whole_posts = cut(open_posts.join(mixed, "s").select("s", "g", "n", "k", F.expr("if(lo = hi, lo, null)").alias("comp"), "q1", "q2")), posts
    drop(whole_posts)
    other = open_posts.select("s", kind.alias("at"), *[F.col(c).alias(c + "2") for c in ("g", "n", "k", "comp", "q1", "q2")])
    open_posts = open_posts.withColumn("at", F.explode(F.array(kind, kind + 1)))
    once = (F.col("at") > kind) | (F.col("g") < F.col("g2"))
    apart = F.coalesce(F.col("comp") != F.col("comp2"), F.lit(True))  # a group in several components has none
    # sets that share m shingles have the first l of them within their first n - m + l: a part of the
    # whole prefix, which is made for the smallest partner
    least = F.least(F.lit(LEAST_SHARED), _overlap("n", "n2", num, den))
    first = F.greatest(F.col("k") - F.col("n"), F.col("k2") - F.col("n2")) < least - _overlap("n", "n2", num, den)
    found = (open_posts.join(other, ["s", "at"]).filter(once & apart & fits & first & _alike("", "2", num, den))
             .groupBy("g", "g2", "n", "n2").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= least))
    inside = placed.join(spread.filter("lo <> hi").select("g"), "g")
    sides = [[F.col("rep").alias(x), *[F.col(c).alias(c + x) for c in ("comp", "n", "q1", "q2")]] for x in "ab"]
    late = F.expr("compa <> compb") & _alike("a", "b", num, den)
    wide = cut(found.select("g", "g2")).join(placed.select("g", *sides[0]), "g").join(placed.select(F.col("g").alias("g2"), *sides[1]), "g2").filter(late)
    own = inside.select("g", *sides[0]).join(inside.select("g", *sides[1]), "g").filter(F.expr("a < b") & late)
    more = _verified(wide.select("a", "b").unionByName(own.select("a", "b")), rows, size, num, den)
    found_so_far = placed.filter(F.col("rep") != F.col("comp")).select(F.col("rep").alias("a"), F.col("comp").alias("b"))
    final = components(found_so_far.union(more))

    reps = classes.select("n", "d1", "d2", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left")
    out = (feats.select("id", "n", "d1", "d2").join(reps, ["n", "d1", "d2"], "left")
           .select("id", "n", F.coalesce("rep", "id").alias("class_id"), F.coalesce("comp", "rep", "id").alias("component_id")))
    return out.groupBy(F.col("id").alias(id_column)).agg(
        F.max("n").alias("n_shingles"), F.min("component_id").alias("component_id"), F.min("class_id").alias("class_id"))


def _overlap(n, n2, num: int, den: int):
    """Smallest intersection of two linked sets of these sizes."""
    return F.ceil(num * (F.col(n) + F.col(n2)) / (num + den))


def _enough(n, n2, c, num: int, den: int):
    """Whether ``c`` shared prefix shingles allow a link: those behind the shorter rest of the two
    prefixes can all be shared, and no others."""
    own = [F.ceil(num * F.col(x) / den) for x in (n, n2)]
    rest = [F.col(x) - F.least(F.col(x), F.col(x) - o + F.least(F.lit(LEAST_SHARED), o)) for x, o in zip((n, n2), own)]
    return (c + F.greatest(*rest) >= _overlap(n, n2, num, den)) & (c >= F.least(F.lit(LEAST_SHARED), *own))


def _alike(one: str, two: str, num: int, den: int):
    """Whether the signatures (columns named with these endings; null: unknown) allow a link."""
    far = sum(F.bit_count(F.col(q + one).bitwiseXOR(F.col(q + two))) for q in ("q1", "q2"))
    n, n2 = "n" + one, "n" + two
    return F.coalesce(far <= F.col(n) + F.col(n2) - 2 * _overlap(n, n2, num, den), F.lit(True))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and class of every document: 3-word shingles, 90 of 100."""
    return jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {"op4_jaccard_join": op4_jaccard_join}
ORACLE: dict[str, str] = {}
