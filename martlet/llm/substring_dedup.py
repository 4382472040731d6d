"""Removal of repeated substrings by distributed prefix doubling over sampled positions.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier (in a document of
smaller id, or earlier in the same document) is removed; overlaps count, matches never cross
documents, and all is judged on the input.

Positions get ranks for growing lengths; equal ranks mean equal strings, and positions are dropped
as soon as their rank is unique:

1. Start: length ``SEED``. Of the positions of a text only a sample is ranked: of every LENGTH-byte
   window the one seed whose hash is smallest (the leftmost of equal ones). Equal windows choose
   the same seed at the same offset, so sampling loses none; about one position in 32 is left. The
   seeds are grouped by their hash. A seed that stands in one document only is unique: all windows
   that chose it are dropped.
2. Context: the run of windows that chose a seed, LENGTH to LENGTH + 68 bytes. Where a whole context
   stands in a smaller id too, all its windows repeat; seeds with one context only are done.
3. Doubling: of seeds with different contexts (at the borders of repeats), every context is taken
   once, where it stands first. Spark sorts these by seed and id. Within a seed, the window starts
   are ranked by their place before the seed, then by the pairs of that rank and the next bytes, out
   to 13, 25, 50 and LENGTH bytes; each time the pairs are sorted and reranked, and starts whose
   rank is unique are dropped. What is left at LENGTH stands twice.

Seeds with more than ``GROUP`` first contexts are not gathered in a task: their windows are ranked
at LENGTH bytes at once, by an aggregate on two fingerprints. Ranks of seeds and contexts are 64-bit
fingerprints. Steps 1 and 2 are aggregates on a key, so a string that a third of all documents hold
is combined before it is shuffled. Repeats within one document are found where the text is read.
Fixed-size bitmaps of the seeds in question limit what leaves the scan, exact joins follow.

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing; rows that repeat an id
are each judged against smaller ids and themselves, not against each other; rows with a null id are
judged against themselves only; an empty table gives an empty table. Other columns are ignored. A text
is handled whole by one task, whose memory grows with the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bitmap, byte_sums, in_bitmap, mix, prepare, span, split_rows, stored, table, text_chunks

#: Bytes of a repeated string, and of the seeds that positions are first ranked by.
LENGTH, SEED = 100, 32
#: Most first contexts of a seed that one task compares; a seed with more is spread over tasks.
GROUP = 4096
_POSITIONS = np.uint64((1 << 32) - 1)


class Seeds:
    """Sampled positions of one chunk of texts: for each the seed's hash ``q``, the windows
    ``first:last`` (start positions, within the chunk) that chose it, and its document."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        n = len(data)
        self.sums = byte_sums(data)
        self.offs = offs
        z = np.zeros(0, np.int64)
        self.doc, self.at, self.first, self.last, self.q = z, z, z, z, z.astype(np.uint64)
        if n < LENGTH:
            return
        m = n - SEED + 1
        h = mix(span(self.sums, slice(m), slice(SEED, None)))
        key = (h & ~_POSITIONS) | np.arange(m, dtype=np.uint64)
        width = LENGTH - SEED + 1  # seeds within a window
        size = 1
        while 2 * size <= width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = width - size
        key = np.minimum(key[:len(key) - rest], key[rest:]) if rest else key
        chosen = (key & _POSITIONS).astype(np.int64)  # by window start 0 .. n - LENGTH
        start = np.arange(len(chosen))
        size = np.diff(offs)
        doc = np.repeat(np.arange(len(size)), size)[:len(start)]
        ok = start + LENGTH <= np.repeat(offs[1:], size)[:len(start)]
        start, chosen, doc = start[ok], chosen[ok], doc[ok]
        if not len(start):
            return
        new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])])
        edge = np.flatnonzero(new)
        self.at, self.doc, self.first = chosen[edge], doc[edge], start[edge]
        self.last = np.concatenate([start[edge[1:] - 1], start[-1:]])
        self.q = mix(h[self.at])  # smallest hashes begin with zeros: mixed again for the bitmaps

    def context(self) -> np.ndarray:
        """Rank of the whole run of windows of each seed, with the seed's place in it."""
        h = mix(span(self.sums, self.first, self.last + LENGTH))
        return mix(h + mix((self.at - self.first).astype(np.uint64) * np.uint64(4099) + (self.last - self.first).astype(np.uint64)))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(seed index, start, two hashes) of all windows of the seeds ``which``."""
        owner, start = _starts(self.first[which], self.last[which] - self.first[which] + 1)
        return which[owner], start, *_window_hashes(self.sums, start)


def _starts(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, start) of ``count`` consecutive starts from each ``first``."""
    owner = np.repeat(np.arange(len(first)), count)
    return owner, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[owner]


def _window_hashes(sums: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # the second hash joins the fingerprints of unequal parts of the window, each mixed
    part = mix(span(sums, start, start + 37)) * np.uint64(3) + mix(span(sums, start + 37, start + LENGTH))
    return mix(span(sums, start, start + LENGTH)), mix(part ^ np.uint64(0x5851F42D4C957F2D))


def _chunks(b: pa.RecordBatch):
    for lo, hi, data, offs in text_chunks(b, 1):
        yield b.slice(lo, hi - lo), Seeds(data, offs)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def _ranked(rows: DataFrame, kind: str) -> DataFrame:
    """(q, c, id) of every sampled seed, once a document and context."""
    def run(batches):
        for b in batches:
            for part, s in _chunks(b):
                if len(s.q):
                    yield pa.RecordBatch.from_arrays([_signed(s.q), _signed(s.context()), part.column(0).take(pa.array(s.doc))], names=["q", "c", "id"])

    return rows.mapInArrow(run, f"q bigint, c bigint, id {kind}")


def _own_repeats(s: Seeds) -> np.ndarray:
    """Starts of windows that also start earlier in the same document."""
    both = (s.q ^ mix(s.doc.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    again = np.zeros(len(both), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    owner, start, w1, w2 = s.windows(np.flatnonzero(again))
    if not len(owner):
        return start
    order = np.lexsort((start, w2, w1, s.doc[owner]))
    o, a, b = s.doc[owner][order], w1[order], w2[order]
    rep = np.concatenate([[False], (o[1:] == o[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])])
    return start[order][rep]


def _reranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, how many have it) of the pairs of ``first`` and ``second``."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    rank = np.empty(len(a), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, np.bincount(rank, minlength=1)[rank]


def _repeated_starts(data: np.ndarray, offs: np.ndarray, seed: np.ndarray, place: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, start within it) of the windows which a smaller id has too: contexts ``offs`` of
    ``data``, their seeds, the seeds' places in them, and numbers in the order of their ids."""
    sums = byte_sums(data)
    owner, start = _starts(offs[:-1], np.diff(offs) - LENGTH + 1)
    rank, n = _reranked(seed[owner], offs[owner] + place[owner] - start)
    done = 0
    for size in (13, 25, 50, LENGTH):
        some = n > 1
        owner, start, rank = owner[some], start[some], rank[some]
        rank, n = _reranked(rank, mix(span(sums, start + done, start + size)))
        done = size
    least = np.full(len(rank) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, rank, ids[owner])
    again = least[rank] < ids[owner]
    return owner[again], start[again] - offs[owner[again]]


def _as_spans(part: pa.RecordBatch, owner: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """(id, t, first, last): runs of consecutive starts of the contexts ``part``."""
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    end = np.concatenate([new[1:] - 1, [len(owner) - 1]])
    at = pa.array(owner[new])
    base = part.column("first").to_numpy()[owner[new]]
    return pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("t").take(at), pa.array((base + start[new]).astype(np.int32)),
                                       pa.array((base + start[end]).astype(np.int32))], names=["id", "t", "first", "last"])


def _by_seed(batches):
    """Batches that end where a seed ends, of rows in the order of their seeds."""
    rest = None
    for b in batches:
        if rest is not None:
            b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        q = b.column("q").to_numpy()
        edge = np.flatnonzero(q[1:] != q[:-1])
        whole = int(edge[-1]) + 1 if len(edge) else 0
        if whole:
            yield b.slice(0, whole)
        rest = b.slice(whole)
    if rest is not None and rest.num_rows:
        yield rest


def _texts_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the contexts, and their offsets."""
    for _, _, data, offs in text_chunks(part, part.schema.get_field_index("bytes"), 1 << 62):
        return data, offs
    return np.zeros(0, np.uint8), np.zeros(1, np.int64)


def _contexts(rows: DataFrame, kept: DataFrame, kind: str) -> DataFrame:
    """The contexts ``kept`` with their bytes, read from the texts that have them."""
    per = stored(kept.groupBy("id", "t").agg(F.collect_list(F.struct("q", "first", "last", "place")).alias("s"))
                 .select("id", "t", "s.q", "s.first", "s.last", "s.place"))
    both = split_rows(rows, per, "id", "t")[0].join(per, ["id", "t"]).select("id", "t", F.col("text").cast("binary").alias("text"), "q", "first", "last", "place")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(2)[i].as_py()
                q, first, last, place = (b.column(k)[i].values for k in range(3, 7))
                same = pa.array(np.full(len(q), i))
                cuts = [text[x:y + LENGTH] for x, y in zip(first.to_pylist(), last.to_pylist())]
                yield pa.RecordBatch.from_arrays([q, b.column(0).take(same), b.column(1).take(same), first, place, pa.array(cuts, pa.binary())],
                                                 names=["q", "id", "t", "first", "place", "bytes"])

    return both.mapInArrow(run, f"q bigint, id {kind}, t bigint, first int, place int, bytes binary")


def repeated_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """(id, t: hash of the text, first, last): runs of window starts, by byte position
    in the document, whose windows start earlier as well."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("t")).filter("id IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()
    spark = df.sparkSession

    # ranks of SEED bytes: unique seeds are dropped; ``mixed``: more than one context
    ranks = stored(_ranked(rows, kind).groupBy("q")
                   .agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("id").alias("i0"), F.max("id").alias("i1"))
                   .filter("i0 <> i1").select("q", (F.col("lo") != F.col("hi")).alias("mixed")))
    seeds = spark.sparkContext.broadcast(bitmap(ranks, "q"))

    def in_question(batches):
        for b in batches:
            for part, s in _chunks(b):
                at = np.flatnonzero(in_bitmap(seeds.value, s.q))
                if len(at):
                    base, doc = s.offs[s.doc[at]], pa.array(s.doc[at])
                    places = [pa.array(v.astype(np.int32)) for v in (s.first[at] - base, s.last[at] - base, s.at[at] - s.first[at])]
                    yield pa.RecordBatch.from_arrays([_signed(s.q[at]), _signed(s.context()[at]), part.column(0).take(doc), part.column(2).take(doc), *places],
                                                     names=["q", "c", "id", "t", "first", "last", "place"])

    # contexts: where each stands first, and all places behind that
    found = rows.mapInArrow(in_question, f"q bigint, c bigint, id {kind}, t bigint, first int, last int, place int")
    found = stored(found.join(ranks.select("q"), "q", "left_semi"))
    firsts = stored(found.groupBy("q", "c").agg(F.min("id").alias("i0")))
    whole = found.join(firsts, ["q", "c"]).filter("i0 < id").select("id", "t", "first", "last")

    # doubling from the first contexts of seeds that have several
    mixed = firsts.join(ranks.filter("mixed").select("q"), "q", "left_semi")
    kept = found.join(mixed, ["q", "c"]).filter("i0 = id").select("q", "id", "t", "first", "last", "place")
    contexts = stored(_contexts(rows, kept, kind))
    many = contexts.groupBy("q").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group)
    crowd = spark.sparkContext.broadcast(bitmap(many, "q"))

    def crowded(inside: bool):
        def run(batches):
            for b in batches:
                yield b.filter(pa.array(in_bitmap(crowd.value, b.column(0).to_numpy()) == inside))
        return contexts.mapInArrow(run, contexts.schema)

    def doubled(batches):
        for part in _by_seed(batches):
            data, offs = _texts_of(part)
            ids = part.column("id").to_numpy(zero_copy_only=False)
            q = part.column("q").to_numpy()
            order = np.cumsum(np.concatenate([[0], (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])]))  # rows come by seed and id
            owner, start = _repeated_starts(data, offs, q, part.column("place").to_numpy(), order)
            if len(owner):
                yield _as_spans(part, owner, start)

    def windows_of(batches):
        for part in batches:
            data, offs = _texts_of(part)
            owner, start = _starts(offs[:-1], np.diff(offs) - LENGTH + 1)
            w1, w2 = _window_hashes(byte_sums(data), start)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([_signed(w1), _signed(w2), part.column("id").take(at), part.column("t").take(at),
                                              pa.array((part.column("first").to_numpy()[owner] + start - offs[owner]).astype(np.int32))],
                                             names=["w1", "w2", "id", "t", "first"])

    spans = f"id {kind}, t bigint, first int, last int"
    few = crowded(False).repartition("q").sortWithinPartitions("q", "id").mapInArrow(doubled, spans)
    windows = crowded(True).mapInArrow(windows_of, f"w1 bigint, w2 bigint, id {kind}, t bigint, first int")
    least = windows.groupBy("w1", "w2").agg(F.min("id").alias("i0"), F.max("id").alias("i1")).filter("i0 <> i1")
    single = windows.join(least, ["w1", "w2"]).filter("i0 < id").select("id", "t", "first", F.col("first").alias("last"))
    return whole.unionByName(few).unionByName(single)


def _runs(covered: np.ndarray) -> tuple[int, int]:
    """(bytes, maximal runs) that are covered."""
    edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
    return int(covered.sum()), int((edge == 1).sum())


def dedup_substrings(df: DataFrame, id_column: str = "doc_id", text: str = "text", keep_text: bool = False, group: int = GROUP) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept: the remaining bytes]) of every row."""
    spans = repeated_spans(df, id_column, text, group)
    per = spans.groupBy("id", "t").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    per = stored(per.select("id", "t", "spans.first", "spans.last"))
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    touched, others = split_rows(rows, per, "id", "t")  # only the first are shuffled
    joined = touched.join(per, ["id", "t"], "left").select("id", "text", "first", "last")
    alone = others.select("id", "text", *[F.lit(None).cast("array<int>").alias(c) for c in ("first", "last")])
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"{id_column} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_text else "")
    names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                part = b.slice(lo, hi - lo)
                s = Seeds(data, offs)
                step = np.zeros(len(data) + 1, np.int32)
                own = _own_repeats(s)
                np.add.at(step, own, 1)
                np.add.at(step, own + LENGTH, -1)
                for d in range(hi - lo):
                    if part.column(2)[d].is_valid:
                        first = part.column(2)[d].values.to_numpy(zero_copy_only=False) + offs[d]
                        last = part.column(3)[d].values.to_numpy(zero_copy_only=False) + offs[d] + LENGTH
                        np.add.at(step, first, 1)
                        np.add.at(step, last, -1)
                covered = np.cumsum(step[:-1]) > 0
                size, gone, spans, digest, kept = [], [], [], [], []
                for d in range(hi - lo):
                    x, y = int(offs[d]), int(offs[d + 1])
                    n, k = _runs(covered[x:y])
                    rest = data[x:y][~covered[x:y]].tobytes() if n else data[x:y].tobytes()
                    size.append(y - x)
                    gone.append(n)
                    spans.append(k)
                    digest.append(hashlib.sha256(rest).hexdigest())
                    if keep_text:
                        kept.append(rest)
                cols = [part.column(0), *(pa.array(v, pa.int64()) for v in (size, gone, spans)), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays([*cols, *([pa.array(kept, pa.binary())] if keep_text else [])], names=names)

    return joined.mapInArrow(run, schema).unionByName(alone.mapInArrow(run, schema))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed runs and the digest of what is left, of every document."""
    return dedup_substrings(table(spark, sf_dir, "documents"))


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLE: dict[str, str] = {}
