"""Language identification by error-correcting output codes.

Every language is given a codeword of +1 and -1. For each position of the codewords one binary
classifier is trained: a logistic regression over hashed n-grams of a text's bytes that tells the
languages with +1 from those with -1. With up to ``EXHAUSTIVE`` languages the code has one position
for every way to split them in two, so two codewords differ in over half of all places; with more,
its columns are drawn at random (the same ones for the same number of languages), and the draw of
largest least distance is taken.

Decoding is weighted by loss. A bit costs ``exp(-z)``, with z the margin towards the codeword's sign
in units of the place's mean margin on unseen training texts, and every place of a language's codeword weighs as much as its classifier was right
on training texts of that language (of folds it had not seen). The language of least loss is taken;
its score is its share of ``exp(-SHARPNESS * loss)`` over all languages. If the second language comes
nearer than ``CLOSE`` in score, the text is marked as ambiguous.

A model is fitted on a bounded sample: the ``PER_LANGUAGE`` documents of smallest hashed id of each
language, read whole. Each position of the code, with its folds, is fitted in a task of its own; its
input is that sample, whatever the corpus. The weights have a fixed size (2**BITS numbers a
position), so they are broadcast. Prediction is one Arrow pass over whole texts, without a shuffle;
only the text is looked at.

N-grams run over the UTF-8 bytes, letters lower-cased (A-Z, À-Þ), everything in ASCII that is no
letter taken as a space; a feature's value is its share of all n-grams of the text.

Defined cases: a null text, and one without a letter (Unicode category L), is ``und`` with score 0
and not ambiguous; without any labelled text all are; with one learned language every other text is
that, with score 1. Texts without a letter are not learned from, nor are null languages and rows
with a null id. Repeated rows are predicted each; of rows that share an id one (of smallest language
and text) is learned from. Ties go to the language first in order. Columns of the new names are
replaced, all others kept; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ._common import cut, free_name, prepare, table, text_chunks

#: log2 of the number of hashed n-grams, and their lengths in bytes.
BITS, GRAMS = 14, (1, 2, 3)
#: Most documents of a language that are learned from, folds for the weights of the places, rounds.
PER_LANGUAGE, FOLDS, ROUNDS = 400, 3, 60
#: Languages up to which all splits are used, and places of longer codes.
EXHAUSTIVE, PLACES = 5, 31
#: Penalty of the classifiers' weights, steepness of the score, and gap of an ambiguous pair.
PENALTY, SHARPNESS, CLOSE = 1e-2, 4.0, 0.2
UNKNOWN = "und"
#: Texts need a letter: Unicode category L.
LETTER = r"\p{L}"

_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    _PLAIN[_c] = ord(chr(_c).lower()) if chr(_c).isalpha() else 0x20
_MULTIPLIERS = {1: 0x9E3779B1, 2: 0x85EBCA6B, 3: 0xC2B2AE35, 4: 0x27D4EB2F}


def code(n: int) -> np.ndarray:
    """The codewords of ``n`` languages: rows of +1 and -1."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        # every split in two, the first language on the positive side
        rows = [[1, *(1 if s >> j & 1 else -1 for j in range(n - 1))] for s in range((1 << n - 1) - 1)]
        return np.array(rows, np.int8).T
    best, far = None, -1
    for seed in range(64):
        m = np.where(np.random.default_rng(seed).random((n, PLACES)) < 0.5, 1, -1).astype(np.int8)
        m[0, np.abs(m.sum(axis=0)) == n] *= -1
        least = min(int((m[a] != m[b]).sum()) for a, b in combinations(range(n), 2)) if n < 200 else 0
        if least > far:
            best, far = m, least
    return best


def _plain(data: np.ndarray) -> np.ndarray:
    """The bytes with letters lower-cased and other ASCII as spaces."""
    out = _PLAIN[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    big = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[big] += 0x20
    return out


def _grams(data: np.ndarray, offs: np.ndarray):
    """Per length of n-gram: (hashed n-gram at each place, ends of the texts' places)."""
    plain = _plain(data).astype(np.uint32)
    for n in GRAMS:
        if len(plain) < n:
            continue
        h = plain[:len(plain) - n + 1].copy()
        for j in range(1, n):
            h |= plain[j:len(plain) - n + 1 + j] << np.uint32(8 * j)
        h = (h * np.uint32(_MULTIPLIERS[n]) + np.uint32(n * 0x3C6EF372)) >> np.uint32(32 - BITS)
        yield n, h


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, share of the text's n-grams), sorted by text."""
    texts = len(offs) - 1
    keys = []
    for n, h in _grams(data, offs):
        doc = np.searchsorted(offs, np.arange(len(h)), "right") - 1
        whole = np.arange(len(h)) + n <= offs[doc + 1]
        keys.append(doc[whole] << BITS | h[whole])
    both, count = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True)
    doc, at = both >> BITS, both & (1 << BITS) - 1
    total = np.bincount(doc, count, texts)
    return doc, at, (count / total[doc]).astype(np.float32)


def margins(weights: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Mean weight of every text's n-grams per place of the code; ``weights`` has a row a feature."""
    texts = len(offs) - 1
    out, total = np.zeros((texts, weights.shape[1])), np.zeros(texts)
    for n, h in _grams(data, offs):
        # the texts' places, without n-grams that run into the next text
        lo, hi = np.minimum(offs[:-1], len(h)), np.minimum(np.maximum(offs[1:] - n + 1, offs[:-1]), len(h))
        for t in np.flatnonzero(hi > lo):
            # whole texts in pieces, so that the gathered weights stay few
            for a in range(lo[t], hi[t], 1 << 16):
                out[t] += weights[h[a:min(a + (1 << 16), hi[t])]].sum(axis=0, dtype=np.float64)
        total += hi - lo
    return out / np.maximum(total, 1)[:, None]


def fit(doc: np.ndarray, at: np.ndarray, value: np.ndarray, n: int, y: np.ndarray) -> np.ndarray:
    """Weights of one classifier (per feature; the constant is in all of them, as shares add up to
    one): logistic regression on features scaled by their spread, full batches."""
    used = np.flatnonzero(np.bincount(at, minlength=1 << BITS))
    number = np.zeros(1 << BITS, np.int64)
    number[used] = np.arange(len(used))
    at = number[at]
    k = len(used)
    mean = np.bincount(at, value, k) / n
    spread = np.sqrt(np.maximum(np.bincount(at, value.astype(float) ** 2, k) / n - mean * mean, 0)) + 1e-4
    x = value / spread[at]
    shift = mean / spread
    positive = (y > 0).mean()
    weight = np.where(y > 0, 0.5 / max(positive, 1e-9), 0.5 / max(1 - positive, 1e-9)) / n
    w, b = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(doc, x * w[at], n) - shift @ w + b
        r = -y * weight / (1 + np.exp(np.clip(y * z, -30, 30)))
        g = np.concatenate([np.bincount(at, x * r[doc], k) - shift * r.sum() + PENALTY * w, [r.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    constant = b - shift @ w
    out = np.full(1 << BITS, constant)
    out[used] += w / spread
    return out


def decode(f: np.ndarray, words: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, gap to the second language's score) of each row of margins ``f``."""
    loss = np.exp(-np.clip(f[:, None, :] * words[None], -10, 10))
    total = (loss * trust[None]).sum(axis=2)
    share = np.exp(-SHARPNESS * (total - total.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    order = np.sort(share, axis=1)
    gap = order[:, -1] - (order[:, -2] if share.shape[1] > 1 else 0)
    return best, share[np.arange(len(f)), best], gap


class Model:
    """Learned languages in order, their codewords, the places' trust, and the weights."""

    def __init__(self, languages: list[str], trust: np.ndarray, weights: np.ndarray):
        self.languages, self.words, self.trust, self.weights = languages, code(len(languages)), trust, weights

    def predict(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(offs) - 1
        if len(self.languages) == 1:
            return np.zeros(n, np.int64), np.ones(n), np.ones(n)
        return decode(margins(self.weights, data, offs), self.words, self.trust)


def _sample(rows: DataFrame) -> DataFrame:
    """(id, lang, text) of the documents to learn from: of each language those of smallest hash."""
    ids = rows.groupBy("id").agg(F.min("lang").alias("lang"))
    # by its number of documents a language gives half as many again as are wanted, whatever its size
    many = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("many"))
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) * F.col("many") < F.lit(PER_LANGUAGE * 3 << 30)
    some = ids.join(many, "lang").filter(part).select("id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 31)), "id"))
    few = cut(some.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).drop("rank"))
    texts = rows.join(F.broadcast(few), ["id", "lang"])  # PER_LANGUAGE rows a language
    return texts.groupBy("id", "lang").agg(F.min("text").alias("text"))


def _fit_place(languages: list[str]):
    def one(pdf):
        import pandas as pd
        pdf = pdf.sort_values("id", ignore_index=True)
        place = int(pdf["place"].iloc[0])
        kind = pdf["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy()
        words = code(len(languages))
        y = words[kind, place].astype(float)
        n = len(pdf)
        sizes = pdf["at"].str.len().to_numpy()
        doc = np.repeat(np.arange(n), sizes)
        at = np.concatenate([np.zeros(0, np.int64), *pdf["at"]]).astype(np.int64)
        value = np.concatenate([np.zeros(0, np.float32), *pdf["value"]])
        fold = pdf["fold"].to_numpy()
        right, left_out = np.zeros(n), np.zeros(n)
        for k in range(FOLDS):
            seen, left = fold != k, fold == k
            if len(set(y[seen])) < 2 or not left.any():
                right[left] = 1
                continue
            number = np.cumsum(seen) - 1
            part = seen[doc]
            w = fit(number[doc[part]], at[part], value[part], int(seen.sum()), y[seen])
            z = np.bincount(doc, value * w[at], n)
            right[left], left_out[left] = (z * y > 0)[left], np.abs(z)[left]
        trust = np.bincount(kind, right, len(languages)) / np.maximum(np.bincount(kind, minlength=len(languages)), 1)
        # margins count in units of the mean one of unseen texts
        w = fit(doc, at, value, n, y) / max(left_out.mean(), 1e-6)
        return pd.DataFrame({"place": [place], "trust": [trust], "w": [w.astype(np.float32).tobytes()]})

    return one


def train(df: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """The model of the labelled rows of ``df``; None if there are none."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(LETTER), F.lit(False)))
    kind = df.schema[id_column].dataType.simpleString()

    def featurize(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 2):
                doc, at, value = features(data, offs)
                split = np.searchsorted(doc, np.arange(1, hi - lo))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array(np.split(at.astype(np.int16), split), pa.list_(pa.int16())),
                     pa.array(np.split(value, split), pa.list_(pa.float32()))], names=["id", "lang", "fold", "at", "value"])

    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    got = cut(_sample(rows).select("id", "lang", "text", fold.alias("fold"))
              .mapInArrow(featurize, f"id {kind}, lang string, fold int, at array<smallint>, value array<float>"))
    languages = sorted(r[0] for r in got.select("lang").distinct().collect())  # the names only
    places = code(len(languages)).shape[1]
    if not languages:
        return None
    if not places:
        return Model(languages, np.ones((1, 0)), np.zeros((1 << BITS, 0), np.float32))
    copies = got.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(places - 1))))
    fitted = copies.groupBy("place").applyInPandas(_fit_place(languages), "place int, trust array<double>, w binary").collect()  # one row a place, of fixed size
    fitted.sort(key=lambda r: r["place"])
    trust = np.array([r["trust"] for r in fitted]).T
    trust = np.maximum(trust, 1e-6) / np.maximum(trust, 1e-6).sum(axis=1, keepdims=True)
    weights = np.column_stack([np.frombuffer(r["w"], np.float32) for r in fitted])
    return Model(languages, trust, np.ascontiguousarray(weights))


def predict(df: DataFrame, model: Model | None, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """``df`` with the text's language, its score and whether it is ambiguous."""
    spark = prepare(df.sparkSession)
    keep = [c for c in df.columns if c not in names]
    letters = F.coalesce(F.col(text).rlike(LETTER), F.lit(False))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(free_name(df, "__text")), letters.alias(free_name(df, "__letters")))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
                           T.StructField(names[2], T.BooleanType())])
    shared = spark.sparkContext.broadcast(None if model is None else (model.languages, model.trust, model.weights))  # 2**BITS numbers a place
    k = len(keep)

    def run(batches):
        own = None if shared.value is None else Model(*shared.value)
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, k):
                part = b.slice(lo, hi - lo)
                some = part.column(k + 1).to_numpy(zero_copy_only=False).astype(bool)
                if own is None:
                    some[:] = False
                    best, score, gap = np.zeros(hi - lo, np.int64), np.zeros(hi - lo), np.ones(hi - lo)
                else:
                    best, score, gap = own.predict(data, offs)
                found = [own.languages[x] if ok else UNKNOWN for x, ok in zip(best, some)]
                yield pa.RecordBatch.from_arrays([*part.columns[:k], pa.array(found, pa.string()), pa.array(np.where(some, score, 0.0)),
                                                  pa.array(some & (gap < CLOSE))], names=schema.names)

    return rows.mapInArrow(run, schema)


def remainder(doc_id: Column) -> Column:
    """crc32(id as text) mod 4; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(remainder(F.col("doc_id")) != 2))
    held_out = (remainder(F.col("doc_id")) == 2).alias("held_out")
    return predict(docs.select("doc_id", held_out, "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


QUERIES = {"op11_language_id": op11_language_id}
ORACLE: dict[str, str] = {}
