"""Toxicity by a classifier chain of linear models over hashed words and word beginnings.

The categories are predicted one after the other. Every model sees a text's hashed features and
the probabilities of all categories before it in the chain. While training, these probabilities
are out of fold: a row's value comes from a model that has not seen the row, so that later models
learn from values like those they will meet. When a text is scored, the models fitted on all
training rows feed each other.

Training uses a bounded sample of the labelled rows (``SAMPLE`` rows with the smallest hash of
their id); each model of a category is fitted in a task of its own. The fitted weights have a fixed
size (2**BITS numbers a category), so they are broadcast. Scoring is one Arrow pass over all whole
texts, without a shuffle.

Defined cases: a null or empty text has no features and takes the probability that the models give
to none; a labelled id without a document is not used; a null label is not used for its category;
repeated rows are scored each; without any usable label all probabilities are 0 and nothing is
toxic. Documents of other columns keep them; a column of the same name is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import WHITE, byte_sums, cut, free_name, mix, prepare, release, span, table, text_chunks

#: log2 of the number of hashed features; lengths (bytes) of the word beginnings that count too.
BITS, BEGINNINGS = 18, (4, 5, 6, 7)
#: Most labelled rows that the models are fitted on, folds of the out-of-fold values, and rounds.
SAMPLE, FOLDS, ROUNDS = 6000, 3, 150
#: Strength of the penalty on the weights, and the probability from which a text is toxic.
PENALTY, THRESHOLD = 2e-5, 0.3

_SPLIT = WHITE.copy()
_SPLIT[[c for c in range(128) if not chr(c).isalnum()]] = True
_SIGN = _SPLIT & ~WHITE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of the texts: log(1 + count) per hashed word, word beginning
    and punctuation sign, each document scaled to length one. Sorted by document."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.float32)
    inside = ~_SPLIT[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offs[:-1]] = True
    start = np.flatnonzero(inside & ~(np.concatenate([[False], inside[:-1]]) & ~breaks[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate([inside[1:], [False]]) & ~breaks[1:])) + 1
    sums = byte_sums(_LOWER[data])
    doc = np.searchsorted(offs, start, "right") - 1
    signs = np.flatnonzero(_SIGN[data])
    keys = [(doc, mix(span(sums, start, end))), (np.searchsorted(offs, signs, "right") - 1, mix(data[signs].astype(np.uint64)))]
    for n in BEGINNINGS:
        long = end - start > n
        keys.append((doc[long], mix(span(sums, start[long], start[long] + n) + np.uint64(n))))
    doc = np.concatenate([d for d, _ in keys])
    at = np.concatenate([h for _, h in keys]) >> np.uint64(64 - BITS)
    both, count = np.unique((doc.astype(np.uint64) << np.uint64(BITS)) | at, return_counts=True)
    doc, at = (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value * value, len(offs) - 1))
    return doc, at, (value / norm[doc]).astype(np.float32)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(doc: np.ndarray, at: np.ndarray, value: np.ndarray, extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression: hashed features, then one per column of ``extra``, then
    the constant. Full-batch Adam with a quadratic penalty."""
    n, k = extra.shape
    size = (1 << BITS) + k + 1
    used = np.flatnonzero(np.bincount(at, minlength=1 << BITS))
    number = np.zeros(1 << BITS, np.int64)
    number[used] = np.arange(len(used))
    at = number[at]
    w, m, v = (np.zeros(len(used) + k + 1) for _ in range(3))
    rate = y.mean()
    w[-1] = np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
    weight = np.where(y > 0, 0.5 / max(rate, 1e-6), 0.5 / max(1 - rate, 1e-6)) / n
    for t in range(1, ROUNDS + 1):
        each = w[at]
        each *= value
        z = np.bincount(doc, each, n) + extra @ w[len(used):-1] + w[-1]
        r = (_logistic(z) - y) * weight
        np.take(r, doc, out=each)
        each *= value
        g = np.concatenate([np.bincount(at, each, len(used)), extra.T @ r, [r.sum()]])
        g[:-1] += PENALTY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 / (1 + t / 40) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    out = np.zeros(size)
    out[used], out[1 << BITS:] = w[:len(used)], w[len(used):]
    return out


def predict(w: np.ndarray, doc: np.ndarray, at: np.ndarray, value: np.ndarray, extra: np.ndarray) -> np.ndarray:
    n = len(extra)
    return _logistic(np.bincount(doc, value * w[at], n) + extra @ w[1 << BITS:-1] + w[-1])


def _matrix(pdf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(pdf)), pdf["at"].str.len())
    at = np.concatenate([np.zeros(0, np.int32), *pdf["at"]])
    return doc, at, np.concatenate([np.zeros(0, np.float32), *pdf["value"]])


class Chain:
    """Weights per category, in the order of the chain; an empty entry predicts 0."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    def score(self, doc: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for w in self.weights:
            p = predict(w, doc, at, value, out) if len(w) else np.zeros(n)
            out = np.column_stack([out, p])
        return out


def _fit_and_predict(k: int):
    """Of one model of category ``k``: a row of weights (all rows), or the left-out fold's predictions."""
    def one(pdf):
        import pandas as pd
        pdf = pdf.sort_values("id", ignore_index=True)
        model = int(pdf["model"].iloc[0])
        y = np.array([x[k] if x[k] is not None else np.nan for x in pdf["y"]], float)
        use = ~np.isnan(y) & (pdf["fold"].to_numpy() != model)
        seen = pdf[use].reset_index(drop=True)
        if not len(seen) or len(set(y[use])) < 2:
            w = np.zeros(0)
        else:
            w = fit(*_matrix(seen), np.array(list(seen["oof"]), float).reshape(len(seen), k), y[use])
        rest = pdf[pdf["fold"] == model].reset_index(drop=True)
        p = predict(w, *_matrix(rest), np.array(list(rest["oof"]), float).reshape(len(rest), k)) if len(w) else np.zeros(len(rest))
        out = pd.DataFrame({"id": rest["id"], "p": p, "w": None})
        if model < 0:
            out = pd.DataFrame({"id": pdf["id"].iloc[:1], "p": [0.0], "w": [w.astype(np.float32).tobytes()]})
        del pdf, seen
        release()
        return out

    return one


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, Column]], id_column: str = "doc_id",
          text: str = "text", sample: int = SAMPLE, folds: int = FOLDS) -> tuple[Chain, DataFrame | None]:
    """The fitted chain, and the sample's rows (id, y: labels, oof: out-of-fold probabilities)."""
    prepare(docs.sparkSession)
    marked = labels.select(F.col(id_column).alias("id"), F.array(*[c.cast("double") for _, c in categories]).alias("y"))
    marked = marked.filter(F.col("id").isNotNull()).dropDuplicates(["id"])
    order = F.xxhash64("id")
    few = cut(marked.orderBy(order, "id").limit(sample))  # the documented bound of the training rows
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(few), "id")  # SAMPLE rows at most
    rows = rows.dropDuplicates(["id"])
    schema = "id {}, y array<double>, fold int, at array<int>, value array<float>".format(docs.schema[id_column].dataType.simpleString())

    def featurize(batches):
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, 1):
                doc, at, value = features(data, offs)
                split = np.searchsorted(doc, np.arange(1, hi - lo))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(np.split(at.astype(np.int32), split), pa.list_(pa.int32())),
                     pa.array(np.split(value, split), pa.list_(pa.float32()))], names=["id", "y", "fold", "at", "value"])

    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int")
    got = cut(rows.select("id", "text", "y", fold.alias("fold")).mapInArrow(featurize, schema)
              .withColumn("oof", F.array().cast("array<double>")))
    weights: list[np.ndarray] = []
    for k in range(len(categories)):
        # model -1 is fitted on all rows; model f leaves out fold f and predicts it
        copies = got.withColumn("model", F.explode(F.sequence(F.lit(-1), F.lit(folds - 1))))

        done = cut(copies.groupBy("model").applyInPandas(_fit_and_predict(k), f"id {docs.schema[id_column].dataType.simpleString()}, p double, w binary"))
        w = [r[0] for r in done.filter("w is not null").select("w").collect()]  # one row of fixed size
        weights.append(np.frombuffer(w[0], np.float32).astype(float) if w else np.zeros(0))
        got = cut(got.join(done.filter("w is null").select("id", "p"), "id")
                  .select("id", "y", "fold", "at", "value", F.concat("oof", F.array("p")).alias("oof")))
    return Chain(weights), got.select(F.col("id").alias(id_column), "y", "oof")


def score(df: DataFrame, chain: Chain, names: Sequence[str], text: str = "text") -> DataFrame:
    """``df`` with a probability column of the given name per category."""
    spark = prepare(df.sparkSession)
    cols = list(names)
    df = df.drop(*cols)
    at_text = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in cols]])
    shared = spark.sparkContext.broadcast([w.astype(np.float32) for w in chain.weights])  # 2**BITS numbers each

    def run(batches):
        model = Chain(shared.value)
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, at_text):
                p = model.score(*features(data, offs), hi - lo)
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, *[pa.array(p[:, i]) for i in range(len(cols))]],
                                                 names=[*b.schema.names, *cols])
        release()

    return df.mapInArrow(run, schema)


def label_columns() -> list[tuple[str, Column]]:
    """The chain of the ``labels`` table: poor quality first, then toxic."""
    return [("poor", 1 - F.col("quality")), ("toxic", F.col("toxic"))]


def score_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, names: Sequence[str] = ("p_poor", "p_toxic")) -> DataFrame:
    """``docs`` with the two probabilities, by a chain trained on those of the documents that have labels."""
    chain, _ = train(docs, table(spark, sf_dir, "labels"), label_columns())
    return score(docs, chain, names)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic, with the columns that they have."""
    poor, toxic = (free_name(docs, c) for c in ("__p_poor", "__p_toxic"))
    return score_documents(spark, docs, sf_dir, (poor, toxic)).filter(F.col(toxic) < THRESHOLD).select(*docs.columns)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(spark, docs, sf_dir).withColumn("toxic", F.col("p_toxic") >= THRESHOLD).select("doc_id", "p_poor", "p_toxic", "toxic")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE: dict[str, str] = {}
