"""A corpus pipeline of five stages over the documents table.

Every stage takes all documents that the one before kept. ``run`` writes each stage's result as
Parquet under the session's checkpoint folder, reads it again for the next, and drops the folder of
the stage before it. Rows are told apart by ids of their own: those with a null or a repeated
``doc_id`` are documents like all others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import decontaminate, jaccard_join, line_dedup, sentencepiece_codec, toxicity
from martlet.llm._common import cut, free_name, own_ids, table
from martlet.session import ensure_checkpoint_dir

#: Words of a shingle and similarity (in hundredths) of near duplicates.
SHINGLE, SIMILAR = 5, 80


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    return toxicity.without_toxic(spark, docs, sf_dir)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly so, go; documents stay. ``n_chars`` follows the text."""
    counts = free_name(docs, "__n_lines"), free_name(docs, "__n_removed")
    out = line_dedup.line_dedup(docs, counts=counts).drop(*counts)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document of smallest id stays, one without an id
    only if none has one; of rows that share that id, one."""
    key, other = free_name(docs, "__own"), free_name(docs, "__id")
    own = own_ids(docs, key, repeats=True)
    groups = jaccard_join.jaccard_components(own, id_column=key, size=SHINGLE, num=SIMILAR, den=100).filter("n_shingles > 0")
    rows = cut(groups.select(key, "component_id").join(own.select(key, "doc_id"), key))
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("x"))
    others = rows.join(first.select(f"x.{key}"), key, "left_anti").select(F.col(key).alias(other))
    return own.join(others, own[key] == others[other], "left_anti").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    key, other = free_name(docs, "__own"), free_name(docs, "__id")
    own = own_ids(docs, key, repeats=True)
    leaks = decontaminate.contaminated(own, table(spark, sf_dir, "benchmark"), id_column=key)
    leaks = leaks.select(F.col(key).alias(other)).distinct()
    return own.join(leaks, own[key] == leaks[other], "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every document, with the end id."""
    out = sentencepiece_codec.encode_column(docs.select("doc_id", "text"), sentencepiece_codec.default_model())
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("tokens", tokens),
]

#: Trained models and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
