"""Readers, writers and chart-data guards.

Writers go through ``DataFrameWriter`` only: tasks write their own part files, so
nothing passes through the driver, and a rerun task rewrites its own file.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import SCHEMAS

# ---------------------------------------------------------------- S1 csv_scan


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str | None = None) -> DataFrame:
    """Typed CSV (header row, explicit schema, no inference)."""
    r = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    return r.csv(path)


# ---------------------------------------------------------------- S3 / S4 / S5 sinks

def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("year_month",),
                  mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> None:
    """S3: Parquet partitioned by month (month filters prune whole folders).

    Rows are rebalanced on the partition column first: a month's rows meet in few
    tasks and so in few files, and Spark splits a month that is too large for one
    task. Files end at ``max_records_per_file`` rows."""
    parts = list(partition_by)
    out = df.hint("rebalance", *parts).sortWithinPartitions(*parts) if parts else df
    w = out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (a one-row KPI frame becomes one object)."""
    sanitize(df).write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header."""
    sanitize(df).write.mode(mode).option("header", True).csv(path)


# ---------------------------------------------------------------- S8 content-named output

def content_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive table fingerprint: row count and the sum of per-row
    64-bit hashes (as a decimal, so the sum cannot overflow and does not depend on
    row order or partitioning). The hash covers the column names and which values are
    null, as a null alone leaves a row's hash unchanged."""
    parts = [p for c in df.columns for p in (F.lit(c), F.col(c).isNull(), F.col(c))]
    h = F.xxhash64(*parts).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).alias("hash_sum"))


def content_name(df: DataFrame, prefix: str = "data") -> str:
    r = content_fingerprint(df).first()
    return f"{prefix}-{int(r.rows)}-{int(r.hash_sum) & ((1 << 64) - 1):016x}"


def write_content_named(df: DataFrame, folder: str, fmt: str = "json") -> str:
    path = f"{folder.rstrip('/')}/{content_name(df)}.{fmt}"
    (write_json if fmt == "json" else write_csv)(df, path)
    return path


# ---------------------------------------------------------------- S9 sanitize

def sanitize(df: DataFrame) -> DataFrame:
    """Chart-safe columns: NaN / ±inf -> null, timestamps -> ISO text, dates ->
    ISO date text; interval columns and dotted names are rejected."""
    cols = []
    for f in df.schema.fields:
        if "." in f.name:
            raise ValueError(f"column name {f.name!r} contains '.'; rename it first")
        t, c = f.dataType, F.col(f"`{f.name}`")
        if isinstance(t, (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)):
            raise ValueError(f"column {f.name!r} is a duration; durations are not supported")
        if isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- S10 measurement type

def infer_measure_types(df: DataFrame) -> DataFrame:
    """Column -> quantitative / temporal / nominal / ordinal (from the schema)."""
    rows = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.BooleanType):
            k = "nominal"
        elif isinstance(t, T.NumericType):
            k = "quantitative"
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            k = "temporal"
        elif isinstance(t, T.StructType) and {"type", "geometry"} <= set(t.fieldNames()):
            k = "geojson"
        else:
            k = "nominal"
        rows.append((f.name, t.simpleString(), k))
    return df.sparkSession.createDataFrame(rows, "column string, spark_type string, measure string")


# ---------------------------------------------------------------- S11 row limit guard

class MaxRowsError(ValueError):
    pass


def limit_rows(df: DataFrame, max_rows: int = 5000) -> DataFrame:
    """Fail when the table holds more than ``max_rows`` rows. Reads at most
    max_rows + 1 rows, never a full count."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise MaxRowsError(f"the table has more than {max_rows} rows; aggregate it first")
    return df


# ---------------------------------------------------------------- S12 sequence source

def sequence_source(spark: SparkSession, start: float, stop: float | None = None, step: float = 1,
                    as_: str = "data") -> DataFrame:
    """Numbers start..stop (exclusive) as a distributed range; fractions give doubles."""
    if stop is None:
        start, stop = 0, start
    if any(isinstance(v, float) and v != int(v) for v in (start, stop, step)):
        n = max(0, math.ceil((stop - start) / step))
        return spark.range(n).select((F.lit(float(start)) + F.col("id") * F.lit(float(step))).alias(as_))
    start, stop, step = int(start), int(stop), int(step)
    return spark.range(start, stop, step).select(F.col("id").alias(as_))


# ---------------------------------------------------------------- S13 schema registry

def schema_for(name: str) -> T.StructType:
    """Dataset name -> schema applied at read."""
    return SCHEMAS[name]


# ---------------------------------------------------------------- S14 catalog filter

def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset catalog: one row per input table with its metadata."""
    rows = []
    for name, st in SCHEMAS.items():
        kinds = {f.dataType.simpleString() for f in st.fields}
        rows.append((name, f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet", len(st.fields),
                     any(k.startswith("timestamp") for k in kinds), any(k.startswith("array") for k in kinds)))
    return spark.createDataFrame(
        rows, "name string, path string, format string, n_columns int, temporal boolean, nested boolean")


def catalog_filter(cat: DataFrame, **equals) -> DataFrame:
    """Rows whose metadata equals every given value (AND of terms)."""
    preds = [F.col(k) == F.lit(v) for k, v in equals.items()]
    return cat.filter(reduce(lambda a, b: a & b, preds)) if preds else cat


# ---------------------------------------------------------------- S15 geojson

def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection file(s) -> one row per feature: properties.* plus
    type and geometry."""
    raw = spark.read.option("multiLine", True).json(path)
    feats = raw.select(F.explode("features").alias("f"))
    return feats.select("f.properties.*", F.col("f.type").alias("type"), F.col("f.geometry").alias("geometry"))


# ---------------------------------------------------------------- S16 inline rows

def inline_rows(spark: SparkSession, values: Sequence[Mapping] | Mapping, schema: T.StructType | str
                ) -> DataFrame:
    """``{"values": [...]}`` or a list of records, with an explicit schema."""
    recs = values["values"] if isinstance(values, Mapping) else values
    st = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    names = st.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in recs], st)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory (never a machine-local temp dir
    on a cluster)."""
    from ..session import ensure_checkpoint_dir
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"

