"""Typed readers for the input tables (S2 parquet_scan, S13 schema_apply).

Every reader passes an explicit ``StructType``: no schema inference, and Catalyst
can prune columns and push filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                    ("c_mktsegment", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                ("p_retailprice", D)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                  ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                  ("props", S)),
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": _st(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _st(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _st(("item_id", L), ("text", S)),
    "labels": _st(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _st(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

TABLES = tuple(SCHEMAS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a typed DataFrame."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, d).orders`` reads on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def register(self) -> None:
        """Expose every table as a temp view for ``spark.sql``."""
        for n in SCHEMAS:
            getattr(self, n).createOrReplaceTempView(n)


def by_dtype(df: DataFrame, *types: type) -> list[str]:
    """S13 ``by_dtype``: names of columns whose Spark type is one of ``types``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]
