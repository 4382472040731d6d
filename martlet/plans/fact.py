"""Fact table builder (J3 inner+left enrich, P1 prune, P2 margin, P3 year_month, P4 status).

One row per order item of a delivered order, enriched with its dimensions.
Dimension sides are left-joined; each dimension is keyed by its id (one row per
key), so the left joins keep the row count of the inner step. Catalyst prunes the
columns that the downstream query does not read and pushes the status filter into
the orders scan. Written partitioned by ``year_month`` (S3) so month filters prune
whole folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import year_month
from ..sources.mart import Star, with_status

FACT_COLUMNS = [
    "order_id", "product_id", "seller_id", "quantity", "line_total", "customer_id", "order_date",
    "state", "is_rural", "age", "category", "cost_price", "seller_name", "rating", "method",
    "delivery_days", "on_time", "margin", "year_month",
]


def build_fact(s: Star) -> DataFrame:
    delivered = with_status(s.orders, "delivered").select("order_id", "customer_id", "order_date")
    # the three order_id-keyed joins run back to back: the item side is shuffled by
    # order_id once and keeps that partitioning through all three
    fact = (s.order_items
            .join(delivered, "order_id", "inner")
            .join(s.payments.select("order_id", "method"), "order_id", "left")
            .join(s.deliveries.select("order_id", "delivery_days", "on_time"), "order_id", "left")
            .join(s.customers.select("customer_id", "state", "is_rural", "age"), "customer_id", "left")
            .join(s.products.select("product_id", "category", "cost_price"), "product_id", "left")
            .join(s.sellers.select("seller_id", "seller_name", "rating"), "seller_id", "left"))
    fact = fact.withColumn("margin", F.col("line_total") - F.col("cost_price") * F.col("quantity")) \
               .withColumn("year_month", year_month("order_date"))
    return fact.select(*FACT_COLUMNS)


def segment(c: str = "is_rural"):
    """Boolean -> 'Rural' / 'Urban' (null stays null, as pandas ``map`` does)."""
    return F.when(F.col(c), F.lit("Rural")).when(~F.col(c), F.lit("Urban"))


def filter_fact(fact: DataFrame, state: str = "All", category: str = "All",
                seg: str = "All") -> DataFrame:
    """P5 dashboard_filters: optional state AND category AND segment; 'All' = no filter."""
    out = fact
    if state != "All":
        out = out.filter(F.col("state") == state)
    if category != "All":
        out = out.filter(F.col("category") == category)
    if seg == "Rural":
        out = out.filter(F.col("is_rural") == F.lit(True))
    elif seg == "Urban":
        out = out.filter(F.col("is_rural") == F.lit(False))
    return out


def filter_options(fact: DataFrame, fields=("state", "category")) -> DataFrame:
    """Sorted distinct non-null values of each filter field, as (field, value) rows."""
    parts = [fact.select(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"))
             .dropna(subset=["value"]) for f in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().orderBy("field", "value")
