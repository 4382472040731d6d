"""Star-schema views over the input tables.

The commerce workload is written against seven tables (customers, sellers,
products, orders, order_items, payments, deliveries). They are derived from the
TPC-H-style inputs with plain projections; money becomes ``decimal(18,2)`` so that
sums are exact and identical in every engine.

Fixed mapping (also used verbatim by the oracle SQL):
  orders.status       F -> delivered, O -> cancelled, P -> returned
  customers.is_rural  n_regionkey IN (0, 2)
  customers.age       18 + c_custkey % 47
  deliveries          delivery_days = 1 + o_orderkey % 7, on_time = delivery_days <= 5
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


STATUS_CODE = {"delivered": "F", "cancelled": "O", "returned": "P"}


def with_status(orders: DataFrame, status: str) -> DataFrame:
    """Orders of one status, filtered on the raw code (pushed down to the scan)."""
    return orders.filter(F.col("status_code") == STATUS_CODE[status])


@dataclass
class Star:
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    payments: DataFrame
    deliveries: DataFrame

    def register(self) -> None:
        for name in ("orders", "order_items", "customers", "products", "sellers", "payments",
                     "deliveries"):
            getattr(self, name).createOrReplaceTempView(f"star_{name}")


def star(spark: SparkSession, sf_dir: str) -> Star:
    t = Tables(spark, sf_dir)
    nation = t.nation
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "cancelled")
        .when(F.col("o_orderstatus") == "P", "returned").alias("status"),
        # the raw code travels along so status filters reach the Parquet scan
        F.col("o_orderstatus").alias("status_code"),
    )
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("line_total"),
    )
    customers = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("state"),
        F.col("n_regionkey").isin(0, 2).alias("is_rural"),
        (F.lit(18) + F.col("c_custkey") % 47).cast("int").alias("age"),
    )
    products = t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        money("p_retailprice").alias("cost_price"),
    )
    sellers = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.col("n_name").alias("state"),
        F.col("s_acctbal").alias("rating"),
    )
    payments = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("method"),
        money("o_totalprice").alias("amount"),
    )
    days = (F.lit(1) + F.col("o_orderkey") % 7).cast("double")
    deliveries = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        days.alias("delivery_days"),
        (days <= 5).alias("on_time"),
    )
    return Star(orders, items, customers, products, sellers, payments, deliveries)


# The same mapping as SQL text, for engines that take SQL (the DuckDB oracle).
STAR_SQL = """
star_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'cancelled'
                            WHEN 'P' THEN 'returned' END AS status
  FROM orders),
star_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total
  FROM lineitem),
star_customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, n_name AS state,
         n_regionkey IN (0, 2) AS is_rural, CAST(18 + c_custkey % 47 AS INTEGER) AS age
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
star_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS cost_price
  FROM part),
star_sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_name, n_name AS state, s_acctbal AS rating
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
star_payments AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS method,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders),
star_deliveries AS (
  SELECT o_orderkey AS order_id, CAST(1 + o_orderkey % 7 AS DOUBLE) AS delivery_days,
         CAST(1 + o_orderkey % 7 AS DOUBLE) <= 5 AS on_time
  FROM orders)
"""
