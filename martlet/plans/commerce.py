"""The fifteen analytics queries of the commerce workload (Q1-Q15).

Each is a function ``Star -> DataFrame``. Joins are plain equi-joins; Catalyst
broadcasts a dimension only when its estimated size is below the session's
broadcast threshold and sorts/merges otherwise, and AQE splits skewed join
partitions. Aggregations are partial + final (map-side combine), so a hot key
(one month or one seller holding a third of the rows) is reduced before the
shuffle. Money is summed as decimal and rounded in double by a fixed rule.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import count_if, dbl, pct2, round_half_up, sum_if, year_month
from ..operators.ranking import global_ntile
from ..session import cut_lineage
from ..sources.mart import Star, with_status


# Reference point for recency (the reference used the wall clock).
DEFAULT_AS_OF = _dt.datetime(2002, 1, 1)


def _delivered(s: Star) -> DataFrame:
    return with_status(s.orders, "delivered")


def q1_monthly_gmv_rural_urban(s: Star) -> DataFrame:
    rows = (_delivered(s).join(s.order_items, "order_id")
            .join(s.customers.select("customer_id", "is_rural"), "customer_id"))
    return (rows.groupBy(year_month("order_date").alias("year_month"))
            .agg(dbl(F.sum("line_total")).alias("gmv"),
                 F.countDistinct("order_id").alias("orders"),
                 dbl(sum_if(F.col("is_rural"), "line_total")).alias("rural_gmv"),
                 dbl(sum_if(~F.col("is_rural"), "line_total")).alias("urban_gmv"))
            .orderBy("year_month"))


def q2_monthly_aov(s: Star) -> DataFrame:
    rows = _delivered(s).join(s.order_items, "order_id")
    return (rows.groupBy(year_month("order_date").alias("year_month"))
            .agg(round_half_up(dbl(F.sum("line_total")) / F.countDistinct("order_id"), 2).alias("aov"))
            .orderBy("year_month"))


def q3_top_sellers(s: Star, k: int = 10) -> DataFrame:
    rows = s.order_items.join(s.sellers, "seller_id").join(_delivered(s).select("order_id"), "order_id")
    return (rows.groupBy("seller_id", "seller_name", "state", "rating")
            .agg(dbl(F.sum("line_total")).alias("revenue"),
                 F.countDistinct("order_id").alias("orders"))
            .orderBy(F.desc("revenue"), "seller_id").limit(k))


def q4_category_margin(s: Star) -> DataFrame:
    rows = (s.order_items.join(s.products.select("product_id", "category", "cost_price"), "product_id")
            .join(_delivered(s).select("order_id"), "order_id"))
    margin = F.col("line_total") - F.col("cost_price") * F.col("quantity")
    return (rows.groupBy("category")
            .agg(F.sum("line_total").alias("_rev"), F.sum(margin).alias("_margin"))
            .select("category", dbl("_rev").alias("revenue"), dbl("_margin").alias("margin"),
                    pct2("_margin", "_rev").alias("margin_pct"))
            .orderBy(F.desc("revenue"), "category"))


def q5_state_revenue_rural_share(s: Star) -> DataFrame:
    rows = (s.order_items.join(_delivered(s).select("order_id", "customer_id"), "order_id")
            .join(s.customers.select("customer_id", "state", "is_rural"), "customer_id"))
    return (rows.groupBy("state")
            .agg(F.sum("line_total").alias("_rev"),
                 sum_if(F.col("is_rural"), "line_total").alias("_rural"))
            .select("state", dbl("_rev").alias("revenue"), pct2("_rural", "_rev").alias("rural_pct"))
            .orderBy(F.desc("revenue"), "state"))


def q6_cohort_retention(s: Star) -> DataFrame:
    # (customer, month) pairs first: map-side combine bounds a hot customer to one
    # row per month before the per-customer window.
    active = (_delivered(s).select("customer_id", year_month("order_date").alias("active_month"))
              .distinct())
    cohort = active.withColumn(
        "cohort", F.min("active_month").over(Window.partitionBy("customer_id")))
    return (cohort.groupBy("cohort", "active_month")
            .agg(F.count(F.lit(1)).alias("active_customers"))
            .orderBy("cohort", "active_month"))


def q7_repeat_rate(s: Star) -> DataFrame:
    per_cust = (_delivered(s).groupBy("customer_id")
                .agg(F.countDistinct("order_id").alias("orders_count")))
    return per_cust.agg(pct2(count_if(F.col("orders_count") > 1), F.count(F.lit(1)))
                        .alias("repeat_rate_pct"))


def q8_payment_mix(s: Star) -> DataFrame:
    by_method = s.payments.groupBy("method").agg(F.count(F.lit(1)).alias("txns"),
                                                  F.sum("amount").alias("_vol"))
    # window over the aggregated rows only: one row per payment method
    total = F.sum("txns").over(Window.partitionBy())
    return (by_method.select("method", "txns", pct2(F.col("txns"), total).alias("share_pct"),
                             dbl("_vol").alias("volume"))
            .orderBy(F.desc("share_pct"), "method"))


def _segment(c: str = "is_rural"):
    return F.when(F.col(c), "Rural").otherwise("Urban")


def q9_delivery_efficiency(s: Star) -> DataFrame:
    rows = (s.deliveries.join(s.orders.select("order_id", "customer_id"), "order_id")
            .join(s.customers.select("customer_id", "is_rural"), "customer_id"))
    return (rows.groupBy(_segment().alias("segment"))
            .agg(round_half_up(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
                 pct2(count_if(F.col("on_time")), F.count(F.lit(1))).alias("on_time_pct")))


def rfm_base(s: Star, as_of: _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    rows = _delivered(s).join(s.order_items, "order_id")
    # timestamp_ntz on both sides: no session time zone (and no DST hour) involved
    secs = F.timestamp_diff("SECOND", F.max("order_date"), F.lit(as_of).cast("timestamp_ntz"))
    recency = secs.cast("double") / 86400
    return rows.groupBy("customer_id").agg(
        recency.alias("recency"),
        F.countDistinct("order_id").alias("frequency"),
        dbl(F.sum("line_total")).alias("monetary"))


def q10_rfm_scores(s: Star, as_of: _dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    # one row per customer, read by three scores: checkpointed so the order-item
    # join runs once
    base = cut_lineage(rfm_base(s, as_of))
    r = global_ntile(base.select("customer_id", "recency"), 5, [F.desc("recency"), "customer_id"], "r_score")
    f = global_ntile(base.select("customer_id", "frequency"), 5, ["frequency", "customer_id"], "f_score")
    m = global_ntile(base.select("customer_id", "monetary"), 5, ["monetary", "customer_id"], "m_score")
    scored = base.join(r.select("customer_id", "r_score"), "customer_id") \
                 .join(f.select("customer_id", "f_score"), "customer_id") \
                 .join(m.select("customer_id", "m_score"), "customer_id")
    return scored.select("customer_id", "recency", "frequency", "monetary",
                         "r_score", "f_score", "m_score")


def category_month_revenue(s: Star) -> DataFrame:
    rows = (s.order_items.join(s.products.select("product_id", "category"), "product_id")
            .join(_delivered(s).select("order_id", "order_date"), "order_id"))
    return rows.groupBy("category", year_month("order_date").alias("ym")) \
               .agg(F.sum("line_total").alias("rev"))


def q11_growing_categories(s: Star) -> DataFrame:
    m = category_month_revenue(s)
    # DENSE_RANK over month text = rank among distinct months; that table has one
    # row per calendar month, so its unpartitioned window stays tiny.
    months = m.select("ym").distinct().withColumn(
        "rk", F.dense_rank().over(Window.orderBy(F.desc("ym"))))
    ranked = m.join(months, "ym")
    last3 = sum_if(F.col("rk") <= 3, "rev")
    prev3 = sum_if(F.col("rk").between(4, 6), "rev")
    out = ranked.groupBy("category").agg(last3.alias("_l"), prev3.alias("_p"))
    return (out.select("category", dbl("_l").alias("last_3m"), dbl("_p").alias("prev_3m"),
                       pct2(dbl("_l") - dbl("_p"), "_p").alias("growth_pct"))
            .orderBy(F.desc_nulls_last("growth_pct"), "category"))


def q12_customer_ltv(s: Star, k: int = 20) -> DataFrame:
    rows = (_delivered(s).select("order_id", "customer_id").join(s.order_items, "order_id")
            .join(s.customers.select("customer_id", "name", "state", "is_rural"), "customer_id"))
    return (rows.groupBy("customer_id", "name", "state", "is_rural")
            .agg(dbl(F.sum("line_total")).alias("ltv"), F.countDistinct("order_id").alias("orders"))
            .orderBy(F.desc("ltv"), "customer_id").limit(k))


def q13_cancel_return_rate(s: Star) -> DataFrame:
    rows = (s.orders.select("order_id", "status").join(s.order_items, "order_id")
            .join(s.products.select("product_id", "category"), "product_id"))
    n = F.count(F.lit(1))
    return (rows.groupBy("category")
            .agg(pct2(count_if(F.col("status") == "cancelled"), n).alias("cancel_pct"),
                 pct2(count_if(F.col("status") == "returned"), n).alias("return_pct"))
            .orderBy(F.desc("return_pct"), "category"))


def q14_seller_scorecard(s: Star) -> DataFrame:
    rows = (s.order_items.join(_delivered(s).select("order_id"), "order_id")
            .join(s.deliveries, "order_id")
            .join(s.sellers.select("seller_id", "seller_name", "rating"), "seller_id"))
    return (rows.groupBy("seller_id", "seller_name", "rating")
            .agg(dbl(F.sum("line_total")).alias("revenue"),
                 round_half_up(F.avg("delivery_days"), 2).alias("avg_delivery"),
                 pct2(count_if(F.col("on_time")), F.count(F.lit(1))).alias("on_time_pct"))
            .orderBy(F.desc("revenue"), "seller_id"))


def q15_new_vs_returning(s: Star) -> DataFrame:
    d = _delivered(s).select("order_id", "customer_id", "order_date",
                             F.to_date("order_date").alias("day"))
    # per-customer minimum is a partial+final aggregate; joining it back lets AQE
    # split a hot customer's partition instead of windowing all its orders in one task
    first = d.groupBy("customer_id").agg(F.min("day").alias("first_order_date"))
    rows = d.join(first, "customer_id").join(s.order_items, "order_id")
    return (rows.groupBy(year_month("order_date").alias("ym"))
            .agg(dbl(sum_if(F.col("day") == F.col("first_order_date"), "line_total")).alias("new_cust_rev"),
                 dbl(sum_if(F.col("day") > F.col("first_order_date"), "line_total")).alias("returning_rev"))
            .orderBy("ym"))


QUERIES = {
    "q1_monthly_gmv_rural_urban": q1_monthly_gmv_rural_urban,
    "q2_monthly_aov": q2_monthly_aov,
    "q3_top_sellers": q3_top_sellers,
    "q4_category_margin": q4_category_margin,
    "q5_state_revenue_rural_share": q5_state_revenue_rural_share,
    "q6_cohort_retention": q6_cohort_retention,
    "q7_repeat_rate": q7_repeat_rate,
    "q8_payment_mix": q8_payment_mix,
    "q9_delivery_efficiency": q9_delivery_efficiency,
    "q10_rfm_scores": q10_rfm_scores,
    "q11_growing_categories": q11_growing_categories,
    "q12_customer_ltv": q12_customer_ltv,
    "q13_cancel_return_rate": q13_cancel_return_rate,
    "q14_seller_scorecard": q14_seller_scorecard,
    "q15_new_vs_returning": q15_new_vs_returning,
}
