"""Headline KPIs (K1-K4), dashboard aggregates (D1-D8) and notebook views.

All of them read the fact table (``plans.fact.build_fact``). Single-value
results are one global aggregate each; values that come from another table (the
delivered-order count) or another grouping (the quarter-on-quarter growth) are
scalar subqueries: Spark runs them as their own small jobs and inlines the value,
so no join of one-row frames is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, round_half_up, sum_if
from ..session import cut_lineage
from ..sources.mart import Star, with_status
from .fact import build_fact, filter_fact, segment


def _share(num: Column, den: Column) -> Column:
    """num / den * 100 (pandas operation order)."""
    return F.try_divide(dbl(num), F.nullif(dbl(den), F.lit(0.0))) * 100


def qoq_growth(fact: DataFrame) -> DataFrame:
    """K2: revenue of the last 3 observed months vs the 3 before (missing months not filled)."""
    return _qoq_from_monthly(fact.groupBy("year_month").agg(F.sum("line_total").alias("rev")))


def _qoq_from_monthly(monthly: DataFrame) -> DataFrame:
    # one row per observed month: bounded by the calendar, not by the data volume
    ranked = monthly.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("year_month"))))
    return ranked.agg(sum_if(F.col("rn") <= 3, "rev").alias("last3"),
                      sum_if(F.col("rn").between(4, 6), "rev").alias("prev3")) \
                 .select(dbl("last3").alias("last3"), dbl("prev3").alias("prev3"),
                         (F.try_divide(dbl(F.col("last3") - F.col("prev3")),
                                       F.nullif(dbl("prev3"), F.lit(0.0))) * 100).alias("qoq"))


def headline_kpis(s: Star, fact: DataFrame | None = None) -> DataFrame:
    """K1: eight headline numbers as one row.

    One pass over the fact: a rollup on ``year_month`` yields the per-month revenue
    rows (for K2) and the grand-total row together; that result (months + 1 rows)
    is checkpointed and read twice. The delivered-order count (orders without items
    included) is a scalar subquery on the orders table."""
    fact = fact if fact is not None else build_fact(s)
    n_orders = with_status(s.orders, "delivered").select(F.countDistinct("order_id")).scalar()
    r = fact.rollup("year_month").agg(
        F.sum("line_total").alias("rev"),
        F.countDistinct("customer_id").alias("active_customers"),
        F.countDistinct("seller_id").alias("active_sellers"),
        sum_if(F.col("is_rural"), "line_total").alias("rural"),
        F.sum(F.col("on_time").cast("int")).alias("on_time_n"),
        F.count("on_time").alias("on_time_d"),
        F.grouping("year_month").alias("_total"))
    r = cut_lineage(r)
    monthly = r.filter(F.col("_total") == 0).select("year_month", "rev")
    qoq = _qoq_from_monthly(monthly).select("qoq").scalar()
    base = r.filter(F.col("_total") == 1)
    return base.select(
        round_half_up(dbl("rev"), 2).alias("total_revenue"),
        n_orders.alias("total_orders"),
        "active_customers", "active_sellers",
        round_half_up(F.try_divide(dbl("rev"), n_orders), 2).alias("avg_order_value"),
        round_half_up(_share(F.col("rural"), F.col("rev")), 2).alias("rural_share_pct"),
        round_half_up(_share(F.col("on_time_n"), F.col("on_time_d")), 2).alias("on_time_delivery_pct"),
        round_half_up(qoq, 2).alias("qoq_growth_pct"),
    )


def filtered_kpis(fact: DataFrame, state: str = "All", category: str = "All",
                  seg: str = "All") -> DataFrame:
    """K3: the dashboard cards over the filtered fact; AOV divides by max(orders, 1)."""
    df = filter_fact(fact, state, category, seg)
    return df.agg(F.sum("line_total").alias("rev"),
                  F.countDistinct("order_id").alias("orders"),
                  F.countDistinct("customer_id").alias("customers"),
                  F.countDistinct("seller_id").alias("active_sellers"),
                  F.avg("delivery_days").alias("avg_days")) \
             .select(F.coalesce(dbl("rev"), F.lit(0.0)).alias("revenue"), "orders", "customers",
                     round_half_up(F.coalesce(dbl("rev"), F.lit(0.0))
                                   / F.greatest(F.col("orders"), F.lit(1)), 2).alias("aov"),
                     "active_sellers",
                     round_half_up("avg_days", 2).alias("avg_delivery_days"))


def inr_format(c: str | Column) -> Column:
    """K4: Indian-unit money text: >= 1e7 -> 'Cr', >= 1e5 -> 'L', else grouped integer.

    The value is quantised before formatting so the printed digits do not depend
    on the formatter's tie rule."""
    x = dbl(c) if isinstance(c, str) else dbl(c)
    cr = F.format_string("%.2f", round_half_up(x / 1e7, 2))
    lk = F.format_string("%.2f", round_half_up(x / 1e5, 2))
    whole = F.format_string("%,.0f", F.floor(x + 0.5).cast("double"))
    return (F.when(x >= 1e7, F.concat(F.lit("₹"), cr, F.lit(" Cr")))
            .when(x >= 1e5, F.concat(F.lit("₹"), lk, F.lit(" L")))
            .otherwise(F.concat(F.lit("₹"), whole)))


def state_revenue_cards(fact: DataFrame) -> DataFrame:
    """K4 applied: revenue and AOV cards per state."""
    g = fact.groupBy("state").agg(F.sum("line_total").alias("rev"),
                                  F.countDistinct("order_id").alias("orders"))
    return g.select("state", dbl("rev").alias("revenue"), inr_format(dbl("rev")).alias("revenue_inr"),
                    inr_format(dbl("rev") / F.greatest(F.col("orders"), F.lit(1))).alias("aov_inr"))


# ---------------------------------------------------------------- dashboard tabs

def _keyed(fact: DataFrame, *keys: str) -> DataFrame:
    """The rows whose group keys are all known."""
    return fact.dropna(subset=list(keys))


def monthly_segment_revenue(fact: DataFrame) -> DataFrame:
    """D1. Rows without a group key are left out, here and in the other tabs."""
    return _keyed(fact, "year_month", "is_rural").groupBy("year_month", segment().alias("seg")) \
               .agg(dbl(F.sum("line_total")).alias("line_total")) \
               .orderBy("year_month", "seg")


def payment_revenue_mix(fact: DataFrame) -> DataFrame:
    """Revenue by method and its share of the total."""
    g = _keyed(fact, "method").groupBy("method").agg(F.sum("line_total").alias("rev"))
    total = F.sum("rev").over(Window.partitionBy())  # one row per method
    return g.select("method", dbl("rev").alias("line_total"),
                    round_half_up(_share(F.col("rev"), total), 2).alias("share_pct")) \
            .orderBy(F.desc("line_total"), "method")


def delivery_trend(fact: DataFrame) -> DataFrame:
    """D3: mean delivery days by (month, segment)."""
    return _keyed(fact, "year_month", "is_rural").groupBy("year_month", segment().alias("segment")) \
               .agg(F.avg("delivery_days").alias("avg_days")) \
               .orderBy("year_month", "segment")


def repeat_rate_filtered(fact: DataFrame) -> DataFrame:
    """Share of customers with more than one order in the (filtered) fact."""
    per = _keyed(fact, "customer_id").groupBy("customer_id").agg(F.countDistinct("order_id").alias("n"))
    return per.agg(round_half_up(_share(F.sum((F.col("n") > 1).cast("int")), F.count(F.lit(1))), 1)
                   .alias("repeat_rate_pct"))


AGE_BANDS = [(17, 25, "18-25"), (25, 35, "26-35"), (35, 45, "36-45"), (45, 55, "46-55"),
             (55, 65, "56-65")]


def age_band(c: str = "age") -> Column:
    """Right-closed bands (17,25] ... (55,65]; outside -> null."""
    out = None
    for lo, hi, label in AGE_BANDS:
        cond = (F.col(c) > lo) & (F.col(c) <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def age_band_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per age band; empty bands and ages outside the bands are omitted."""
    return fact.select(age_band().alias("age_band"), "line_total").dropna(subset=["age_band"]) \
               .groupBy("age_band").agg(dbl(F.sum("line_total")).alias("line_total")) \
               .orderBy("age_band")


def seller_leaderboard(fact: DataFrame, k: int = 20) -> DataFrame:
    """Top sellers; rating depends on the seller only, so max() = first()."""
    g = _keyed(fact, "seller_id", "seller_name").groupBy("seller_id", "seller_name").agg(
        F.sum("line_total").alias("rev"),
        F.countDistinct("order_id").alias("orders"),
        round_half_up(F.avg(F.col("on_time").cast("int")) * 100, 1).alias("on_time_pct"),
        F.max("rating").alias("rating"))
    return g.select("seller_id", "seller_name", dbl("rev").alias("revenue"), "orders",
                    "on_time_pct", "rating") \
            .orderBy(F.desc("revenue"), "seller_id").limit(k)


def category_table(fact: DataFrame) -> DataFrame:
    """Revenue, margin and margin % (1 dp) per category."""
    g = _keyed(fact, "category").groupBy("category").agg(F.sum("line_total").alias("rev"), F.sum("margin").alias("mar"))
    return g.select("category", dbl("rev").alias("revenue"), dbl("mar").alias("margin"),
                    round_half_up(_share(F.col("mar"), F.col("rev")), 1).alias("margin_pct")) \
            .orderBy(F.desc("revenue"), "category")


def state_segment_revenue(fact: DataFrame) -> DataFrame:
    """D8."""
    return _keyed(fact, "state", "is_rural").groupBy("state", segment().alias("seg")) \
               .agg(dbl(F.sum("line_total")).alias("line_total")).orderBy("state", "seg")


# ---------------------------------------------------------------- notebook

def monthly_gmv(fact: DataFrame) -> DataFrame:
    """N1."""
    return fact.groupBy("year_month").agg(dbl(F.sum("line_total")).alias("line_total")) \
               .orderBy("year_month")


def rural_urban_split(fact: DataFrame) -> DataFrame:
    """Pandas groupby drops the null key."""
    return fact.select(segment().alias("is_rural"), "line_total").dropna(subset=["is_rural"]) \
               .groupBy("is_rural").agg(dbl(F.sum("line_total")).alias("line_total"))


def top_sellers_by_name(fact: DataFrame, k: int = 10) -> DataFrame:
    """By seller name (sellers sharing a name merge)."""
    return _keyed(fact, "seller_name").groupBy("seller_name").agg(dbl(F.sum("line_total")).alias("line_total")) \
               .orderBy(F.desc("line_total"), "seller_name").limit(k)


def dashboard(fact: DataFrame, state: str = "All", category: str = "All",
              seg: str = "All") -> dict[str, DataFrame]:
    """Every dashboard panel for one filter selection (P5), as named DataFrames over
    the same filtered fact. The forecast tab uses the unfiltered fact, as the
    dashboard does."""
    from .forecast import history_plus_forecast
    df = filter_fact(fact, state, category, seg)
    return {
        "cards": filtered_kpis(fact, state, category, seg),
        "monthly_segment_revenue": monthly_segment_revenue(df),
        "payment_mix": payment_revenue_mix(df),
        "delivery_trend": delivery_trend(df),
        "repeat_rate": repeat_rate_filtered(df),
        "age_bands": age_band_revenue(df),
        "seller_leaderboard": seller_leaderboard(df),
        "category_table": category_table(df),
        "state_segment_revenue": state_segment_revenue(df),
        "history_plus_forecast": history_plus_forecast(fact),
    }
