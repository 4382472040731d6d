"""Name -> job registry used by ``__spark_entry__`` and ``bench.py``.

Every job takes ``(spark, sf_dir)`` and returns a DataFrame that reads the input
tables under ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import chart_jobs, commerce, forecast, kpis, operator_jobs, oracle_sql
from .plans.fact import build_fact, filter_options
from .session import configure
from .sources.mart import star

Job = Callable[[SparkSession, str], DataFrame]


def _on_star(fn) -> Job:
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(star(spark, sf_dir))
    job.__name__ = fn.__name__
    job.__doc__ = fn.__doc__
    return job


def _on_fact(fn) -> Job:
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(build_fact(star(spark, sf_dir)))
    job.__name__ = fn.__name__
    job.__doc__ = fn.__doc__
    return job


def _plain(fn) -> Job:
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    job.__name__ = fn.__name__
    job.__doc__ = fn.__doc__
    return job


def _fact_report(s):
    """The fact table as reported: money as double (the table itself keeps decimals)."""
    from pyspark.sql import functions as F
    fact = build_fact(s)
    money = ("line_total", "cost_price", "margin")
    return fact.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c) for c in fact.columns])


def _series(fn):
    return lambda fact: fn(forecast.monthly_series(fact))


def _f3(fact):
    s = forecast.monthly_series(fact)
    return forecast.seasonal_index(s, forecast.trend_fit(s)).orderBy("month")


def _f4(fact):
    s = forecast.monthly_series(fact)
    seas = forecast.seasonal_index(s, forecast.trend_fit(s))
    return forecast.backtest_summary(forecast.backtest(s, seas))


def _f1(fact):
    from .functions.numeric import dbl
    s = forecast.monthly_series(fact)
    return s.select("year_month", dbl("revenue").alias("revenue"), "t", "month").orderBy("t")


def jobs() -> dict[str, Job]:
    out: dict[str, Job] = {}
    out.update({k: _on_star(f) for k, f in commerce.QUERIES.items()})
    out["fact_sales"] = _on_star(_fact_report)
    out["k1_headline_kpis"] = _on_star(kpis.headline_kpis)
    out["k2_qoq_growth"] = _on_fact(kpis.qoq_growth)
    out["k3_filtered_kpis"] = _on_fact(lambda f: kpis.filtered_kpis(f, seg="Rural"))
    out["k4_inr_format"] = _on_fact(kpis.state_revenue_cards)
    out["d1_monthly_segment_revenue"] = _on_fact(kpis.monthly_segment_revenue)
    out["d2_payment_revenue_mix"] = _on_fact(kpis.payment_revenue_mix)
    out["d3_delivery_trend"] = _on_fact(kpis.delivery_trend)
    out["d4_repeat_rate_filtered"] = _on_fact(kpis.repeat_rate_filtered)
    out["d5_age_band_revenue"] = _on_fact(kpis.age_band_revenue)
    out["d6_seller_leaderboard"] = _on_fact(kpis.seller_leaderboard)
    out["d7_category_table"] = _on_fact(kpis.category_table)
    out["d8_state_segment_revenue"] = _on_fact(kpis.state_segment_revenue)
    out["d9_history_plus_forecast"] = _on_fact(forecast.history_plus_forecast)
    out["n1_monthly_gmv"] = _on_fact(kpis.monthly_gmv)
    out["n2_rural_urban_split"] = _on_fact(kpis.rural_urban_split)
    out["n3_top_sellers_by_name"] = _on_fact(kpis.top_sellers_by_name)
    out["p6_filter_options"] = _on_fact(filter_options)
    out["f1_monthly_series"] = _on_fact(_f1)
    out["f2_linear_trend"] = _on_fact(_series(forecast.trend_fit))
    out["f3_seasonal_index"] = _on_fact(_f3)
    out["f4_rolling_backtest"] = _on_fact(_f4)
    out["f5_forecast_horizon"] = _on_fact(forecast.forecast)
    out.update({k: _plain(f) for k, f in chart_jobs.JOBS.items()})
    out.update({k: _plain(f) for k, f in operator_jobs.JOBS.items()})
    return out


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(oracle_sql.COMMERCE)
    out.update(oracle_sql.KPIS)
    out.update(oracle_sql.FORECAST)
    out["d9_history_plus_forecast"] = oracle_sql.D9
    out.update(chart_jobs.ORACLE)
    out.update(operator_jobs.ORACLE)
    return out
