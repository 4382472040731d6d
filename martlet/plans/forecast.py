"""Seasonal sales forecast with a rolling backtest.

Linear trend (ordinary least squares of revenue on the month index) times a
seasonal index per calendar month. The least-squares fit is written from its sums
(n, Σt, Σt², Σy, Σty); the sums of money are exact decimals, so the fit does not
depend on the order rows are added in. The expanding-window backtest is the same
fit as a window aggregate over ``rows between unbounded preceding and 1 preceding``:
one pass, no driver loop.

All windows here run over the monthly series (one row per observed month), a table
bounded by the calendar span rather than by the data volume.

Kept from the reference: the seasonal index is fitted on all months (it sees the
test month), the per-split error has one point (so its "RMSE" is an absolute error:
we report it as ``mae`` plus a true ``rmse``), the last month is never tested, and
the band is a fixed ×0.88 / ×1.12.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, round_half_up
from ..session import cut_lineage

HORIZON = 6
MIN_TRAIN = 6


def exact_mean(c: str | Column) -> Column:
    """Mean of a double column with an order-independent sum (decimal, 12 places)."""
    col = F.col(c) if isinstance(c, str) else c
    return dbl(F.sum(col.cast("decimal(38,12)"))) / F.count(col)


def monthly_series(fact: DataFrame) -> DataFrame:
    """revenue per observed month with index t (0..n-1) and calendar month."""
    monthly = fact.groupBy("year_month").agg(F.sum("line_total").alias("revenue"))
    w = Window.orderBy("year_month")  # one row per month
    series = monthly.select("year_month", "revenue",
                            (F.row_number().over(w) - 1).cast("bigint").alias("t"),
                            F.substring("year_month", 6, 2).cast("int").alias("month"))
    # the fit, the seasonal index, the backtest and the horizon all read the series:
    # checkpoint it (one row per month) so the fact join runs once
    return cut_lineage(series)


def _ols(n: Column, st: Column, stt: Column, sy: Column, sty: Column):
    """slope / intercept from exact sums (numerators exact, one final double division)."""
    num = dbl(n * sty - st * sy)
    den = dbl(n * stt - st * st)
    slope = F.try_divide(num, F.nullif(den, F.lit(0.0)))
    intercept = (dbl(sy) - slope * dbl(st)) / dbl(n)
    return slope, intercept


def trend_fit(series: DataFrame) -> DataFrame:
    """one-row (slope, intercept, n, last_t, last_month)."""
    agg = series.agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("st"),
                     F.sum(F.col("t") * F.col("t")).alias("stt"), F.sum("revenue").alias("sy"),
                     F.sum(F.col("revenue") * F.col("t")).alias("sty"),
                     F.max("t").alias("last_t"), F.max("year_month").alias("last_ym"))
    slope, intercept = _ols(F.col("n"), F.col("st"), F.col("stt"), F.col("sy"), F.col("sty"))
    return agg.select(slope.alias("slope"), intercept.alias("intercept"), "n", "last_t", "last_ym")


def seasonal_index(series: DataFrame, fit: DataFrame) -> DataFrame:
    """mean of revenue / trend per calendar month."""
    slope = fit.select("slope").scalar()
    intercept = fit.select("intercept").scalar()
    trend = intercept + slope * dbl("t")
    return series.withColumn("seasonal_ratio", dbl("revenue") / trend) \
                 .groupBy("month").agg(exact_mean("seasonal_ratio").alias("seasonal_idx"))


def backtest(series: DataFrame, seasonal: DataFrame) -> DataFrame:
    """one-step forecasts for splits MIN_TRAIN .. n-2 from expanding windows."""
    prior = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    n_all = F.count(F.lit(1)).over(Window.partitionBy())
    s = series.select(
        "*",
        F.count(F.lit(1)).over(prior).alias("_n"), F.sum("t").over(prior).alias("_st"),
        F.sum(F.col("t") * F.col("t")).over(prior).alias("_stt"),
        F.sum("revenue").over(prior).alias("_sy"),
        F.sum(F.col("revenue") * F.col("t")).over(prior).alias("_sty"),
        n_all.alias("_total"))
    slope, intercept = _ols(F.col("_n"), F.col("_st"), F.col("_stt"), F.col("_sy"), F.col("_sty"))
    s = s.filter((F.col("t") >= MIN_TRAIN) & (F.col("t") <= F.col("_total") - 2))
    s = s.join(seasonal, "month", "left")
    pred = (intercept + slope * dbl("t")) * F.col("seasonal_idx")
    return s.select("year_month", "t", dbl("revenue").alias("actual"), pred.alias("predicted"),
                    F.abs(dbl("revenue") - pred).alias("abs_error"))


def backtest_summary(bt: DataFrame) -> DataFrame:
    """F4 summary: mean absolute one-step error (the reference's 'RMSE') and true RMSE."""
    return bt.agg(F.count(F.lit(1)).alias("splits"),
                  round_half_up(exact_mean("abs_error"), 2).alias("mae"),
                  round_half_up(F.sqrt(exact_mean(F.col("abs_error") * F.col("abs_error"))), 2)
                  .alias("rmse"))


def forecast(fact: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """next ``horizon`` months = trend × seasonal index, band ×0.88 / ×1.12."""
    return forecast_from_series(monthly_series(fact), horizon)


def forecast_from_series(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    fit = trend_fit(series)
    seasonal = seasonal_index(series, fit)
    last = F.to_date(F.concat(F.col("last_ym"), F.lit("-01")))
    fut = fit.select("slope", "intercept", "last_t", last.alias("last_d"),
                     F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"))
    fut = fut.select(
        F.date_format(F.add_months("last_d", F.col("i")), "yyyy-MM").alias("year_month"),
        F.month(F.add_months("last_d", F.col("i"))).alias("month"),
        (F.col("intercept") + F.col("slope") * dbl(F.col("last_t") + F.col("i"))).alias("base"))
    out = fut.join(seasonal, "month", "left")
    fc = F.col("base") * F.col("seasonal_idx")
    return out.select("year_month", round_half_up(fc, 2).alias("forecast"),
                      round_half_up(fc * 0.88, 2).alias("lower_88"),
                      round_half_up(fc * 1.12, 2).alias("upper_112")).orderBy("year_month")


def history_plus_forecast(fact: DataFrame, fc: DataFrame | None = None) -> DataFrame:
    """Actual monthly revenue stacked over the forecast rows (missing columns null).
    History and forecast read the same checkpointed monthly series (one fact pass)."""
    series = monthly_series(fact)
    hist = series.select("year_month", dbl("revenue").alias("actual"))
    fc = fc if fc is not None else forecast_from_series(series)
    return hist.unionByName(fc, allowMissingColumns=True).orderBy("year_month")
