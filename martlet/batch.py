"""Batch run: fact table, headline KPIs and the forecast, written as files.

    python -m martlet.batch --input /root/testdata/sf0.1 --output <shared folder>

Writes ``fact_sales/`` (Parquet partitioned by year_month), ``kpis/`` (one JSON
object), ``forecast/`` (CSV with a header) and ``backtest/`` (one JSON object).
Each output is a single Spark job reading the inputs; the forecast and backtest
read the written fact table back, so the order-item join is done once.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import forecast as fc
from .plans.fact import build_fact
from .plans.kpis import headline_kpis
from .session import configure, get_session
from .sources.io import write_csv, write_json, write_parquet
from .sources.mart import star


def run_batch(spark: SparkSession, input_dir: str, output_dir: str) -> dict[str, str]:
    configure(spark)
    out = output_dir.rstrip("/")
    s = star(spark, input_dir)
    paths = {name: f"{out}/{name}" for name in ("fact_sales", "kpis", "forecast", "backtest")}
    write_parquet(build_fact(s), paths["fact_sales"])
    fact = spark.read.parquet(paths["fact_sales"])  # later steps read the written table
    write_json(headline_kpis(s, fact).coalesce(1), paths["kpis"])
    series = fc.monthly_series(fact)
    write_csv(fc.forecast_from_series(series).coalesce(1), paths["forecast"])
    seasonal = fc.seasonal_index(series, fc.trend_fit(series))
    write_json(fc.backtest_summary(fc.backtest(series, seasonal)).coalesce(1), paths["backtest"])
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True, help="folder with the input Parquet tables")
    p.add_argument("--output", required=True, help="output folder (shared storage on a cluster)")
    args = p.parse_args(argv)
    spark = get_session()
    for name, path in run_batch(spark, args.input, args.output).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
