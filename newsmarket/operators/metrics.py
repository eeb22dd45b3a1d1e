"""Rolling market metrics over (ticker, date) prices, all in one partitioning by ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmarket.functions.columns import free

from .asof import lagged_by_year


def _rows(n: int) -> Window:
    return Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - n, 0)


def pct_change(now: Column, before: Column) -> Column:
    return 100 * (now / F.nullif(before, F.lit(0.0)) - 1)


def with_returns(prices: DataFrame) -> DataFrame:
    """Adds daily_return_pct: change of adj_close against the row before; null after a zero price."""
    before = F.lag("adj_close").over(Window.partitionBy("ticker").orderBy("date"))
    return prices.withColumn("daily_return_pct", pct_change(F.col("adj_close"), before))


def with_moving(prices: DataFrame) -> DataFrame:
    """Adds ma_7d, ma_30d and volatility_30d, each null until its window is full of rows."""
    out = prices
    for name, value, n in (("ma_7d", F.avg("adj_close"), 7), ("ma_30d", F.avg("adj_close"), 30), ("volatility_30d", F.stddev_samp("daily_return_pct"), 30)):
        out = out.withColumn(name, F.when(F.count("*").over(_rows(n)) == n, value.over(_rows(n))))
    return out


def with_benchmark(prices: DataFrame, benchmark: str) -> DataFrame:
    """Adds benchmark_return_pct and excess_return_pct by date; null for the benchmark itself and on days without it.

    The benchmark has one row a date, so the planner may broadcast it; it is not forced.
    """
    name = free("bench_", prices)
    bench = prices.where(F.col("ticker") == benchmark).select("date", F.col("daily_return_pct").alias(name))
    own = F.when(F.col("ticker") != benchmark, F.col(name))
    out = prices.join(bench, "date", "left").withColumn("benchmark_return_pct", own)
    return out.withColumn("excess_return_pct", F.col("daily_return_pct") - F.col("benchmark_return_pct")).drop(name)


def with_beta(prices: DataFrame, n: int = 60) -> DataFrame:
    """Adds beta_60d and correlation_60d over ``n`` rows, null until the window has n benchmark returns.

    Beta: covariance over pairs by the variance of all benchmark returns. Correlation: covariance by both deviations, over pairs.
    """
    w, r, b = _rows(n), F.col("daily_return_pct"), F.col("benchmark_return_pct")
    pair = r.isNotNull() & b.isNotNull()
    full = F.count(b).over(w) == n
    covar = F.covar_samp(r, b).over(w)
    beta = covar / F.nullif(F.var_samp(b).over(w), F.lit(0.0))
    spread = F.stddev_samp(F.when(pair, r)).over(w) * F.stddev_samp(F.when(pair, b)).over(w)
    return prices.withColumn("beta_60d", F.when(full, beta)).withColumn("correlation_60d", F.when(full, covar / F.nullif(spread, F.lit(0.0))))


def market_metrics(prices: DataFrame, benchmark: str) -> DataFrame:
    """All metrics of a price table."""
    return with_beta(with_benchmark(with_moving(with_returns(prices)), benchmark))


def yoy(series: DataFrame, keys: list[str], date: str, values: list[str]) -> DataFrame:
    """Adds <value>_yoy_pct: change against the latest row a year or more before; null if that is null or zero."""
    out = lagged_by_year(series, keys, date, values)
    for v in values:
        out = out.withColumn(f"{v}_yoy_pct", pct_change(F.col(v), F.col(f"{v}_year_ago")))
    return out


def coverage(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of each ticker and how many have each metric."""
    return metrics.groupBy("ticker").agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in columns])
