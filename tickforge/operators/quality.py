"""Declared data tests and layer profiles as report rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# The declared tests, per table.
NOT_NULL = {
    "stock_trades": ["symbol", "price"],
    "ohlc_candles": ["symbol", "window_start"],
    "dim_stocks": ["symbol"],
    "stg_stock_trades": ["symbol", "price"],
    "fct_daily_performance": ["symbol", "trade_date"],
    "fct_stock_metrics": ["symbol"],
    "dim_stocks_enhanced": ["symbol"],
}
UNIQUE = {
    "dim_stocks": ["symbol"],
    "fct_stock_metrics": ["symbol"],
    "dim_stocks_enhanced": ["symbol"],
}


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Number of NULLs per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("rule"), "failures")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once; NULLs are not duplicates."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("rule"), "failures")


def both(df: DataFrame, table: str, columns: list[str], key: str) -> DataFrame:
    """NULLs per column and repeated values of ``key``, in one aggregation by ``key``."""
    per = df.groupBy(key).agg(F.count("*").alias("_n"), *[
        F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns])
    found = per.agg(
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"not_null {c}") for c in columns],
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias(f"unique {key}"))
    rule = F.split("_test", " ")
    return found.unpivot([], found.columns, "_test", "failures").select(
        F.lit(table).alias("table_name"), rule[1].alias("column_name"), rule[0].alias("rule"), "failures")


def run_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared test on the tables given, each read once."""
    checks = []
    for table, columns in NOT_NULL.items():
        if table in tables:
            keys = UNIQUE.get(table, [])
            checks.append(both(tables[table], table, columns, keys[0]) if keys else
                          not_null(tables[table], table, columns))
    return reduce(DataFrame.unionByName, checks)


def profile(df: DataFrame, table: str) -> DataFrame:
    """Row count and, where the column exists, the number of anomalies."""
    flagged = F.count_if("is_anomaly") if "is_anomaly" in df.columns else F.lit(None).cast("bigint")
    return df.agg(F.count("*").alias("total_rows"), flagged.alias("anomalies")).select(
        F.lit(table).alias("table_name"), "total_rows", "anomalies")


def preview(df: DataFrame, order: str, rows: int = 5) -> DataFrame:
    """Newest rows for inspection."""
    return df.orderBy(F.desc(order)).limit(rows)
