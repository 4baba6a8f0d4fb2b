"""Warehouse layer: raw copies of the star schema, staging views, mart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tickforge import schemas
from tickforge.operators import marts, quality
from tickforge.plans import refresh
from tickforge.sinks.lake import epoch_to_time, publish, stamped
from tickforge.sources.lake import batch_table, exists, snapshot
from tickforge.streaming.jobs import Lake

# Lake folder -> warehouse table, its contract, the day it is stored by; the
# fourth part marks whole-table snapshots.
LOADS = [
    ("gold", "fact_stock_trades", "raw_stock_trades", False, "raw.stock_trades", "trade_date"),
    ("gold", "fact_ohlc_candles", "raw_ohlc_candles", False, "raw.ohlc_candles", "candle_date"),
    ("gold", "stock_with_sentiment", "raw_stock_sentiment", False, "raw.stock_sentiment", "date_parsed"),
    ("gold", "dim_stocks", "raw_dim_stocks", True, "raw.dim_stocks", None),
]
#: The feature table is made of two stored ones when it is loaded.
FEATURES = ("ml_features", "ml.features")
#: Beyond the contract: the id that orders ticks of one time.
KEPT = ("offset",)


def load(spark: SparkSession, lake: Lake, database: str, fmt: str = "parquet") -> list[str]:
    """Replace the raw tables with the current lake tables in their declared columns; absent
    folders are skipped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    loaded = []
    for layer, folder, table, is_snapshot, contract, day in LOADS:
        path = lake.table(layer, folder)
        if not exists(spark, path):
            continue
        df = epoch_to_time((snapshot if is_snapshot else batch_table)(spark, path, lake.fmt))
        extra = [c for c in (*KEPT, day) if c in df.columns]
        declared = schemas.conform(df, schemas.WAREHOUSE_DDL[contract], absent=("source", "loaded_at"), keep=extra)
        publish(declared, f"{database}.{table}", fmt, [day] if day else None)
        loaded.append(table)
    if refresh.refreshed(spark, lake):
        table, contract = FEATURES
        publish(schemas.conform(refresh.feature_table(spark, lake), schemas.WAREHOUSE_DDL[contract]), f"{database}.{table}", fmt)
        loaded.append(table)
    return loaded


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models by name, from raw tables by name."""
    return {
        "stg_stock_trades": marts.stg_stock_trades(raw["raw_stock_trades"], _tiebreak(raw["raw_stock_trades"])),
        "stg_ohlc_candles": marts.stg_ohlc_candles(raw["raw_ohlc_candles"]),
        "stg_sentiment": marts.stg_sentiment(raw["raw_stock_sentiment"]),
        "stg_dim_stocks": marts.stg_dim_stocks(raw["raw_dim_stocks"]),
    }


def mart_models(stg: dict[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    """Mart models by name, each with the audit column it is stored with."""
    trades = stg["stg_stock_trades"]
    tiebreak = (_tiebreak(trades) or (None,))[0]
    return {
        "fct_daily_performance": stamped(marts.daily_performance(trades, tiebreak), "created_at"),
        "fct_stock_metrics": stamped(
            marts.stock_metrics(stg["stg_ohlc_candles"], stg["stg_sentiment"], as_of), "calculated_at"),
        "dim_stocks_enhanced": stamped(
            marts.dim_stocks_enhanced(stg["stg_dim_stocks"], trades, as_of, tiebreak), "updated_at"),
    }


def build(spark: SparkSession, database: str, as_of: Column, fmt: str = "parquet") -> DataFrame:
    """Create the staging views and mart tables; returns the report of the declared tests."""
    raw = {table: spark.table(f"{database}.{table}") for _, _, table, *_ in LOADS}
    stg = staging(raw)
    for name, df in stg.items():
        df.createOrReplaceTempView(name)
    for name, df in mart_models(stg, as_of).items():
        publish(df, f"{database}.{name}", fmt)
    built = {name: spark.table(f"{database}.{name}") for name in
             ("fct_daily_performance", "fct_stock_metrics", "dim_stocks_enhanced")}
    return quality.run_tests({
        "stock_trades": raw["raw_stock_trades"], "ohlc_candles": raw["raw_ohlc_candles"],
        "dim_stocks": raw["raw_dim_stocks"], "stg_stock_trades": stg["stg_stock_trades"], **built,
    })


def _tiebreak(df: DataFrame) -> tuple[str, ...]:
    return ("offset",) if "offset" in df.columns else ()
