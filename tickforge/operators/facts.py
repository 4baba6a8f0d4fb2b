"""Star schema: trade facts and the instrument dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickforge import settings

TRADE_COLUMNS = [
    "symbol", "timestamp_parsed", "trade_date", "sector", "exchange", "currency", "price", "volume",
    "price_change", "price_change_pct", "is_anomaly", "is_price_spike", "is_high_volume",
    "price_direction", "volatility",
]

LISTED = ["symbol", "name", "sector", "exchange", "currency"]


def fact_trades(enriched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trade facts; ``keep`` carries extra columns such as the ordering tiebreak."""
    return enriched.withColumnRenamed("date_parsed", "trade_date").select(*TRADE_COLUMNS, *keep)


def dim_stocks(spark: SparkSession, valid_from: datetime,
               rows: list[tuple[str, ...]] | None = None) -> DataFrame:
    """The configured instruments as current dimension rows."""
    columns = ", ".join(f"{c} string not null" for c in LISTED)
    return as_dimension(spark.createDataFrame(rows or settings.INSTRUMENTS, columns), F.lit(valid_from))


def as_dimension(listed: DataFrame, valid_from) -> DataFrame:
    """Validity columns: every row is current, valid from load time, with no end."""
    return listed.select(
        *LISTED,
        F.lit(True).alias("is_current"),
        valid_from.cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
