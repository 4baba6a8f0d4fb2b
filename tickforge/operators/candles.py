"""Event-time bars.  All functions run unchanged on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.functions.clock import order_key
from tickforge.functions.market import candle_color


def endpoint(value: str, ts: str, tiebreak: str | None, last: bool) -> Column:
    """First or last ``value`` in (time, tiebreak) order, as a combinable aggregate."""
    pick = F.max_by if last else F.min_by
    return pick(value, order_key(ts, tiebreak))


def _bars(ticks: DataFrame, by: list[str], size: str, ts: str, start: str, end: str,
          measures: dict[str, Column]) -> DataFrame:
    # One shuffle on (by, window) after map-side combining: a hot symbol reaches the
    # final stage as at most one row per task and window.
    bars = ticks.groupBy(*by, F.window(ts, size).alias("_w")).agg(
        *[agg.alias(name) for name, agg in measures.items()]
    )
    return bars.select(*by, F.col("_w.start").alias(start), F.col("_w.end").alias(end), *measures)


def ohlc(ticks: DataFrame, size: str = "1 minute", ts: str = "timestamp_parsed",
         tiebreak: str | None = None) -> DataFrame:
    """Open, high, low, close and activity per symbol and tumbling window."""
    price, pct = F.col("price"), F.col("price_change_pct")
    return _bars(ticks, ["symbol", "sector", "exchange", "currency"], size, ts,
                 "window_start", "window_end", {
        "open": endpoint("price", ts, tiebreak, last=False),
        "high": F.max(price),
        "low": F.min(price),
        "close": endpoint("price", ts, tiebreak, last=True),
        "volume": F.sum("volume"),
        "avg_price": F.avg(price),
        "tick_count": F.count("*"),
        "max_change_pct": F.max(pct),
        "min_change_pct": F.min(pct),
        "anomaly_count": F.count_if("is_anomaly"),
    })


def hourly_metrics(ticks: DataFrame, size: str = "1 hour", ts: str = "timestamp_parsed",
                   tiebreak: str | None = None) -> DataFrame:
    """Hourly bar with the sample deviation of the price (NULL for a single tick)."""
    price = F.col("price")
    return _bars(ticks, ["symbol", "sector", "exchange"], size, ts, "hour_start", "hour_end", {
        "hour_open": endpoint("price", ts, tiebreak, last=False),
        "hour_high": F.max(price),
        "hour_low": F.min(price),
        "hour_close": endpoint("price", ts, tiebreak, last=True),
        "hour_avg_price": F.avg(price),
        "hour_volume": F.sum("volume"),
        "tick_count": F.count("*"),
        "price_stddev": F.stddev_samp(price),
        "anomaly_count": F.count_if("is_anomaly"),
    })


def fact_candles(bars: DataFrame) -> DataFrame:
    """Bars with colour and range in percent of the open (NULL where the open is 0)."""
    keys = ["symbol", "window_start", "window_end", "sector", "exchange", "currency"]
    rest = [c for c in bars.columns if c not in keys]
    return bars.select(
        *keys, *rest,
        candle_color(F.col("open"), F.col("close")).alias("candle_color"),
        (F.try_divide(F.col("high") - F.col("low"), F.col("open")) * 100).alias("candle_range_pct"),
    )
