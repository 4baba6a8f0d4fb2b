"""Quotes to ticks, ticks to enriched ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge import settings
from tickforge.functions import market
from tickforge.functions.clock import parse_time
from tickforge.functions.numbers import round_exact


def publishable(quotes: DataFrame) -> DataFrame:
    """Quotes that carry a price; missing and zero prices are never published."""
    return quotes.filter(market.nonzero(F.col("price")).isNotNull())


def with_metadata(ticks: DataFrame, dim: DataFrame) -> DataFrame:
    """Attach name, sector, exchange and currency by symbol, with defaults for unlisted symbols."""
    fallback = {
        "name": F.col("symbol"),
        "sector": F.lit(settings.UNKNOWN),
        "exchange": F.lit(settings.UNKNOWN),
        "currency": F.lit(settings.DEFAULT_CURRENCY),
    }
    known = dim.select("symbol", *[F.col(c).alias(f"_dim_{c}") for c in fallback])
    joined = ticks.drop(*fallback).join(known, "symbol", "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(f"_dim_{c}"), default) for c, default in fallback.items()}
    ).drop(*known.columns[1:])


def _priced(quotes: DataFrame, scale: int, levels: tuple[str, ...]) -> DataFrame:
    """Round the price levels and derive the change against the previous close.

    Changes use the unrounded price; with no (or a zero) previous close they are 0.
    """
    price, base = F.col("price"), market.nonzero(F.col("prev_close"))
    # Two steps: the rounding refers to its input several times, so the inputs are
    # columns of a projection of their own rather than repeated expressions.
    raw = quotes.withColumns({
        "price_change": F.when(base.isNull(), price - price).otherwise(price - base),
        "price_change_pct": F.when(base.isNull(), 0.0).otherwise((price - base) / base * 100),
        "volume": F.coalesce(F.col("volume"), F.lit(0)).cast("bigint"),
        **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in levels},
    })
    places = {"price": scale, "price_change": scale, "price_change_pct": 4, **dict.fromkeys(levels, scale)}
    return raw.withColumns({c: round_exact(F.col(c), n) for c, n in places.items()})


def build_stock_ticks(quotes: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Wire-shaped stock ticks (2 decimals) with the session flag of their own event time."""
    return _priced(quotes, 2, ("open", "day_high", "day_low", "prev_close")).withColumn(
        "market_hours", market.market_open(F.col("exchange"), F.col(ts))
    )


def build_crypto_ticks(quotes: DataFrame) -> DataFrame:
    """Wire-shaped crypto ticks (4 decimals), always open."""
    return _priced(quotes, 4, ("day_high", "day_low", "prev_close")).withColumns({
        "sector": F.lit("Crypto"),
        "exchange": F.lit("Crypto"),
        "currency": F.lit("USD"),
        "market_cap": F.coalesce(F.col("market_cap"), F.lit(0)).cast("bigint"),
        "market_open": F.lit(True),
    })


def is_valid() -> Column:
    """Positive price and non-negative volume; NULL in either drops the tick."""
    return (F.col("price") > 0) & (F.col("volume") >= 0)


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.filter(is_valid())


def enrich(
    ticks: DataFrame,
    ts: str = "timestamp",
    spike_pct: float = settings.SPIKE_PCT,
    high_volume: int = settings.HIGH_VOLUME,
) -> DataFrame:
    """Valid ticks with event time parts and anomaly flags; the same for batch and stream.

    ``is_anomaly`` is three-valued: an unknown change with low volume stays NULL.
    """
    timed = valid_ticks(ticks).withColumn("timestamp_parsed", parse_time(ticks, ts))
    event, pct = F.col("timestamp_parsed"), F.col("price_change_pct")
    return timed.withColumns({
        "date_parsed": F.to_date(event),
        "hour": F.hour(event),
        "minute": F.minute(event),
        "volatility": F.abs(pct),
        "price_direction": market.direction(F.col("price_change")),
        "is_price_spike": F.abs(pct) > spike_pct,
        "is_high_volume": F.col("volume") > high_volume,
    }).withColumn("is_anomaly", F.col("is_price_spike") | F.col("is_high_volume"))


def anomalies(enriched: DataFrame) -> DataFrame:
    return enriched.filter("is_anomaly")
