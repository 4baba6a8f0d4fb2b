"""Price, volume and session expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickforge import settings


def nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def pct_or(now: Column, base: Column, fallback: float = 0.0) -> Column:
    """Relative move from ``base`` to ``now`` in percent."""
    usable = nonzero(base).isNotNull()
    return F.when(usable, F.try_divide(now - base, base) * 100).otherwise(F.lit(float(fallback)))


def three_way(value: Column, above, below, up: str, down: str, level: str) -> Column:
    """``up`` over one bound, ``down`` under the other, else ``level`` (also for NULL)."""
    return F.when(value > above, up).when(value < below, down).otherwise(level)


def direction(change: Column) -> Column:
    return three_way(change, 0, 0, "UP", "DOWN", "FLAT")


def candle_color(opened: Column, closed: Column) -> Column:
    return three_way(closed, opened, opened, "GREEN", "RED", "DOJI")


def sentiment_category(score: Column, cutoff: float = settings.CATEGORY_CUTOFF) -> Column:
    return three_way(score, cutoff, -cutoff, "POSITIVE", "NEGATIVE", "NEUTRAL")


def market_open(exchange: Column, ts: Column) -> Column:
    """Session flag of an event time: closed on weekends, crypto otherwise always open,
    NSE from 9 to before 16, every other exchange from 9 to before 17."""
    closes = F.when(exchange == "NSE", 16).otherwise(17)
    in_hours = (F.hour(ts) >= 9) & (F.hour(ts) < closes)
    return (F.weekday(ts) < 5) & (exchange.eqNullSafe("Crypto") | in_hours)
