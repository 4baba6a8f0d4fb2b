"""Data behind the overview, chart, sentiment and analytics pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickforge.functions.clock import order_key, since


# ------------------------------------------------------------------- shared

def newest(df: DataFrame, n: int, ts: str = "timestamp_parsed", tiebreak: str | None = None,
           day: str | None = None) -> DataFrame:
    """The ``n`` newest rows: every task keeps ``n``, nothing is sorted globally.

    With many thousand tasks even ``n`` rows from each are too many for the task that
    merges them.  Given the ``day`` column by which a stored table is partitioned, only
    the last days that hold ``n`` rows are read; rows without a day count as the oldest.
    """
    if day is not None:
        first = _first_day_needed(df, n, day)
        df = df if first is None else df.filter(F.col(day) >= F.lit(first))
    order = [F.desc_nulls_last(ts)] + ([F.desc_nulls_last(tiebreak)] if tiebreak else [])
    return df.orderBy(*order).limit(n)


def _first_day_needed(df: DataFrame, n: int, day: str):
    """Latest day such that it and the days after it hold ``n`` rows; None if all do not."""
    counts = df.filter(F.col(day).isNotNull()).groupBy(day).count()   # one row per day
    covered = counts.withColumn("_covered", F.sum("count").over(Window.orderBy(F.desc(day))))
    return covered.agg(F.max(F.when(F.col("_covered") >= n, F.col(day)))).first()[0]


def latest_per_symbol(df: DataFrame, columns: list[str], ts: str = "timestamp_parsed",
                      tiebreak: str | None = None) -> DataFrame:
    """Per symbol the newest non-NULL value of each column.

    Ordered aggregates instead of a ranked window: combined on the map side, so a hot
    symbol ships one row per task.
    """
    at = order_key(ts, tiebreak)
    return df.groupBy("symbol").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns
    ])


def top(df: DataFrame, by: str, n: int, ascending: bool = False) -> DataFrame:
    """Best or worst ``n`` symbols by a measure; symbols without a value never rank."""
    first = F.asc(by) if ascending else F.desc(by)
    return df.filter(F.col(by).isNotNull()).orderBy(first, F.asc("symbol")).limit(n)


def recent(df: DataFrame, ts: str, as_of: Column, hours: int, symbol: str | None = None,
           day: str | None = None) -> DataFrame:
    """Rows of the look-back, optionally of one symbol; all predicates reach the scan.
    ``day`` names the column by which a stored table is partitioned: older days are not
    read."""
    kept = df.filter(since(ts, as_of, hours))
    if day is not None:
        kept = kept.filter(F.col(day) >= F.to_date(as_of - F.make_dt_interval(hours=F.lit(hours))))
    return kept if symbol is None else kept.filter(F.col("symbol") == symbol)


# ----------------------------------------------------------------- overview

LATEST_TRADE = ["sector", "price", "price_change", "price_change_pct", "volume", "volatility", "is_anomaly"]


def market_kpis(latest: DataFrame) -> DataFrame:
    pct = F.col("price_change_pct")
    return latest.agg(
        F.count("*").alias("symbols"),
        F.avg(pct).alias("avg_change_pct"),
        F.count_if(pct > 0).alias("gainers"),
        F.count_if(pct < 0).alias("losers"),
    )


def sector_map(latest: DataFrame) -> DataFrame:
    """Sector and symbol totals: volume, and the volume-weighted mean change.

    Sub-totals have a NULL symbol, the grand total also a NULL sector; without volume
    the weighted change is NULL.
    """
    volume = F.col("volume")
    return latest.rollup("sector", "symbol").agg(
        F.sum(volume).alias("total_volume"),
        F.try_divide(F.sum(F.col("price_change_pct") * volume),
                     F.sum(F.when(F.col("price_change_pct").isNotNull(), volume).cast("double"))
                     ).alias("weighted_change_pct"),
    )


def price_table(latest: DataFrame) -> DataFrame:
    return latest.select("symbol", *LATEST_TRADE).orderBy(F.desc("price_change_pct"), "symbol")


# -------------------------------------------------------------------- chart

def chart(candles: DataFrame, as_of: Column, hours: int, symbol: str, day: str | None = None) -> DataFrame:
    return recent(candles, "window_start", as_of, hours, symbol, day).orderBy("window_start")


def chart_stats(candles: DataFrame) -> DataFrame:
    return candles.agg(
        F.max_by("close", "window_start").alias("current_price"),
        F.max("high").alias("range_high"),
        F.min("low").alias("range_low"),
        F.sum("volume").alias("total_volume"),
    )


def volume_by_color(candles: DataFrame) -> DataFrame:
    return candles.select("window_start", "volume", "candle_color")


# ---------------------------------------------------------------- sentiment

def sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    return sentiment.groupBy("symbol", "news_sentiment").agg(F.count("*").alias("count"))


def sentiment_price_correlation(sentiment: DataFrame) -> DataFrame:
    """Does sentiment move with price?  Pearson correlation over all ticks."""
    return sentiment.agg(F.corr("news_sentiment", "price_change_pct").alias("correlation"),
                         F.count("*").alias("ticks"))


LATEST_SENTIMENT = ["price", "price_change_pct", "news_sentiment", "news_count",
                    "positive_news_count", "negative_news_count"]


def sentiment_table(sentiment: DataFrame, tiebreak: str | None = None) -> DataFrame:
    return latest_per_symbol(sentiment, LATEST_SENTIMENT, tiebreak=tiebreak).orderBy(
        F.desc("news_sentiment"), "symbol")


# ---------------------------------------------------------------- analytics

def activity(hourly: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    return recent(hourly, "hour_start", as_of, hours).select("hour_start", "symbol", "tick_count")


def volatility_ranking(hourly: DataFrame, as_of: Column, hours: int = 24, n: int = 10) -> DataFrame:
    latest = latest_per_symbol(recent(hourly, "hour_start", as_of, hours), ["sector", "price_stddev"],
                               ts="hour_start")
    return top(latest, "price_stddev", n).select("symbol", "sector", "price_stddev")


def anomaly_timeline(hourly: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    return recent(hourly, "hour_start", as_of, hours).filter("anomaly_count > 0").select(
        "hour_start", "symbol", "anomaly_count")
