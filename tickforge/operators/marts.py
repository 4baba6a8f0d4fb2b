"""Staging projections and mart tables.  ``as_of`` replaces the wall clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.functions import market
from tickforge.functions.clock import order_key, since
from tickforge.operators.facts import TRADE_COLUMNS
from tickforge.operators.ticks import is_valid


def stg_stock_trades(trades: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return trades.filter(is_valid()).select(*TRADE_COLUMNS, *keep)


def stg_ohlc_candles(candles: DataFrame) -> DataFrame:
    """Candles with an open and a close and a sane range, plus three derived measures."""
    opened, closed = F.col("open"), F.col("close")
    sane = opened.isNotNull() & closed.isNotNull() & (F.col("high") >= F.col("low"))
    return candles.filter(sane).select(
        *[c for c in candles.columns if c != "loaded_at"],
        (F.col("high") - F.col("low")).alias("price_range"),
        (closed - opened).alias("price_movement"),
        market.pct_or(closed, opened).alias("candle_change_pct"),
    )


def stg_sentiment(sentiment: DataFrame) -> DataFrame:
    """Category and share of positive articles (0 without articles)."""
    score, articles = F.col("news_sentiment"), F.col("news_count")
    share = F.when(articles > 0, F.try_divide(F.col("positive_news_count").cast("double"), articles) * 100)
    return sentiment.filter(score.isNotNull()).select(
        "symbol", "timestamp_parsed", "price", "price_change_pct",
        score, articles, "positive_news_count", "negative_news_count",
        market.sentiment_category(score).alias("sentiment_category"),
        share.otherwise(0.0).alias("positive_ratio"),
    )


def stg_dim_stocks(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current").select(
        "symbol", "name", "sector", "exchange", "currency", "is_current", "valid_from", "valid_to")


def daily_performance(trades: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Daily bar per symbol with activity counts.

    Day open and close are ordered aggregates, so the whole mart is one map-side
    combined aggregation instead of two ranked copies joined back to the totals.
    """
    price, side = F.col("price"), F.col("price_direction")
    at = order_key("timestamp_parsed", tiebreak)
    day = trades.groupBy("symbol", "trade_date").agg(
        F.min(price).alias("day_low"),
        F.max(price).alias("day_high"),
        F.avg(price).alias("day_avg_price"),
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("tick_count"),
        F.stddev_samp(price).alias("price_volatility"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.count_if("is_price_spike").alias("spike_count"),
        F.count_if(side == "UP").alias("up_ticks"),
        F.count_if(side == "DOWN").alias("down_ticks"),
        F.min_by(price, at).alias("day_open"),
        F.max_by(price, at).alias("day_close"),
    )
    opened, closed = F.col("day_open"), F.col("day_close")
    return day.withColumns({
        "day_change": closed - opened,
        "day_change_pct": market.pct_or(closed, opened),
        "day_candle_color": market.candle_color(opened, closed),
    })


def metrics_24h(candles: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Per-symbol totals over the candles that start inside the look-back."""
    return candles.filter(since("window_start", as_of, hours)).groupBy("symbol").agg(
        F.max("sector").alias("sector"),
        F.max("exchange").alias("exchange"),
        F.count("*").alias("candle_count_24h"),
        F.avg("close").alias("avg_price_24h"),
        F.stddev_samp("close").alias("price_volatility_24h"),
        F.sum("volume").alias("total_volume_24h"),
        F.max("high").alias("high_24h"),
        F.min("low").alias("low_24h"),
    )


def sentiment_24h(staged: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Per-symbol sentiment over the look-back; a day's article count adds once per tick."""
    return staged.filter(since("timestamp_parsed", as_of, hours)).groupBy("symbol").agg(
        F.avg("news_sentiment").alias("avg_sentiment_24h"),
        F.sum("news_count").alias("total_news_24h"),
        F.avg("positive_ratio").alias("avg_positive_ratio"),
    )


def stock_metrics(candles: DataFrame, staged_sentiment: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """24-hour metrics with the latest close (over all candles) and sentiment, 0 if none."""
    current = candles.groupBy("symbol").agg(F.max_by("close", "window_start").alias("current_price"))
    mood = sentiment_24h(staged_sentiment, as_of, hours)
    joined = metrics_24h(candles, as_of, hours).join(current, "symbol", "left").join(mood, "symbol", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in mood.columns[1:]})


def hourly_moments(candles: DataFrame) -> DataFrame:
    """Partial sums of candles by symbol and hour, which merge to those of any longer time: count, mean and squared
    deviation of the close, volume, range, and the last close."""
    close = F.col("close")
    return candles.groupBy("symbol", F.date_trunc("hour", "window_start").alias("hour")).agg(
        F.max("sector").alias("sector"), F.max("exchange").alias("exchange"), F.count("*").alias("n"),
        F.avg(close).alias("mean"), (F.var_pop(close) * F.count("*")).alias("m2"), F.sum("volume").alias("volume"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.max("window_start").alias("last_start"),
        F.max_by(close, "window_start").alias("last_close"))


def metrics_from_moments(moments: DataFrame, edge: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """:func:`metrics_24h` and the current price from stored moments.

    ``edge`` are the candles of the one hour that the look-back cuts, from its beginning on; all later hours count whole.
    A symbol has at most ``hours + 1`` rows here, which are merged pairwise, without squares of large sums.
    """
    cut = as_of - F.make_dt_interval(hours=F.lit(hours))
    whole = moments.where(F.col("hour") >= cut)
    part = hourly_moments(edge.where((F.col("window_start") >= cut) & (F.date_trunc("hour", "window_start") < cut)))
    rows = whole.select(*part.columns).unionByName(part)

    def merged(a: Column, b: Column) -> Column:
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + d * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"))

    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    grouped = rows.groupBy("symbol").agg(
        F.max("sector").alias("sector"), F.max("exchange").alias("exchange"), F.sum("n").alias("candle_count_24h"),
        F.aggregate(F.array_sort(F.collect_list(F.struct("hour", "n", "mean", "m2"))), none, merged).alias("_m"),
        F.sum("volume").alias("total_volume_24h"), F.max("high").alias("high_24h"), F.min("low").alias("low_24h"))
    current = moments.groupBy("symbol").agg(F.max_by("last_close", "last_start").alias("current_price"))
    return grouped.select(
        "symbol", "sector", "exchange", "candle_count_24h", F.col("_m.mean").alias("avg_price_24h"),
        F.when(F.col("_m.n") > 1, F.sqrt(F.col("_m.m2") / (F.col("_m.n") - 1))).alias("price_volatility_24h"),
        "total_volume_24h", "high_24h", "low_24h").join(current, "symbol", "left")


def stock_metrics_from_moments(moments: DataFrame, edge: DataFrame, staged_sentiment: DataFrame, as_of: Column,
                               hours: int = 24) -> DataFrame:
    """:func:`stock_metrics` without reading the candles again."""
    mood = sentiment_24h(staged_sentiment, as_of, hours)
    joined = metrics_from_moments(moments, edge, as_of, hours).join(mood, "symbol", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in mood.columns[1:]})


def latest_trade(trades: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Newest price and trade time per symbol, combined on the map side."""
    at = order_key("timestamp_parsed", tiebreak)
    return trades.groupBy("symbol").agg(
        F.max_by("price", at).alias("latest_price"),
        F.max("timestamp_parsed").alias("last_trade_time"),
    )


def dim_stocks_enhanced(dim: DataFrame, trades: DataFrame, as_of: Column, tiebreak: str | None = None) -> DataFrame:
    """Dimension with the latest trade; active means traded within the last hour."""
    joined = dim.select("symbol", "name", "sector", "exchange", "currency").join(
        latest_trade(trades, tiebreak), "symbol", "left")
    return joined.withColumn("is_actively_trading", F.coalesce(
        since("last_trade_time", as_of, 1), F.lit(False)))
