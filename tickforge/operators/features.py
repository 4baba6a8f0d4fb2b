"""Technical indicators and the next-move target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from tickforge import settings
from tickforge.functions.clock import day_of_week
from tickforge.functions.market import pct_or
from tickforge.operators.ordered import PIECE_ROWS, over_sequence

LONGEST_FRAME = 20   # moving average; RSI reaches 15 rows back

# fixed values: names and order of the feature contract
OUTPUT = [
    "symbol", "timestamp_parsed", "price", "price_change_pct",
    *[f"price_ma_{n}" for n in (5, 10, 20)], *[f"price_std_{n}" for n in (5, 10)],
    "momentum_5", "price_change_pct_1", "rsi", "bb_position", "volume", "volume_ratio",
    "sentiment_score", "news_count", "hour", "day_of_week", "is_market_open_hour",
    "target", "price_next",
]


#: What indicators are computed from, and what is stored of a row before the sentiment is joined.
INPUT = ["symbol", "timestamp_parsed", "trade_date", "price", "price_change_pct", "volume"]
STORED = [c for c in OUTPUT if c not in ("sentiment_score", "news_count")]


def price_lags(df: DataFrame, w: WindowSpec, steps: tuple[int, ...] = (1, 2, 3, 5)) -> DataFrame:
    return df.withColumns({f"price_lag_{k}": F.lag("price", k).over(w) for k in steps})


def moving_stats(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Means and sample deviations over the rows before the current one."""
    def over(agg: Column, n: int) -> Column:
        return agg.over(w.rowsBetween(-n, -1))

    return df.withColumns({
        **{f"price_ma_{n}": over(F.avg("price"), n) for n in (5, 10, 20)},
        **{f"price_std_{n}": over(F.stddev_samp("price"), n) for n in (5, 10)},
        "volume_ma_5": over(F.avg("volume"), 5),
    })


def rsi(df: DataFrame, w: WindowSpec, periods: int = 14) -> DataFrame:
    """Relative strength over the previous ``periods`` moves.

    50 when there was no loss (also for a history of gains only); needs price_lag_1.
    The first move of a symbol counts as neither gain nor loss.
    """
    move = F.coalesce(F.col("price") - F.col("price_lag_1"), F.lit(0.0))
    zero = F.lit(0.0)
    moved = df.withColumns({"_gain": F.greatest(move, zero), "_loss": F.greatest(-move, zero)})
    frame = w.rowsBetween(-periods, -1)
    averaged = moved.withColumns({
        "avg_gain": F.avg("_gain").over(frame),
        "avg_loss": F.avg("_loss").over(frame),
    })
    strength = F.try_divide(F.col("avg_gain"), F.col("avg_loss"))
    return averaged.withColumn("rsi", F.when(
        F.col("avg_loss") != 0, 100 - F.lit(100.0) / (strength + 1)
    ).otherwise(settings.NEUTRAL_RSI)).drop("_gain", "_loss")


def ratios(df: DataFrame) -> DataFrame:
    """Row-local features on top of lags and moving statistics."""
    price, deviation = F.col("price"), F.col("price_std_10")
    return df.withColumns({
        "volume_ratio": F.when(
            F.col("volume_ma_5") > 0, F.try_divide(F.col("volume").cast("double"), F.col("volume_ma_5"))
        ).otherwise(1.0),
        "momentum_5": pct_or(price, F.col("price_lag_5")),
        "price_change_1": price - F.col("price_lag_1"),
        "price_change_pct_1": pct_or(price, F.col("price_lag_1")),
        "bb_position": F.when(
            F.col("price_ma_20").isNotNull() & (deviation > 0),
            F.try_divide(price - F.col("price_ma_20"), deviation)
        ).otherwise(0.0),
    })


def calendar(df: DataFrame, ts: str = "timestamp_parsed") -> DataFrame:
    hour = F.hour(ts)
    return df.withColumns({
        "hour": hour,
        "day_of_week": day_of_week(ts),
        "is_market_open_hour": hour.between(9, 16).cast("int"),
    })


def next_move(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Next price and its direction: 1 up, 0 down, NULL for a tie or no next tick."""
    step = F.sign(F.col("price_next") - F.col("price"))
    return df.withColumn("price_next", F.lead("price").over(w)).withColumn(
        "target", F.when(step > 0, 1).when(step < 0, 0))


def indicators(df: DataFrame, w: WindowSpec) -> DataFrame:
    """All window features over one window specification: one exchange, one sort."""
    return ratios(rsi(moving_stats(price_lags(next_move(df, w), w), w), w))


#: Times of the oldest and of the newest tick that a feature row depends on.
FRAME = ["frame_from", "frame_to"]


def frame_times(df: DataFrame, w: WindowSpec, ts: str = "timestamp_parsed") -> DataFrame:
    """From the first tick of the longest frame to the tick that decides the target."""
    return df.withColumns({
        "frame_from": F.first(ts).over(w.rowsBetween(-LONGEST_FRAME, 0)), "frame_to": F.lead(ts).over(w)})


def build_features(trades: DataFrame, latest_sentiment: DataFrame, tiebreak: str,
                   piece_rows: int = PIECE_ROWS, frames: bool = False) -> DataFrame:
    """Feature rows with a known next move, 22 columns; with ``frames`` also the times in :data:`FRAME`."""
    needed = [c for c in (*INPUT, tiebreak) if c in trades.columns]

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        return indicators(frame_times(df, w) if frames else df, w)

    featured = calendar(over_sequence(
        trades.select(*needed), compute, "symbol", "timestamp_parsed", tiebreak,
        before=LONGEST_FRAME, after=1, piece_rows=piece_rows,
    ))
    return with_sentiment(featured, latest_sentiment, FRAME if frames else [])


def with_sentiment(featured: DataFrame, latest_sentiment: DataFrame, further: list[str] = []) -> DataFrame:
    """Indicator rows with a known next move and the newest sentiment of their symbol, 0 where there is none."""
    joined = featured.filter(F.col("target").isNotNull()).join(latest_sentiment, "symbol", "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(0)) for c in ("sentiment_score", "news_count")
    }).select(*OUTPUT, *further)
