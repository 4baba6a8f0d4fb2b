"""Refreshes beside running streams: only days that changed since the last one are computed.

Every refresh first notes how far the commit logs of its sources reach, then computes the days they name from all that
is there, and stores its marks last.  A refresh that dies is repeated with the same days or more; what it writes depends
on its days alone, so a repetition changes nothing.  One refresh of a table runs at a time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tickforge.operators import candles, features, marts, news
from tickforge.operators.ordered import PIECE_ROWS, over_sequence
from tickforge.session import stage
from tickforge.sinks.lake import by_day, layout, overwrite, replace_days
from tickforge.sources.commits import Changes, Mark, changed_days
from tickforge.sources.lake import day_table, exists, off_days, on_days, snapshot, table_or_empty, versions
from tickforge.streaming.jobs import Lake, cleaned_schemas, cleaned_table, trade_schema

#: Days of which the carried rows are kept.  Ticks late by more days rebuild the indicators.
KEPT_STATES = 3
#: Rows per symbol: the newest, whose next move is unknown, and those its frames reach.
CARRIED = features.LONGEST_FRAME + 1


# ------------------------------------------------------------------- marks

def marks(spark: SparkSession, lake: Lake, name: str) -> dict[str, Mark]:
    """Marks that the last refresh of ``name`` stored, by source."""
    path = lake.table("_refresh", name)
    if not versions(spark, path):
        return {}
    return {r.source: Mark(r.batch, r.modified) for r in snapshot(spark, path).collect()}


def save_marks(spark: SparkSession, lake: Lake, name: str, at: dict[str, Mark]) -> None:
    rows = [(source, m.batch, m.modified) for source, m in at.items()]
    overwrite(spark.createDataFrame(rows, "source string, batch bigint, modified bigint").coalesce(1),
              lake.table("_refresh", name))


def changes(spark: SparkSession, lake: Lake, sources: dict[str, str], seen: dict[str, Mark]) -> dict[str, Changes]:
    """Changes of every source table (layer/name: its day column) since ``seen``."""
    return {source: changed_days(spark, f"{lake.root}/{source}", day, seen.get(source, Mark()))
            for source, day in sources.items()}


# --------------------------------------------------------------- sentiment

TICKS, NEWS, TRADES = "silver/stock_prices_enriched", "silver/news_sentiment_clean", "gold/fact_stock_trades"


def sentiment_schema(spark: SparkSession, lake: Lake) -> StructType:
    declared = cleaned_schemas(spark, lake)
    ticks, articles = (spark.createDataFrame([], declared[t]) for t in ("stock_prices_enriched", "news_sentiment_clean"))
    return news.ticks_with_sentiment(ticks, news.daily(articles)).schema


def sentiment_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return day_table(spark, lake.table("gold", "stock_with_sentiment"), sentiment_schema(spark, lake), lake.fmt)


def latest_sentiment(spark: SparkSession, lake: Lake) -> DataFrame:
    """Sentiment and article count of each symbol's newest tick, as the refresh keeps them."""
    path = lake.table("gold", "latest_sentiment")
    if not versions(spark, path):
        ticks = sentiment_table(spark, lake)
        return news.latest_sentiment(ticks, "offset")
    return snapshot(spark, path).select(
        "symbol", F.col("news_sentiment").alias("sentiment_score"), "news_count")


def refresh_sentiment(spark: SparkSession, lake: Lake) -> frozenset[date | None]:
    """Ticks with sentiment, rewritten for the days that have new ticks or new articles; returns those days."""
    seen = marks(spark, lake, "sentiment")
    found = changes(spark, lake, {TICKS: "date_parsed", NEWS: "date_parsed"}, seen)
    days = found[TICKS].days | found[NEWS].days
    if days:
        def cleaned(table: str) -> DataFrame:
            return on_days(cleaned_table(spark, lake, table), "date_parsed", days)

        joined = news.ticks_with_sentiment(cleaned("stock_prices_enriched"),
                                           stage(news.daily(cleaned("news_sentiment_clean")), "daily-news"))
        replace_days(joined, lake.table("gold", "stock_with_sentiment"), "date_parsed", lake.fmt, sorted(
            days, key=lambda d: d or date.min))
        newest = news.newest_rows(on_days(sentiment_table(spark, lake), "date_parsed", days), "offset")
        path = lake.table("gold", "latest_sentiment")
        if versions(spark, path):
            # rows of rewritten days are taken anew; a symbol's newest tick elsewhere is as it was
            newest = news.newest_rows(newest.unionByName(off_days(snapshot(spark, path), "date_parsed", days)), "offset")
        overwrite(newest, path)
    save_marks(spark, lake, "sentiment", {s: c.mark for s, c in found.items()})
    return days


# -------------------------------------------------------------- indicators

def indicator_schema(spark: SparkSession, lake: Lake) -> StructType:
    trades = spark.createDataFrame([], trade_schema(spark, lake)).select(*features.INPUT, "offset")
    window = Window.partitionBy("symbol").orderBy("timestamp_parsed")
    return _known(trades, window).schema


def _known(df: DataFrame, w) -> DataFrame:
    """Indicators, and the day of the next tick, on which a row's next move became known."""
    return features.calendar(features.indicators(df, w)).withColumns({
        "known_on": F.lead("trade_date").over(w), "has_next": F.lead(F.lit(True)).over(w)}).select(
        *features.STORED, "offset", "known_on", "has_next")


def indicator_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """Indicators of every trade that has a successor, by the day of that."""
    schema = indicator_schema(spark, lake)
    return day_table(spark, lake.table("ml", "indicators"), StructType([f for f in schema if f.name != "has_next"]), lake.fmt)


def refresh_indicators(spark: SparkSession, lake: Lake, piece_rows: int = PIECE_ROWS) -> date | str | None:
    """Indicators of trades whose frames or next move changed; returns the first day written, "all", or None.

    A row is stored under the day of its successor, when it is complete, so new days leave the files of old ones alone.
    What is before the first changed day enters as carried rows: the last 21 of each symbol.  Rows of a late day change
    the frames behind them, so everything from that day on is computed again.
    """
    seen = marks(spark, lake, "indicators")
    change = changes(spark, lake, {TRADES: "trade_date"}, seen)[TRADES]
    if not change.days:
        return None
    trades = table_or_empty(spark, lake.table("gold", "fact_stock_trades"), trade_schema(spark, lake), lake.fmt)
    trades = trades.withColumnRenamed("trade_timestamp", "timestamp_parsed").select(*features.INPUT, "offset")
    carry, target = lake.table("ml", "carried"), lake.table("ml", "indicators")
    first = None if None in change.days else min(change.days)
    before = [d for d in carried_days(spark, carry) if first is not None and d < first]
    if before:
        kept = spark.read.schema(trades.schema).parquet(f"{carry}/as_of={max(before)}")
        rows = kept.unionByName(trades.where(F.col("trade_date") > F.lit(max(before))))
    else:
        first, rows = None, trades
    rows = stage(rows, "indicator-input")
    known = over_sequence(rows, _known, "symbol", "timestamp_parsed", "offset",
                          before=features.LONGEST_FRAME, after=1, piece_rows=piece_rows)
    if first is None:
        whole = by_day(known.where("has_next").drop("has_next"), "known_on")
        whole.write.format(lake.fmt).mode("overwrite").options(**layout(lake.fmt)).partitionBy("known_on").save(target)
    else:
        fresh = known.where(F.col("known_on") >= F.lit(first)).drop("has_next")
        replace_days(fresh, target, "known_on")
    carry_over(spark, rows, carry, first)
    save_marks(spark, lake, "indicators", {TRADES: change.mark})
    return first or "all"


def carried_days(spark: SparkSession, path: str) -> list[date]:
    """Days as of which rows are carried, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.globStatus(hadoop.Path(f"{path}/as_of=*")) or []]
    return sorted(date.fromisoformat(n.partition("=")[2]) for n in names)


def carry_over(spark: SparkSession, rows: DataFrame, path: str, first: date | None) -> None:
    """Store the last rows of every symbol as of each of the newest days in ``rows``; older and outdated ones go.

    The ranking keeps 21 rows per symbol in every task before it shuffles, so a hot symbol stays small.  All rows are
    ranked for the first of these days only: the last rows as of a later one are among those as of the day before it
    and what came since.
    """
    found = rows.where(F.col("trade_date").isNotNull() if first is None else F.col("trade_date") >= F.lit(first))
    days = sorted(r.trade_date for r in found.select("trade_date").distinct().collect())[-KEPT_STATES:]   # one row per day
    latest = Window.partitionBy("symbol").orderBy(F.desc_nulls_last("timestamp_parsed"), F.desc_nulls_last("offset"))
    stale = [d for d in carried_days(spark, path) if first is None or d >= first]
    for before, day in zip([None, *days], days):
        upto = rows.where(F.col("trade_date").isNull() | (F.col("trade_date") <= F.lit(day)))
        if before is not None:
            since = rows.where((F.col("trade_date") > F.lit(before)) & (F.col("trade_date") <= F.lit(day)))
            upto = spark.read.schema(rows.schema).parquet(f"{path}/as_of={before}").unionByName(since)
        last = upto.withColumn("_n", F.row_number().over(latest)).where(F.col("_n") <= CARRIED).drop("_n")
        last.write.mode("overwrite").parquet(f"{path}/as_of={day}")
    kept = set(sorted({*carried_days(spark, path)} - ({*stale} - {*days}))[-KEPT_STATES:])
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in {*carried_days(spark, path)} - kept:
        fs.delete(hadoop.Path(f"{path}/as_of={day}"), True)


# ------------------------------------------------------------ hourly moments

CANDLES = "gold/fact_ohlc_candles"


def candle_schema(spark: SparkSession, lake: Lake) -> StructType:
    bars = spark.createDataFrame([], cleaned_schemas(spark, lake)["stock_prices_1min_ohlc"]).drop("processed_at")
    return candles.fact_candles(bars).withColumns(
        {"loaded_at": F.current_timestamp(), "candle_date": F.to_date("window_start")}).schema


def refresh_moments(spark: SparkSession, lake: Lake) -> frozenset[date | None]:
    """Hourly moments of candles, rewritten for the days with new candles; returns those days."""
    seen = marks(spark, lake, "moments")
    change = changes(spark, lake, {CANDLES: "candle_date"}, seen)[CANDLES]
    if change.days:
        found = table_or_empty(spark, f"{lake.root}/{CANDLES}", candle_schema(spark, lake), lake.fmt)
        staged = marts.stg_ohlc_candles(on_days(found, "candle_date", change.days))
        replace_days(marts.hourly_moments(staged).withColumn("hour_date", F.to_date("hour")),
                     lake.table("gold", "candle_moments"), "hour_date", lake.fmt, sorted(
                         change.days, key=lambda d: d or date.min))
        save_marks(spark, lake, "moments", {CANDLES: change.mark})
    return change.days


def moments_table(spark: SparkSession, lake: Lake) -> DataFrame:
    staged = marts.stg_ohlc_candles(spark.createDataFrame([], candle_schema(spark, lake)))
    schema = marts.hourly_moments(staged).withColumn("hour_date", F.to_date("hour")).schema
    return day_table(spark, lake.table("gold", "candle_moments"), schema, lake.fmt)


# ---------------------------------------------------------------- features

def feature_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """Feature rows with a known next move: stored indicators with the newest sentiment per symbol.

    The sentiment is one row per symbol and changes with every refresh, so it is joined when the table is read.
    """
    return features.with_sentiment(indicator_table(spark, lake), latest_sentiment(spark, lake))


def refreshed(spark: SparkSession, lake: Lake) -> bool:
    """Whether there are any features."""
    return exists(spark, lake.table("ml", "indicators"))
