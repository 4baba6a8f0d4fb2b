from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import candles, facts, marts, news, quality, ticks

import pytest

from tests.helpers import START, as_dicts, at, simple, tick_frame

AS_OF = START + timedelta(hours=30)


def trades_of(spark, rows):
    return facts.fact_trades(ticks.enrich(tick_frame(spark, rows), ts="ts"), keep=("event_id",))


def test_daily_performance_endpoints(spark):
    day = 86400
    trades = trades_of(spark, [
        (2, "A", at(5), 12.0, 1.0, 3.0, 1), (1, "A", at(5), 10.0, -1.0, 0.0, 1), (3, "A", at(9), 15.0, 0.0, 0.0, 1),
        (4, "A", at(day), 7.0, 0.0, 0.0, 1)])
    first, second = as_dicts(marts.daily_performance(trades, "event_id"), "trade_date")
    assert (first["day_open"], first["day_close"], first["day_change"], first["day_change_pct"]) == (10.0, 15.0, 5.0, 50.0)
    assert (first["up_ticks"], first["down_ticks"], first["spike_count"], first["day_candle_color"]) == (1, 1, 1, "GREEN")
    assert second["price_volatility"] is None and second["day_candle_color"] == "DOJI"


def test_daily_performance_is_one_exchange(spark):
    plan = marts.daily_performance(trades_of(spark, [(1, "A", at(), 1.0, 0.0, 0.0, 1)]), "event_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text


def test_staged_candles(spark):
    bars = candles.fact_candles(candles.ohlc(simple(spark, [5.0, 6.0, 4.5]), tiebreak="event_id"))
    broken = bars.withColumn("open", F.lit(None).cast("double")).unionByName(
        bars.withColumn("high", F.lit(0.0))).unionByName(bars)
    row = as_dicts(marts.stg_ohlc_candles(broken))
    assert len(row) == 1 and (row[0]["price_range"], row[0]["price_movement"], row[0]["candle_change_pct"]) == (1.5, -0.5, -10.0)
    zero = marts.stg_ohlc_candles(bars.withColumn("open", F.lit(0.0))).first()
    assert zero.candle_change_pct == 0.0


def test_news_join_and_daily_counts(spark):
    articles = spark.createDataFrame(
        [("A", at(0), 0.5), ("A", at(0), 0.5), ("A", at(60), -0.4), ("A", at(61), None), ("B", at(0), 0.9)],
        "symbol string, timestamp timestamp, sentiment_score double")
    daily = news.daily(news.clean(articles))
    row = {r.symbol: r for r in daily.collect()}["A"]
    assert (round(row.news_sentiment, 6), row.news_count, row.positive_news_count, row.negative_news_count) == (0.2, 4, 2, 1)
    enriched = ticks.enrich(tick_frame(spark, [(0, "A", at(9), 1.0, 0.0, 0.0, 1), (1, "C", at(9), 1.0, 0.0, 0.0, 1),
                                               (2, "A", at(90000), 1.0, 0.0, 0.0, 1)]), ts="ts")
    joined = as_dicts(news.ticks_with_sentiment(enriched, daily), "event_id")
    assert [(r["news_count"], round(r["news_sentiment"], 6)) for r in joined] == [(4, 0.2), (0, 0.0), (0, 0.0)]
    assert joined[0].keys() == {*enriched.columns, *news.MEASURES}
    staged = as_dicts(marts.stg_sentiment(news.ticks_with_sentiment(enriched, daily)), "timestamp_parsed")
    assert sorted(r["positive_ratio"] for r in staged) == [0.0, 0.0, 50.0]


def test_newest_tick_gives_the_same_latest_sentiment(spark):
    enriched = ticks.enrich(tick_frame(spark, [
        (0, "A", at(0), 1.0, 0.0, 0.0, 1), (1, "A", at(90000), 1.0, 0.0, 0.0, 1), (2, "B", at(0), 1.0, 0.0, 0.0, 1)]), ts="ts")
    daily = news.daily(news.clean(spark.createDataFrame(
        [("A", at(90000), 0.5), ("A", at(0), 0.1), ("B", at(0), 0.3)],
        "symbol string, timestamp timestamp, sentiment_score double")))
    full = news.latest_sentiment(news.ticks_with_sentiment(enriched, daily), "event_id")
    short = news.latest_sentiment(news.ticks_with_sentiment(news.newest_tick(enriched, "event_id"), daily), "event_id")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, short.collect())) == [("A", 0.5, 1), ("B", 0.3, 1)]


def test_tagging_keeps_the_newest_per_symbol(spark):
    articles = spark.createDataFrame(
        [(f"u{i}", at(i), "Apple news", "about AAPL and Google" if i % 2 else None) for i in range(8)]
        + [("none", at(99), "other", "text")],
        "url string, published_at timestamp, headline string, description string")
    got = [(r.symbol, r["rank"], r.url) for r in news.tag_articles(articles).orderBy("symbol", "rank").collect()]
    assert got == [("AAPL", i + 1, f"u{7 - i}") for i in range(5)] + [("GOOGL", i + 1, f"u{7 - 2 * i}") for i in range(4)]


def test_look_back_is_closed_and_metrics_join(spark):
    edge = AS_OF - timedelta(hours=24)
    bars = spark.createDataFrame(
        [("A", edge, 1.0, 5.0, 1.0, 2.0, 10), ("A", edge - timedelta(minutes=1), 1.0, 90.0, 1.0, 3.0, 10),
         ("B", edge - timedelta(hours=9), 1.0, 2.0, 1.0, 2.0, 10)],
        "symbol string, window_start timestamp, open double, high double, low double, close double, volume bigint"
    ).withColumns({"sector": F.lit("s"), "exchange": F.lit("e")})
    mood = spark.createDataFrame([("A", edge, 0.5, 2, 50.0), ("A", edge, 0.1, 2, 0.0)],
                                 "symbol string, timestamp_parsed timestamp, news_sentiment double, news_count bigint, positive_ratio double")
    rows = as_dicts(marts.stock_metrics(bars, mood, F.lit(AS_OF)))
    assert len(rows) == 1
    assert (rows[0]["candle_count_24h"], rows[0]["high_24h"], rows[0]["current_price"]) == (1, 5.0, 2.0)
    assert (rows[0]["total_news_24h"], rows[0]["avg_positive_ratio"]) == (4, 25.0)
    none = as_dicts(marts.stock_metrics(bars, mood.filter("false"), F.lit(AS_OF)))[0]
    assert (none["avg_sentiment_24h"], none["total_news_24h"]) == (0.0, 0)


def test_enhanced_dimension(spark):
    dim = facts.dim_stocks(spark, datetime(2024, 1, 1))
    trades = trades_of(spark, [(1, "AAPL", at(0), 1.0, 0.0, 0.0, 1), (2, "AAPL", at(0), 2.0, 0.0, 0.0, 1),
                               (3, "MSFT", at(-1), 3.0, 0.0, 0.0, 1)])
    rows = {r["symbol"]: r for r in as_dicts(
        marts.dim_stocks_enhanced(dim, trades, F.lit(at(3600)), "event_id"))}
    assert len(rows) == 20
    assert (rows["AAPL"]["latest_price"], rows["AAPL"]["is_actively_trading"]) == (2.0, True)
    assert rows["MSFT"]["is_actively_trading"] is False
    assert (rows["BTC-USD"]["latest_price"], rows["BTC-USD"]["is_actively_trading"]) == (None, False)


def test_quality_rules(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "symbol string")
    assert quality.unique(df, "t", "symbol").first().failures == 1
    assert quality.not_null(df, "t", ["symbol"]).first().failures == 2
    report = quality.run_tests({"dim_stocks": df, "fct_stock_metrics": df})
    assert sorted((r.table_name, r.rule, r.failures) for r in report.collect()) == [
        ("dim_stocks", "not_null", 2), ("dim_stocks", "unique", 1),
        ("fct_stock_metrics", "not_null", 2), ("fct_stock_metrics", "unique", 1)]
    assert quality.profile(simple(spark, [1.0, 2.0]), "x").first().total_rows == 2


def test_contract(spark):
    trades = facts.fact_trades(simple(spark, [1.0]))
    ddl = schemas.WAREHOUSE_DDL["raw.stock_trades"]
    shaped = schemas.conform(trades, ddl, absent=("source", "loaded_at")).schema
    assert [(f.name, f.dataType) for f in shaped] == [(f.name, f.dataType) for f in schemas.struct(ddl)]
    with pytest.raises(ValueError, match="source, loaded_at"):
        schemas.conform(trades, ddl)


def test_hot_symbol_join_is_split(spark):
    """A symbol-day with most ticks: adaptive execution splits its partition on the tick side."""
    # reads of its own, so that the tick side is wide enough to be split
    data = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("symbol"),
        F.lit(START.date()).alias("date_parsed"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    daily = data.groupBy("symbol", F.col("date_parsed").alias("news_date")).agg(
        F.lit(0.5).alias("news_sentiment"), *[F.count("*").alias(c) for c in news.MEASURES[1:]])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = news.ticks_with_sentiment(data, daily)
        assert joined.count() == 400_000
        joined.write.format("noop").mode("overwrite").save()
        ran = joined.select("symbol", "payload", "news_count")
        ran.collect()
        assert "skew=true" in ran._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
