"""Registered queries: one callable per operator, each over the whole supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickforge import schemas, settings
from tickforge.operators import (
    asof, candles, dashboard, dimension, facts, features, marts, ml, news, ordered, quality, ticks)
from tickforge.plans import medallion, refresh
from tickforge.session import fresh_path, prepare, stage
from tickforge.sinks import lake as sink
from tickforge.sources import fixtures as fx
from tickforge.sources import contracts, topics
from tickforge.sources.lake import batch_table, snapshot
from tickforge.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ID = "event_id"
BASE = ["event_id", "symbol", "timestamp_parsed"]


def query(fn: Query) -> Query:
    """Register ``fn``; sums and quotients are shown to 6 places, as their last digits
    depend on the order of summation."""
    return _register(fn, {"double": six_places, **_NO_ZONE})


def six_places(c):
    """Rounded, with a nudge: a mean of prices in cents often lies exactly on a half."""
    return F.round(c + 1e-9, 6)


def exact(fn: Query) -> Query:
    """Register ``fn``, whose numbers are exact as they are."""
    return _register(fn, _NO_ZONE)


_NO_ZONE = {"timestamp": lambda c: c.cast("timestamp_ntz")}


def _register(fn: Query, shown: dict) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(fn(prepare(spark), sf_dir), shown)

    QUERIES[fn.__name__] = run
    return run


def tidy(df: DataFrame, shown: dict) -> DataFrame:
    return df.select([
        shown.get(kind, lambda c: c)(F.col(f"`{name}`")).alias(name) for name, kind in df.dtypes
    ])


def as_of(spark: SparkSession, sf_dir: str):
    return fx.as_of(fx.table(spark, sf_dir, "events"))


# ------------------------------------------------------------------- inputs

def bars(spark, sf_dir):
    return candles.fact_candles(candles.ohlc(fx.enriched(spark, sf_dir), tiebreak=ID))


def hourly(spark, sf_dir):
    return candles.hourly_metrics(fx.enriched(spark, sf_dir), tiebreak=ID)


def trades(spark, sf_dir):
    return facts.fact_trades(fx.enriched(spark, sf_dir), keep=(ID,))


def daily_news(spark, sf_dir):
    return stage(news.daily(fx.clean_news(spark, sf_dir)), "daily-news")


def sentiment(spark, sf_dir):
    return news.ticks_with_sentiment(fx.enriched(spark, sf_dir), daily_news(spark, sf_dir))


def feature_rows(spark, sf_dir, piece_rows: int = ordered.PIECE_ROWS, frames: bool = False):
    """The feature table; trade facts are stored first, as in the chain, and then scanned."""
    stored = stage(trades(spark, sf_dir), "trades")
    newest = news.newest_tick(stored.withColumnRenamed("trade_date", "date_parsed"), ID)
    latest = stage(news.latest_sentiment(
        news.ticks_with_sentiment(newest, daily_news(spark, sf_dir)), ID), "latest-sentiment")
    return features.build_features(stored, latest, ID, piece_rows, frames)


def latest_trades(spark, sf_dir):
    return dashboard.latest_per_symbol(trades(spark, sf_dir), dashboard.LATEST_TRADE, tiebreak=ID)


def rule_predictions(spark, sf_dir):
    """Predictions of a fixed rule (low RSI -> up), so that metric queries have exact answers."""
    up = 1 - F.col("rsi") / 100
    return ml.label(feature_rows(spark, sf_dir).withColumns({
        "probability_up": up, "probability_down": 1 - up, "prediction": (up > 0.5).cast("int"),
    }))


# -------------------------------------------------------------------- ticks

@exact
def ticks_built(spark, sf_dir):
    built = fx.stock_ticks(fx.table(spark, sf_dir, "events"))
    return ticks.publishable(built).drop("event_type")


@exact
def crypto_built(spark, sf_dir):
    return ticks.publishable(fx.crypto_ticks(fx.table(spark, sf_dir, "events"))).drop("event_type")


@exact
def crypto_enriched(spark, sf_dir):
    built = fx.crypto_ticks(fx.table(spark, sf_dir, "events"))
    return ticks.enrich(built).select(*BASE, "price", "volume", "market_cap", "price_direction",
                                      "is_price_spike", "is_high_volume", "volatility", "is_anomaly")


@exact
def metadata_lookup(spark, sf_dir):
    raw = fx.stock_ticks(fx.table(spark, sf_dir, "events"))
    tagged = ticks.with_metadata(raw, fx.dimension(spark, sf_dir))
    return tagged.select(ID, "symbol", "name", "sector", "exchange", "currency", "price")


@exact
def market_open(spark, sf_dir):
    return fx.stock_ticks(fx.table(spark, sf_dir, "events")).groupBy("exchange", "market_hours").agg(
        F.count("*").alias("ticks"), F.min("timestamp").alias("first_tick"), F.max("timestamp").alias("last_tick"))


@exact
def ticks_enriched(spark, sf_dir):
    return fx.enriched(spark, sf_dir).drop("event_type", "timestamp")


@exact
def wire_roundtrip(spark, sf_dir):
    """Ticks as keyed JSON messages with ISO text times, decoded, stored raw and enriched.

    The raw table stands between decoding and the validity filter, which then reaches
    its files; in one plan the filter would be pushed below the parser and parse twice.
    """
    raw = stage(topics.decode(wire_messages(spark, sf_dir), schemas.STOCK_DDL), "decoded")
    return ticks.enrich(raw).select(
        F.col("offset").alias(ID), "kafka_key", "symbol", "timestamp_parsed", "date_parsed", "hour",
        "minute", "price", "volume", "price_change", "price_change_pct", "market_hours", "is_anomaly")


def wire_messages(spark, sf_dir, kind: str = "stocks", further: dict[str, Column] | None = None) -> DataFrame:
    """Messages of a topic; ``further`` are fields beyond its first contract."""
    events = fx.table(spark, sf_dir, "events")
    built = fx.stock_ticks(events) if kind == "stocks" else fx.crypto_ticks(events)
    ts = F.col("timestamp")
    wire = built.withColumns({
        "_at": ts, "date": F.date_format(ts, "yyyy-MM-dd"), "source": F.lit("replay"),
        "timestamp": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    })
    payload = [*schemas.struct(jobs.RAW[kind][1]).names, *(further or {})]
    return sink.messages(wire.withColumns(further or {}), settings.TOPICS[kind], payload=payload, at=F.col("_at"),
                         offset=F.col(ID))


def news_messages(spark, sf_dir) -> DataFrame:
    scored = news.score(fx.articles(spark, sf_dir), fx.COMMON_POSITIVE, fx.COMMON_NEGATIVE)
    ts = F.col("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    wire = scored.withColumns({"_at": ts, "date": F.date_format(ts, "yyyy-MM-dd"), "published_at": iso,
                               "timestamp": iso})
    payload = schemas.struct(schemas.NEWS_DDL).names
    return sink.messages(wire, settings.TOPICS["news"], payload=payload, at=F.col("_at"), offset=F.col("doc_id"))


@exact
def anomalies(spark, sf_dir):
    return ticks.anomalies(fx.enriched(spark, sf_dir)).select(
        *BASE, "price", "price_change_pct", "is_price_spike", "is_high_volume", "volatility", "price_direction")


# ------------------------------------------------------------ bars and facts

@query
def ohlc_1min(spark, sf_dir):
    return candles.ohlc(fx.enriched(spark, sf_dir), tiebreak=ID)


@query
def ohlc_1hour_busy(spark, sf_dir):
    """Hourly candles over five busy keys: many ticks per window."""
    busy = fx.enriched(spark, sf_dir).withColumns({
        "symbol": F.col("event_type"), "sector": F.lit("all"), "exchange": F.lit("all"), "currency": F.lit("USD")})
    return candles.ohlc(busy, "1 hour", tiebreak=ID)


@query
def hourly_metrics(spark, sf_dir):
    return hourly(spark, sf_dir)


@query
def fact_candles(spark, sf_dir):
    return bars(spark, sf_dir)


@exact
def fact_trades(spark, sf_dir):
    return trades(spark, sf_dir)


# --------------------------------------------------------------------- news

@exact
def news_scored(spark, sf_dir):
    return news.score(fx.articles(spark, sf_dir)).select(
        "doc_id", "symbol", "sentiment_score", "sentiment_label", "positive_words", "negative_words")


@exact
def news_clean(spark, sf_dir):
    return fx.clean_news(spark, sf_dir).select(
        "doc_id", "symbol", "timestamp_parsed", "date_parsed", "sentiment_score", "sentiment_label",
        "positive_words", "negative_words", "sentiment_category")


@query
def news_daily(spark, sf_dir):
    return news.daily(fx.clean_news(spark, sf_dir))


@exact
def news_tagged(spark, sf_dir):
    """Newest five articles per symbol that mention one of its configured phrases."""
    return news.tag_articles(fx.articles(spark, sf_dir), keep=("doc_id",)).drop("url")


@exact
def news_tagged_common(spark, sf_dir):
    """The same for phrases that nearly every document holds: hot symbols."""
    phrases = {"W-THE": ["the ", " der "], "W-AND": [" and ", " und "], "W-OF": ["Of", "des"], "W-RARE": ["zzz-none"]}
    return news.tag_articles(fx.articles(spark, sf_dir), phrases, keep=("doc_id",)).drop("url")


@query
def tick_with_sentiment(spark, sf_dir):
    return sentiment(spark, sf_dir).select(*BASE, "price", "price_change_pct", "is_anomaly", *news.MEASURES)


@query
def sentiment_latest(spark, sf_dir):
    return news.latest_sentiment(sentiment(spark, sf_dir), ID)


# ------------------------------------------------------------ staging, marts

@exact
def stg_trades(spark, sf_dir):
    return marts.stg_stock_trades(trades(spark, sf_dir), keep=(ID,))


@query
def stg_candles(spark, sf_dir):
    return marts.stg_ohlc_candles(bars(spark, sf_dir))


@query
def stg_sentiment(spark, sf_dir):
    return marts.stg_sentiment(sentiment(spark, sf_dir))


@exact
def dim_current(spark, sf_dir):
    return marts.stg_dim_stocks(fx.dimension(spark, sf_dir))


@query
def daily_performance(spark, sf_dir):
    return marts.daily_performance(marts.stg_stock_trades(trades(spark, sf_dir), keep=(ID,)), ID)


@query
def stock_metrics_24h(spark, sf_dir):
    return marts.stock_metrics(marts.stg_ohlc_candles(stage(bars(spark, sf_dir), "candles")),
                               marts.stg_sentiment(sentiment(spark, sf_dir)), as_of(spark, sf_dir))


@exact
def dim_enhanced(spark, sf_dir):
    staged = marts.stg_stock_trades(trades(spark, sf_dir), keep=(ID,))
    return marts.dim_stocks_enhanced(marts.stg_dim_stocks(fx.dimension(spark, sf_dir)), staged,
                                     as_of(spark, sf_dir), ID)


@exact
def contract_trades(spark, sf_dir):
    """Trade facts in the declared warehouse contract."""
    return schemas.conform(trades(spark, sf_dir), schemas.WAREHOUSE_DDL["raw.stock_trades"],
                           absent=("source", "loaded_at"))


# ----------------------------------------------------------------- features

def _indicator(spark, sf_dir, compute, before, after=0, piece_rows=ordered.PIECE_ROWS):
    return ordered.over_sequence(trades(spark, sf_dir), compute, "symbol", "timestamp_parsed", ID,
                                 before=before, after=after, piece_rows=piece_rows)


@exact
def price_lags(spark, sf_dir):
    return _indicator(spark, sf_dir, features.price_lags, 5).select(
        *BASE, "price_lag_1", "price_lag_2", "price_lag_3", "price_lag_5")


@query
def moving_averages(spark, sf_dir):
    return _indicator(spark, sf_dir, features.moving_stats, 20).select(
        *BASE, "price_ma_5", "price_ma_10", "price_ma_20", "price_std_5", "price_std_10", "volume_ma_5")


@query
def rsi(spark, sf_dir):
    return _indicator(spark, sf_dir, lambda df, w: features.rsi(features.price_lags(df, w), w), 15).select(
        *BASE, "avg_gain", "avg_loss", "rsi")


@query
def indicator_ratios(spark, sf_dir):
    """Momentum, step change, volume ratio and Bollinger position of every tick."""
    return _indicator(spark, sf_dir, features.indicators, features.LONGEST_FRAME, 1).select(
        *BASE, "volume_ratio", "momentum_5", "price_change_1", "price_change_pct_1", "bb_position")


@exact
def calendar_features(spark, sf_dir):
    return features.calendar(trades(spark, sf_dir)).select(*BASE, "hour", "day_of_week", "is_market_open_hour")


@exact
def next_move(spark, sf_dir):
    return _indicator(spark, sf_dir, features.next_move, 0, 1).select(*BASE, "price", "price_next", "target")


@query
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query
def feature_table_split(spark, sf_dir):
    """The same table from very short pieces: frames still exact."""
    return feature_rows(spark, sf_dir, piece_rows=25)


@exact
def class_distribution(spark, sf_dir):
    return ml.class_distribution(feature_rows(spark, sf_dir))


# ---------------------------------------------------------------- dashboards

@exact
def newest_trades(spark, sf_dir):
    return dashboard.newest(trades(spark, sf_dir), settings.SCORED_ROWS, tiebreak=ID).select(
        *BASE, "price", "price_change_pct")


@exact
def latest_per_symbol(spark, sf_dir):
    return latest_trades(spark, sf_dir)


@query
def market_kpis(spark, sf_dir):
    return dashboard.market_kpis(latest_trades(spark, sf_dir))


@exact
def top_gainers(spark, sf_dir):
    return dashboard.top(latest_trades(spark, sf_dir), "price_change_pct", 5).select(
        "symbol", "price", "price_change_pct", "sector")


@exact
def top_losers(spark, sf_dir):
    return dashboard.top(latest_trades(spark, sf_dir), "price_change_pct", 5, ascending=True).select(
        "symbol", "price", "price_change_pct", "sector")


@query
def sector_rollup(spark, sf_dir):
    return dashboard.sector_map(latest_trades(spark, sf_dir))


@exact
def price_table(spark, sf_dir):
    return dashboard.price_table(latest_trades(spark, sf_dir))


def recent_ticks(spark, sf_dir, hours: int):
    """Ticks of the look-back.  Bars that start inside it hold no earlier ticks, so
    filtering before the aggregation gives the same bars and reaches the scan."""
    return dashboard.recent(fx.enriched(spark, sf_dir), "timestamp_parsed", as_of(spark, sf_dir), hours)


def recent_bars(spark, sf_dir, hours: int, symbol: str):
    found = recent_ticks(spark, sf_dir, hours).filter(F.col("symbol") == symbol)
    built = candles.fact_candles(candles.ohlc(found, tiebreak=ID))
    return dashboard.chart(built, as_of(spark, sf_dir), hours, symbol)


def recent_hours(spark, sf_dir, hours: int):
    return candles.hourly_metrics(recent_ticks(spark, sf_dir, hours), tiebreak=ID)


@exact
def chart_candles(spark, sf_dir):
    return recent_bars(spark, sf_dir, 24, "S7").select(
        "symbol", "window_start", "open", "high", "low", "close", "volume", "candle_color")


@exact
def chart_stats(spark, sf_dir):
    return dashboard.chart_stats(recent_bars(spark, sf_dir, 24, "S7"))


@exact
def chart_volume(spark, sf_dir):
    return dashboard.volume_by_color(recent_bars(spark, sf_dir, 24, "S7"))


@query
def newest_sentiment(spark, sf_dir):
    """The join gives one row per tick, so it is needed for the rows kept only."""
    kept = dashboard.newest(fx.enriched(spark, sf_dir), 500, tiebreak=ID)
    return news.ticks_with_sentiment(kept, daily_news(spark, sf_dir)).select(
        *BASE, "price", "price_change_pct", *news.MEASURES)


@query
def sentiment_dist(spark, sf_dir):
    return dashboard.sentiment_distribution(sentiment(spark, sf_dir))


@query
def sentiment_correlation(spark, sf_dir):
    return dashboard.sentiment_price_correlation(sentiment(spark, sf_dir))


@query
def sentiment_table(spark, sf_dir):
    return dashboard.sentiment_table(sentiment(spark, sf_dir), ID)


@exact
def trading_activity(spark, sf_dir):
    return dashboard.activity(recent_hours(spark, sf_dir, 24), as_of(spark, sf_dir))


@query
def volatility_top10(spark, sf_dir):
    """Ranking over the whole month, so that most symbols have an hour with two ticks."""
    return dashboard.volatility_ranking(recent_hours(spark, sf_dir, 24 * 31), as_of(spark, sf_dir), hours=24 * 31)


@exact
def anomaly_timeline(spark, sf_dir):
    return dashboard.anomaly_timeline(recent_hours(spark, sf_dir, 24), as_of(spark, sf_dir))


# ------------------------------------------------------------------ quality

@exact
def dq_tests(spark, sf_dir):
    """Tables that several tests read, directly or through a mart, are stored once."""
    dim, facts_ = fx.dimension(spark, sf_dir), stage(trades(spark, sf_dir), "trades")
    stored = stage(bars(spark, sf_dir), "candles")
    staged = marts.stg_stock_trades(facts_, keep=(ID,))
    built = fx.stock_ticks(fx.table(spark, sf_dir, "events")).withColumnRenamed("timestamp", "timestamp_parsed")
    return quality.run_tests({
        "stock_trades": built,   # before validation, so that the price test finds NULLs
        "ohlc_candles": stored,
        "dim_stocks": dim,
        "stg_stock_trades": staged,
        "fct_daily_performance": marts.daily_performance(staged, ID),
        "fct_stock_metrics": marts.stock_metrics(
            marts.stg_ohlc_candles(stored), marts.stg_sentiment(sentiment(spark, sf_dir)), as_of(spark, sf_dir)),
        "dim_stocks_enhanced": marts.dim_stocks_enhanced(dim, staged, as_of(spark, sf_dir), ID),
    })


@exact
def dq_duplicates(spark, sf_dir):
    """Uniqueness test on a column that does repeat."""
    return quality.unique(trades(spark, sf_dir), "fact_trades", "symbol")


@exact
def layer_profile(spark, sf_dir):
    return quality.profile(fx.stock_ticks(fx.table(spark, sf_dir, "events")), "stock_prices").unionByName(
        quality.profile(fx.enriched(spark, sf_dir), "stock_prices_enriched")).unionByName(
        quality.profile(fx.clean_news(spark, sf_dir), "news_sentiment_clean"))


# ---------------------------------------------------------------- streaming

def _drained(spark, df: DataFrame, label: str) -> DataFrame:
    out = fresh_path(spark, label)
    jobs.drain([sink.append_stream(df, out, f"{out}-checkpoint", name=None)])
    return batch_table(spark, out)


@exact
def stream_enriched(spark, sf_dir):
    live = ticks.enrich(fx.stock_ticks(fx.event_stream(spark, sf_dir)))
    return _drained(spark, live.select(*BASE, "price", "volume", "price_direction", "is_anomaly"), "enriched")


@query
def stream_ohlc(spark, sf_dir):
    """Minute candles from the event stream: the windows that the watermark has closed."""
    live = ticks.enrich(fx.stock_ticks(fx.event_stream(spark, sf_dir)))
    return _drained(spark, candles.fact_candles(jobs.stream_candles(live, tiebreak=ID)), "ohlc")


@query
def stream_hourly(spark, sf_dir):
    live = ticks.enrich(fx.stock_ticks(fx.event_stream(spark, sf_dir)))
    return _drained(spark, jobs.stream_hourly(live, tiebreak=ID), "hourly")


@exact
def stream_json_decode(spark, sf_dir):
    """Ticks written as JSON envelopes, read back as a topic stream, decoded and enriched."""
    folder = fresh_path(spark, "topic")     # this topic's alone: nothing to filter
    sink.publish_messages(wire_messages(spark, sf_dir), "json", folder)
    live = topics.decode(topics.replay_topic(spark, folder), schemas.STOCK_DDL)
    return ticks.enrich(_drained(spark, live, "decoded")).select(
        F.col("offset").alias(ID), "symbol", "timestamp_parsed", "price", "volume", "price_change_pct",
        "market_hours", "is_anomaly")


@query
def medallion_daily(spark, sf_dir):
    """The whole chain from topics to features; daily performance from its trade facts."""
    lake = run_chain(spark, sf_dir)
    stored = batch_table(spark, lake.table("gold", "fact_stock_trades"))
    return marts.daily_performance(marts.stg_stock_trades(stored, keep=("offset",)), "offset")


@query
def medallion_features(spark, sf_dir):
    """The feature table as the chain stores it."""
    return refresh.feature_table(spark, run_chain(spark, sf_dir))


def run_chain(spark, sf_dir, database: str | None = None) -> jobs.Lake:
    folder = fresh_path(spark, "topics")
    for kind, msgs in (("stocks", wire_messages(spark, sf_dir)), ("crypto", wire_messages(spark, sf_dir, "crypto")),
                       ("news", news_messages(spark, sf_dir))):
        sink.publish_messages(msgs, "json", f"{folder}/{settings.TOPICS[kind]}")
    feeds = {kind: topics.replay_topic(spark, f"{folder}/{topic}") for kind, topic in settings.TOPICS.items()}
    lake = jobs.Lake(fresh_path(spark, "lake"))
    report = medallion.run(spark, lake, feeds, valid_from=datetime(2024, 1, 1), database=database)
    if report is not None:
        sink.overwrite(report, lake.table("warehouse", "report"))
    return lake


_WAREHOUSES: dict[tuple[str, str], tuple[str, jobs.Lake]] = {}


def loaded(spark, sf_dir) -> tuple[str, jobs.Lake]:
    """Database that the chain has filled, and its lake; once per session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _WAREHOUSES:
        database = f"market_{uuid.uuid4().hex[:8]}"
        _WAREHOUSES[at] = (database, run_chain(spark, sf_dir, database))
    return _WAREHOUSES[at]


@query
def warehouse_performance(spark, sf_dir):
    """Daily performance as the warehouse stores it."""
    return spark.table(f"{loaded(spark, sf_dir)[0]}.fct_daily_performance").drop("created_at")


@query
def warehouse_metrics(spark, sf_dir):
    """24-hour metrics as the warehouse stores them, looking back from the newest trade."""
    return spark.table(f"{loaded(spark, sf_dir)[0]}.fct_stock_metrics").select(
        "symbol", "candle_count_24h", "avg_price_24h", "total_volume_24h", "high_24h", "low_24h", "current_price")


@exact
def warehouse_trades(spark, sf_dir):
    """Loaded trades in the declared columns."""
    return spark.table(f"{loaded(spark, sf_dir)[0]}.raw_stock_trades").drop("source", "loaded_at").withColumnRenamed(
        "offset", ID)


@exact
def warehouse_tests(spark, sf_dir):
    """The report of the declared data tests on the warehouse."""
    return snapshot(spark, loaded(spark, sf_dir)[1].table("warehouse", "report"))


# ----------------------------------------------------------------------- ml

@exact
def confusion_matrix(spark, sf_dir):
    return ml.confusion_matrix(rule_predictions(spark, sf_dir))


@query
def classification_metrics(spark, sf_dir):
    return ml.metrics(rule_predictions(spark, sf_dir), "rule")


@query
def accuracy_by_symbol(spark, sf_dir):
    return ml.accuracy_by_symbol(rule_predictions(spark, sf_dir))


@exact
def prediction_dist(spark, sf_dir):
    return ml.prediction_distribution(rule_predictions(spark, sf_dir))


@exact
def confidence_hist(spark, sf_dir):
    return ml.confidence_histogram(rule_predictions(spark, sf_dir))


@query
def live_accuracy(spark, sf_dir):
    """Accuracy of the rule against the metrics stored for its test rows."""
    predicted, path = stage(rule_predictions(spark, sf_dir), "predicted"), fresh_path(spark, "rule")
    ml.save_metrics(ml.metrics(ml.split(predicted)[1], "test"), path)
    return ml.live_accuracy(predicted, ml.stored_metrics(spark, path))


@query
def predictions_contract(spark, sf_dir):
    return ml.predictions_table(rule_predictions(spark, sf_dir))


_MODELS: dict[tuple[str, str], tuple[str, str]] = {}


def trained(spark, sf_dir):
    """Folder of the fitted model with its metrics, and the stored feature table with its
    split; fitted once per session and folder.  Rows that lack a feature have no dataset."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _MODELS:
        rows, model = fresh_path(spark, "features"), fresh_path(spark, "model")
        whole = reduce(lambda c, x: c & x, [F.col(c).isNotNull() for c in [*settings.FEATURE_COLUMNS, ml.LABEL]])
        found = stage(feature_rows(spark, sf_dir), "features")
        ml.with_split(found.filter(whole)).unionByName(
            found.filter(~whole).withColumn("dataset", F.lit(None).cast("string"))).write.parquet(rows)
        stored = spark.read.parquet(rows)
        fitted = ml.train(stored.filter("dataset = 'train'"))
        ml.save(fitted, model)
        scored = ml.predict(fitted, stored.filter("dataset is not null"))
        ml.save_metrics(ml.metrics(scored.filter("dataset = 'train'"), "train").unionByName(
            ml.metrics(scored.filter("dataset = 'test'"), "test")), model)
        _MODELS[at] = (model, rows)
    model, rows = _MODELS[at]
    return model, spark.read.parquet(rows)


@query
def split_sizes(spark, sf_dir):
    """Class counts of the training and the test set."""
    return ml.with_split(stage(ml.prepare(feature_rows(spark, sf_dir)), "features")).groupBy("dataset", ml.LABEL).agg(
        F.count("*").alias("count"))


@exact
def time_split(spark, sf_dir):
    """Prepared rows with their set by time: a fifth for tests, an hour of embargo, crossing frames purged."""
    rows = stage(ml.prepare(feature_rows(spark, sf_dir, frames=True)), "framed")
    return ml.with_time_split(rows).select("symbol", "timestamp_parsed", "price", ml.LABEL, *features.FRAME, "dataset")


@exact
def time_split_short(spark, sf_dir):
    """Counts of the sets for other shares and spans, from very short pieces."""
    rows = stage(ml.prepare(feature_rows(spark, sf_dir, piece_rows=25, frames=True)), "framed")
    parts = [ml.with_time_split(rows, share, timedelta(minutes=minutes)).groupBy("dataset").agg(
        F.lit(share).alias("share"), F.lit(minutes).alias("minutes"), F.count("*").alias("rows"),
        F.min("timestamp_parsed").alias("first"), F.max("timestamp_parsed").alias("last"))
        for share, minutes in ((0.5, 0), (0.35, 1_440), (0.05, 30))]
    return reduce(lambda a, b: a.union(b), parts)


@query
def gbt_metrics(spark, sf_dir):
    return ml.stored_metrics(spark, trained(spark, sf_dir)[0])


@query
def gbt_predictions(spark, sf_dir):
    """The newest feature rows, scored."""
    model, rows = trained(spark, sf_dir)
    newest = dashboard.newest(rows.drop("dataset"), settings.SCORED_ROWS, tiebreak="symbol")
    return ml.predictions_table(ml.predict(ml.load(model), newest))


@query
def gbt_importance(spark, sf_dir):
    return ml.importance(spark, ml.load(trained(spark, sf_dir)[0]))


@query
def gbt_facts(spark, sf_dir):
    """What holds for any fitted model: every prepared row is scored, probabilities add up
    to its set's size, labels and confidence follow from them, importances sum to 1."""
    model, rows = trained(spark, sf_dir)
    fitted = ml.load(model)
    weights = ml.importance(spark, fitted)
    total = weights.agg(F.round(F.sum("importance"), 6).alias("importance"), F.count("*").alias("features"))
    up, down = F.col("probability_up"), F.col("probability_down")
    facts_ = ml.predict(fitted, rows.filter("dataset is not null")).groupBy("dataset").agg(
        F.count("*").alias("rows"), F.round(F.sum(up + down), 3).alias("probability"),
        F.count_if((F.col("prediction") == 1) != (up > down)).alias("wrong_side"),
        F.count_if(F.col("confidence") < 0.5).alias("too_low"),
        F.count_if(F.col("correct") != (F.col("prediction") == F.col(ml.LABEL))).alias("wrong_mark"),
        F.sum(ml.LABEL).alias("ups"))
    return facts_.join(total, F.lit(True))


@exact
def prepared_features(spark, sf_dir):
    """Rows by class of which every feature is known."""
    return ml.prepare(feature_rows(spark, sf_dir)).groupBy(ml.LABEL).agg(F.count("*").alias("rows"))


# ------------------------------------------------------------- load and look

@exact
def epoch_times(spark, sf_dir):
    """Trade times that arrive as epoch milliseconds."""
    sent = trades(spark, sf_dir).select(ID, F.unix_millis(F.col("timestamp_parsed").cast("timestamp")).alias("timestamp_parsed"))
    return sink.epoch_to_time(sent)


@exact
def preview_trades(spark, sf_dir):
    return quality.preview(trades(spark, sf_dir), ID).select(*BASE, "price")


@exact
def stream_interval(spark, sf_dir):
    """Enriched ticks by interval triggers, stopped when all that is there is processed."""
    out = fresh_path(spark, "interval")
    live = ticks.enrich(fx.stock_ticks(fx.event_stream(spark, sf_dir))).select(*BASE, "price")
    running = sink.append_stream(live, out, f"{out}-checkpoint", name=None, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return batch_table(spark, out)


@exact
def stream_progress(spark, sf_dir):
    """Rows that the progress of a drained stream reports."""
    out = fresh_path(spark, "progress")
    live = ticks.enrich(fx.stock_ticks(fx.event_stream(spark, sf_dir))).select(*BASE)
    ended = jobs.drain([sink.append_stream(live, out, f"{out}-checkpoint", name=None)])
    return jobs.progress(spark, ended).agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


# ---------------------------------------------------------------- NULL ids

@query
def ohlc_null_ids(spark, sf_dir):
    """Minute candles from ticks of which every fifth has no id: it comes before the
    others of its time, and opens and closes are there."""
    some = fx.enriched(spark, sf_dir).withColumn(ID, F.when(F.col(ID) % 5 != 0, F.col(ID)))
    return candles.ohlc(some.withColumn("timestamp_parsed", F.date_trunc("minute", "timestamp_parsed")), "1 hour",
                        tiebreak=ID).select("symbol", "window_start", "high", "low", "tick_count",
                                            F.col("open").isNotNull().alias("opens"),
                                            F.col("close").isNotNull().alias("closes"))


# -------------------------------------------------- refreshes beside streams

FIRST, SECOND, LATE = "2024-01-20", "2024-01-26", "2024-01-24"


def grown(spark, sf_dir) -> tuple[jobs.Lake, DataFrame]:
    """A lake that grows in three steps with a refresh after each, and the days that the refreshes rewrote.

    The month up to the 19th, six more days, then the rest, with late ticks of a day that is long refreshed.
    """
    lake, refreshed = jobs.Lake(fresh_path(spark, "lake")), []
    events = fx.enriched(spark, sf_dir).withColumnRenamed(ID, "offset")
    found, articles = stage(events, "ticks"), stage(fx.clean_news(spark, sf_dir), "articles")
    late = (F.col("date_parsed") == F.lit(LATE).cast("date")) & (F.col("offset") % 7 == 3)
    before, between = F.col("date_parsed") < FIRST, F.col("date_parsed").between(FIRST, "2024-01-25")
    parts = [(before & ~late, before), (between & ~late, between), ((F.col("date_parsed") >= SECOND) | late,
                                                                   F.col("date_parsed") >= SECOND)]
    for step, (ticks_in, news_in) in enumerate(parts, 1):
        for table, df in (("stock_prices_enriched", found.where(ticks_in)), ("news_sentiment_clean", articles.where(news_in))):
            landing, declared = lake.table("landing", table), jobs.cleaned_schemas(spark, lake)[table]
            df = df.select([F.col(f.name).cast(f.dataType) for f in declared if f.name in df.columns])
            df.write.mode("append").parquet(landing)
            arrived = spark.readStream.schema(df.schema).parquet(landing)
            jobs.drain([sink.append_stream(arrived, lake.table("silver", table), lake.checkpoint("silver", table), None,
                                           partition_by=["date_parsed"])])
        jobs.drain(jobs.serve(spark, lake, only=("fact_stock_trades",)))
        for day in refresh.refresh_sentiment(spark, lake):
            refreshed.append((step, "stock_with_sentiment", day))
        refreshed.append((step, "indicators", refresh.refresh_indicators(spark, lake)))
    return lake, spark.createDataFrame([(s, t, None if d == "all" else d) for s, t, d in refreshed],
                                       "step int, refreshed string, day date")


@query
def refreshed_sentiment(spark, sf_dir):
    """Ticks with sentiment after three refreshes by changed days."""
    return refresh.sentiment_table(spark, grown(spark, sf_dir)[0]).select(
        F.col("offset").alias(ID), *BASE[1:], "price", *news.MEASURES)


@query
def refreshed_features(spark, sf_dir):
    """The feature table after three refreshes from carried rows."""
    return refresh.feature_table(spark, grown(spark, sf_dir)[0])


@exact
def refreshed_days(spark, sf_dir):
    """Which days each refresh rewrote; for indicators the first one, null for all."""
    return grown(spark, sf_dir)[1]


@exact
def evolved_ticks(spark, sf_dir):
    """Enriched ticks of a topic that gains fields: unknown to the contract at first, then declared.

    Messages up to the 9th lack the fields, later ones have them; they are declared when those up to the 19th are stored.
    """
    lake, folder = jobs.Lake(fresh_path(spark, "lake")), fresh_path(spark, "topic")
    plain = wire_messages(spark, sf_dir)
    wider = wire_messages(spark, sf_dir, further={
        "venue": F.concat(F.lit("V"), (F.col(ID) % 4).cast("string")), "lots": F.col(ID) % 5})
    at = F.col("timestamp")
    steps = [plain.where(at < "2024-01-10"), wider.where((at >= "2024-01-10") & (at < FIRST)), wider.where(at >= FIRST)]
    for step, sent in enumerate(steps):
        if step == 2:
            jobs.declare(spark, lake, "stocks", "venue STRING, lots BIGINT")
        sink.publish_messages(sent, "json", folder)
        jobs.drain(jobs.ingest(lake, {"stocks": topics.replay_topic(spark, folder)}))
        jobs.drain(jobs.refine(spark, lake, only=("stock_prices_enriched",)))
    return jobs.cleaned_table(spark, lake, "stock_prices_enriched").select(
        F.col("offset").alias(ID), *BASE[1:], "price", "venue", "lots", F.col(contracts.UNKNOWN).isNull().alias("known"))


# ------------------------------------------- sentiment, news and listing by time

def _known_sentiment(spark, sf_dir, piece_rows: int):
    return asof.as_of_join(
        fx.enriched(spark, sf_dir).select(*BASE, "price"),
        fx.clean_news(spark, sf_dir).select("doc_id", "symbol", F.col("timestamp_parsed").alias("reported"), "sentiment_score"),
        "symbol", "timestamp_parsed", "reported", ["doc_id", "reported", "sentiment_score"], "doc_id", piece_rows)


@exact
def sentiment_as_of(spark, sf_dir):
    """Every tick with the newest article on its symbol that was out at its time."""
    return _known_sentiment(spark, sf_dir, ordered.PIECE_ROWS)


@exact
def sentiment_as_of_split(spark, sf_dir):
    """The same from short pieces: what is known is carried from piece to piece."""
    return _known_sentiment(spark, sf_dir, 50)


@query
def news_once(spark, sf_dir):
    """Daily sentiment from a stream in which polls bring articles again: each counts once."""
    out, landing = fresh_path(spark, "news"), fresh_path(spark, "polls")
    first = stage(fx.clean_news(spark, sf_dir).withColumn("timestamp_parsed", F.col("timestamp_parsed").cast("timestamp")), "articles")
    again = first.withColumn("timestamp_parsed", F.col("timestamp_parsed") + F.expr("interval 1 hour"))
    for polled in (first.union(first.where(F.col("doc_id") % 3 == 0)), again.where(F.col("doc_id") % 2 == 0)):
        polled.write.mode("append").parquet(landing)
        arrived = spark.readStream.schema(first.schema).parquet(landing)
        jobs.drain([sink.append_stream(jobs.first_reports(arrived), out, f"{out}-checkpoint", None)])
    return news.daily(batch_table(spark, out))


def _relisted(spark, sf_dir):
    """The dimension after a second load: some instruments in another sector, some gone, some new."""
    listed = fx.dimension(spark, sf_dir).select(*facts.LISTED)
    number = F.substring("symbol", 2, 20).cast("bigint")
    was = facts.as_dimension(listed.where(number % 11 != 5), F.lit("2024-01-01"))
    now = listed.where(number % 7 != 2).withColumn("sector", F.when(number % 3 == 0, "MOVED").otherwise(F.col("sector")))
    return stage(dimension.merge_history(was, now, F.lit("2024-01-15 12:00:00")), "history")


@exact
def dim_history(spark, sf_dir):
    return _relisted(spark, sf_dir)


@exact
def trades_by_validity(spark, sf_dir):
    """Trade facts with the attributes that were valid at their time."""
    return dimension.by_validity(trades(spark, sf_dir).select(*BASE, "price"), _relisted(spark, sf_dir),
                                 "timestamp_parsed", ["name", "sector"])


# ------------------------------------------------------------ restarted streams

def _restarted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Ticks that a stream enriched in two runs from one checkpoint, and the progress recorded of both."""
    lake = jobs.Lake(fresh_path(spark, "lake"))
    events, landing = fx.table(spark, sf_dir, "events"), lake.table("landing", "events")
    for part in (events.where(F.col(ID) % 3 == 0), events.where(F.col(ID) % 3 != 0)):
        part.write.mode("append").parquet(landing)
        live = ticks.enrich(fx.stock_ticks(spark.readStream.schema(events.schema).parquet(landing)))
        ended = jobs.drain([sink.append_stream(live.select(*BASE, "price"), lake.table("silver", "ticks"),
                                               lake.checkpoint("silver", "ticks"), "restarted-ticks")])
        for _ in range(2):      # recording again counts nothing twice
            jobs.record_progress(spark, lake, ended)
    return batch_table(spark, lake.table("silver", "ticks")), jobs.recorded_progress(spark, lake)


@exact
def stream_restarted(spark, sf_dir):
    return _restarted(spark, sf_dir)[0]


@exact
def progress_recorded(spark, sf_dir):
    return _restarted(spark, sf_dir)[1].select("batch_id", "input_rows", "late_rows")


@query
def metrics_24h_moments(spark, sf_dir):
    """24-hour metrics from hourly moments; candles are built anew only for the hour that the look-back cuts."""
    now = as_of(spark, sf_dir)
    moments = stage(marts.hourly_moments(marts.stg_ohlc_candles(bars(spark, sf_dir))), "moments")
    cut = now - F.make_dt_interval(hours=F.lit(24))
    hour = fx.enriched(spark, sf_dir).where(F.date_trunc("hour", "timestamp_parsed") == F.date_trunc("hour", cut))
    edge = marts.stg_ohlc_candles(candles.fact_candles(candles.ohlc(hour, tiebreak=ID)))
    return marts.stock_metrics_from_moments(moments, edge, marts.stg_sentiment(sentiment(spark, sf_dir)), now)
