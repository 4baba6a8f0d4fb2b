"""The whole chain on the supplied tables, twice, then the warehouse."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge import settings
from tickforge.operators import dashboard, features
from tickforge.plans import catalogue, medallion, refresh, warehouse
from tickforge.sinks import lake as sink
from tickforge.sources import fixtures as fx, topics
from tickforge.sources.lake import batch_table, snapshot, versions
from tickforge.streaming import jobs


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("chain")
    folder, lake = str(root / "topics"), jobs.Lake(str(root / "lake"))
    cut = F.lit("2024-01-16").cast("timestamp")
    stocks = catalogue.wire_messages(spark, sf_dir)
    late = F.col("timestamp") >= cut

    def feeds():
        return {k: topics.replay_topic(spark, folder, t) for k, t in settings.TOPICS.items()}

    # first half of the month, then the rest: the second run continues from the checkpoints
    sink.publish_messages(stocks.filter(~late), "json", folder)
    sink.publish_messages(catalogue.wire_messages(spark, sf_dir, "crypto"), "json", folder)
    sink.publish_messages(catalogue.news_messages(spark, sf_dir), "json", folder)
    medallion.run(spark, lake, feeds(), valid_from=datetime(2024, 1, 1))
    sink.publish_messages(stocks.filter(late), "json", folder)
    medallion.run(spark, lake, feeds(), valid_from=datetime(2024, 1, 1), database="market")
    return lake


def test_layers_hold_every_message_once(spark, sf_dir, lake):
    events = fx.table(spark, sf_dir, "events").count()
    raw = batch_table(spark, lake.table("bronze", "stock_prices"))
    assert raw.count() == events and raw.select("offset").distinct().count() == events
    assert "ingested_at" in raw.columns
    assert batch_table(spark, lake.table("bronze", "crypto_prices")).count() == events
    valid = fx.enriched(spark, sf_dir).count()
    for layer, table in [("silver", "stock_prices_enriched"), ("gold", "fact_stock_trades")]:
        assert batch_table(spark, lake.table(layer, table)).count() == valid
    assert refresh.sentiment_table(spark, lake).count() == valid
    assert snapshot(spark, lake.table("gold", "dim_stocks")).count() == 20
    assert batch_table(spark, lake.table("silver", "news_sentiment_clean")).count() == \
        fx.table(spark, sf_dir, "documents").count()


def test_candles_and_hours_cover_all_but_open_windows(spark, lake):
    ticks = batch_table(spark, lake.table("silver", "stock_prices_enriched"))
    closed = ticks.agg(F.max("timestamp_parsed")).first()[0]
    bars = batch_table(spark, lake.table("gold", "fact_ohlc_candles"))
    counted = bars.agg(F.sum("tick_count")).first()[0]
    open_ticks = ticks.filter(F.window("timestamp_parsed", "1 minute").end > F.lit(closed) - F.expr("interval 2 minutes"))
    assert counted + open_ticks.count() == ticks.count()
    hours = batch_table(spark, lake.table("gold", "hourly_metrics"))
    assert hours.groupBy("symbol", "hour_start").count().filter("count > 1").count() == 0


def test_trade_look_back_prunes_days(spark, lake):
    trades = batch_table(spark, lake.table("gold", "fact_stock_trades"))
    plan = trades.filter(F.col("trade_date") >= "2024-01-29")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan


def test_chart_look_back_prunes_days(spark, lake):
    bars = batch_table(spark, lake.table("gold", "fact_ohlc_candles"))
    found = dashboard.chart(bars, F.lit(datetime(2024, 1, 30)), 24, "S7", day="candle_date")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(candle_date" in plan


def test_chain_with_a_silent_topic_and_a_new_field(spark, sf_dir, tmp_path):
    folder, quiet = str(tmp_path / "topics"), jobs.Lake(str(tmp_path / "lake"))
    some = catalogue.wire_messages(spark, sf_dir).limit(200)
    sink.publish_messages(some, "json", f"{folder}/stocks")
    for topic in ("crypto", "news"):
        (tmp_path / "topics" / topic).mkdir(parents=True)
    feeds = {k: topics.replay_topic(spark, f"{folder}/{k}") for k in settings.TOPICS}
    medallion.run(spark, quiet, feeds, valid_from=datetime(2024, 1, 1))
    ticks = batch_table(spark, quiet.table("silver", "stock_prices_enriched"))
    joined = refresh.sentiment_table(spark, quiet)
    assert joined.count() == ticks.count() > 0 and joined.filter("news_count <> 0").count() == 0


def test_snapshots_are_bounded_and_claimed(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        sink.overwrite(spark.range(n + 1), path, keep=2)
    assert versions(spark, path) == [5, 6] and snapshot(spark, path).count() == 6
    (tmp_path / "t" / "_claims" / "7").touch()      # another writer is at work
    sink.overwrite(spark.range(3), path, keep=2)
    assert versions(spark, path) == [6, 8] and snapshot(spark, path).count() == 3


def test_keys_share_a_partition(spark, sf_dir):
    sent = catalogue.wire_messages(spark, sf_dir).groupBy("key").agg(F.countDistinct("partition").alias("n"))
    assert {r.n for r in sent.collect()} == {1}


def test_feature_table_is_current(spark, lake):
    stored = refresh.feature_table(spark, lake)
    assert stored.columns == features.OUTPUT and stored.filter("target is null").count() == 0


def test_warehouse_models(spark, lake):
    report = warehouse.build(spark, "market", F.lit(datetime(2024, 1, 30, 23, 59)))
    assert {r.failures for r in report.collect()} == {0}
    perf = spark.table("market.fct_daily_performance")
    assert perf.agg(F.sum("tick_count")).first()[0] == spark.table("stg_stock_trades").count()
    assert {"created_at", "day_open", "day_candle_color"} <= set(perf.columns)
    assert spark.table("market.fct_stock_metrics").count() > 0
    assert spark.table("market.dim_stocks_enhanced").count() == 20
    assert spark.table("market.ml_features").count() > 0


def test_absent_folders_are_skipped(spark, tmp_path):
    assert warehouse.load(spark, jobs.Lake(str(tmp_path)), "empty") == []
