from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.operators import dashboard, facts, ticks

from tests.helpers import as_dicts, at, tick_frame

QUOTE = ("symbol string, exchange string, price double, open double, day_high double, day_low double, "
         "prev_close double, volume bigint, timestamp timestamp")


def quotes(spark, rows):
    return spark.createDataFrame([("A", "NYSE", p, None, None, None, prev, vol, at()) for p, prev, vol in rows], QUOTE)


def test_price_change_uses_the_unrounded_price(spark):
    rows = as_dicts(ticks.build_stock_ticks(quotes(spark, [(100.126, 100.0, 5), (100.125, 100.0, None)])))
    assert [(r["price"], r["price_change"], r["price_change_pct"]) for r in rows] == [
        (round(100.126, 2), round(100.126 - 100, 2), round((100.126 - 100.0) / 100.0 * 100, 4)),
        (round(100.125, 2), round(100.125 - 100, 2), round((100.125 - 100.0) / 100.0 * 100, 4)),
    ]
    assert rows[0]["open"] == 0.0 and rows[1]["volume"] == 0 and rows[0]["market_hours"] is True


@pytest.mark.parametrize("prev", [None, 0.0])
def test_no_previous_close_means_no_change(spark, prev):
    row = as_dicts(ticks.build_stock_ticks(quotes(spark, [(12.5, prev, 1)])))[0]
    assert row["price_change"] == 0.0 and row["price_change_pct"] == 0.0 and row["prev_close"] == 0.0


def test_crypto_has_four_decimals_and_is_open(spark):
    df = quotes(spark, [(0.123456, 0.12, 3)]).drop("open").withColumn("market_cap", F.lit(None).cast("bigint"))
    row = as_dicts(ticks.build_crypto_ticks(df))[0]
    assert row["price"] == 0.1235 and row["exchange"] == "Crypto" and row["market_open"] and row["market_cap"] == 0


def test_unpriced_quotes_are_not_published(spark):
    assert ticks.publishable(quotes(spark, [(None, 1.0, 1), (0.0, 1.0, 1), (3.0, 1.0, 1)])).count() == 1


def test_metadata_defaults(spark):
    dim = facts.dim_stocks(spark, datetime(2024, 1, 1))
    df = spark.createDataFrame([("AAPL", "?", "?", "?", "?"), ("ZZZ", "?", "?", "?", "?")],
                               "symbol string, name string, sector string, exchange string, currency string")
    rows = as_dicts(ticks.with_metadata(df, dim).select("symbol", "name", "sector", "exchange", "currency"), "symbol")
    assert list(rows[0].values()) == ["AAPL", "Apple", "Tech", "NYSE", "USD"]
    assert list(rows[1].values()) == ["ZZZ", "ZZZ", "Unknown", "Unknown", "USD"]


def test_dimension_contract(spark):
    dim = facts.dim_stocks(spark, datetime(2024, 1, 1))
    assert dim.count() == 20 and dim.filter("is_current and valid_to is null").count() == 20
    assert [f.nullable for f in dim.schema] == [False] * 7 + [True]


def test_flags_at_their_thresholds(spark):
    rows = [
        (0, "A", at(0), 10.0, 1.0, 2.0, 1_000_000),     # both exactly on the bound
        (1, "A", at(1), 10.0, -1.0, -2.0001, 1),        # spike
        (2, "A", at(2), 10.0, 0.0, 0.0, 1_000_001),     # high volume
        (3, "A", at(3), 10.0, None, None, 2_000_000),   # unknown OR true
        (4, "A", at(4), 10.0, None, None, 1),           # unknown OR false
    ]
    got = as_dicts(ticks.enrich(tick_frame(spark, rows), ts="ts"), "event_id")
    assert [r["is_price_spike"] for r in got] == [False, True, False, None, None]
    assert [r["is_high_volume"] for r in got] == [False, False, True, True, False]
    assert [r["is_anomaly"] for r in got] == [False, True, True, True, None]
    assert [r["price_direction"] for r in got] == ["UP", "DOWN", "FLAT", "FLAT", "FLAT"]
    assert got[1]["volatility"] == 2.0001 and got[0]["hour"] == 10 and got[0]["minute"] == 0


def test_invalid_ticks_are_dropped(spark):
    rows = [(0, "A", at(), None, 0.0, 0.0, 1), (1, "A", at(), 0.0, 0.0, 0.0, 1), (2, "A", at(), -1.0, 0.0, 0.0, 1),
            (3, "A", at(), 1.0, 0.0, 0.0, None), (4, "A", at(), 1.0, 0.0, 0.0, -1), (5, "A", at(), 1.0, 0.0, 0.0, 0)]
    assert [r["event_id"] for r in as_dicts(ticks.enrich(tick_frame(spark, rows), ts="ts"))] == [5]


def test_latest_takes_the_last_known_value_per_column(spark):
    rows = [(0, "A", at(0), 1.0, 1.0, 5.0, 1), (1, "A", at(1), 2.0, 1.0, None, 1), (2, "B", at(0), 3.0, 1.0, None, 1)]
    latest = dashboard.latest_per_symbol(tick_frame(spark, rows), ["price", "price_change_pct"], "ts", "event_id")
    assert {tuple(r) for r in latest.collect()} == {("A", 2.0, 5.0), ("B", 3.0, None)}
    kpis = dashboard.market_kpis(latest).first()
    assert (kpis.symbols, kpis.avg_change_pct, kpis.gainers, kpis.losers) == (2, 5.0, 1, 0)
    assert dashboard.top(latest, "price_change_pct", 5).count() == 1


def test_sector_map_without_volume(spark):
    df = spark.createDataFrame([("s1", "A", 2.0, 0), ("s2", "B", 1.0, 10), ("s2", "C", 4.0, 30)],
                               "sector string, symbol string, price_change_pct double, volume bigint")
    got = {(r.sector, r.symbol): (r.total_volume, r.weighted_change_pct) for r in dashboard.sector_map(df).collect()}
    assert got[("s1", None)] == (0, None) and got[("s2", None)] == (40, 3.25) and got[(None, None)] == (40, 3.25)


@pytest.mark.parametrize("n", [1, 3, 4, 7, 50])
def test_newest_reads_only_the_last_days(spark, n):
    rows = [(i, "A", at(d * 86400 + i), float(i + 1), 0.0, 0.0, 1) for i, d in enumerate([0, 0, 0, 1, 4, 4, 4])]
    df = ticks.enrich(tick_frame(spark, rows), ts="ts")
    whole = dashboard.newest(df, n, tiebreak="event_id")
    pruned = dashboard.newest(df, n, tiebreak="event_id", day="date_parsed")
    assert [r.event_id for r in pruned.collect()] == [r.event_id for r in whole.collect()] == list(range(6, 6 - min(n, 7), -1))
