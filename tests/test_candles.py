from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickforge.operators import candles, ticks

from tests.helpers import as_dicts, at, simple, tick_frame


def test_single_tick_window(spark):
    df = simple(spark, [5.0])
    bar = as_dicts(candles.ohlc(df, tiebreak="event_id"))[0]
    assert {bar[c] for c in ("open", "high", "low", "close", "avg_price")} == {5.0} and bar["tick_count"] == 1
    assert as_dicts(candles.hourly_metrics(df, tiebreak="event_id"))[0]["price_stddev"] is None


def test_window_boundary_and_arrival_order(spark):
    rows = [(3, "A", at(60), 9.0, 0.0, 0.0, 1), (1, "A", at(59.999999), 7.0, 0.0, 0.0, 1),
            (0, "A", at(0), 5.0, 0.0, 0.0, 1), (2, "A", at(0), 6.0, 0.0, 0.0, 1)]
    bars = as_dicts(candles.ohlc(ticks.enrich(tick_frame(spark, rows), ts="ts"), tiebreak="event_id"), "window_start")
    assert [(b["open"], b["close"], b["tick_count"]) for b in bars] == [(5.0, 7.0, 3), (9.0, 9.0, 1)]
    assert bars[1]["window_start"] == at(60)


def test_equal_times_are_ordered_by_id(spark):
    rows = [(i, "A", at(0), float(p), 0.0, 0.0, 1) for i, p in [(7, 3), (2, 1), (9, 2)]]
    bar = as_dicts(candles.ohlc(ticks.enrich(tick_frame(spark, rows), ts="ts"), tiebreak="event_id"))[0]
    assert (bar["open"], bar["close"]) == (1.0, 2.0)


def test_candle_color_and_range(spark):
    df = spark.createDataFrame([("A", 0.0, 2.0, 0.0, 0.0), ("B", 4.0, 6.0, 3.0, 5.0), ("C", 4.0, 4.0, 3.0, 3.0)],
                               "symbol string, open double, high double, low double, close double")
    for c in ("window_start", "window_end", "sector", "exchange", "currency"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    got = [(r["candle_color"], r["candle_range_pct"]) for r in as_dicts(candles.fact_candles(df), "symbol")]
    assert got == [("DOJI", None), ("GREEN", 75.0), ("RED", 25.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 300), st.floats(1, 100)), min_size=1, max_size=60))
def test_bar_properties(spark, data):
    rows = [(i, s, at(t), float(p), 0.0, 0.0, 1) for i, (s, t, p) in enumerate(data)]
    bars = as_dicts(candles.ohlc(ticks.enrich(tick_frame(spark, rows), ts="ts"), tiebreak="event_id"))
    assert sum(b["tick_count"] for b in bars) == len(rows)
    assert all(b["low"] <= min(b["open"], b["close"]) and max(b["open"], b["close"]) <= b["high"] for b in bars)


def test_endpoints_are_hash_aggregated(spark):
    plan = candles.ohlc(simple(spark, [1.0, 2.0]), tiebreak="event_id")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1
