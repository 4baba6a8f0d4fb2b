import math
import statistics

from pyspark.sql import Window, functions as F

from tickforge.operators import features

from tests.helpers import as_dicts, simple


def indicators(df):
    return features.indicators(df, Window.partitionBy("symbol").orderBy("timestamp_parsed", "event_id"))


def brute(prices, volumes):
    """Indicator rows by their definitions."""
    moves = [0.0] + [b - a for a, b in zip(prices, prices[1:])]
    out = []
    for i, p in enumerate(prices):
        past = prices[:i]
        lag = lambda k: prices[i - k] if i >= k else None
        std = lambda n: statistics.stdev(past[-n:]) if len(past[-n:]) > 1 else None
        mean = lambda xs: sum(xs) / len(xs) if xs else None
        recent = moves[max(0, i - 14):i]
        gain, loss = mean([max(m, 0) for m in recent]), mean([max(-m, 0) for m in recent])
        vol = mean(volumes[max(0, i - 5):i])
        ma20, s10 = mean(past[-20:]), std(10)
        out.append({
            "price_ma_5": mean(past[-5:]), "price_ma_20": ma20, "price_std_5": std(5), "price_std_10": s10,
            "momentum_5": (p - lag(5)) / lag(5) * 100 if lag(5) else 0.0,
            "price_change_pct_1": (p - lag(1)) / lag(1) * 100 if lag(1) else 0.0,
            "rsi": 100 - 100 / (1 + gain / loss) if loss else 50.0,
            "bb_position": (p - ma20) / s10 if s10 else 0.0,
            "volume_ratio": volumes[i] / vol if vol else 1.0,
            "price_next": prices[i + 1] if i + 1 < len(prices) else None,
        })
    return out


def check(spark, prices, volume=10):
    got = as_dicts(indicators(simple(spark, prices, volume=volume)), "event_id")
    for row, want in zip(got, brute([float(p) for p in prices], [volume] * len(prices)), strict=True):
        for name, value in want.items():
            if value is None:
                assert row[name] is None, name
            else:
                assert math.isclose(row[name], value, rel_tol=1e-9, abs_tol=1e-9), (name, row[name], value)


def test_short_and_long_histories(spark):
    base = [10, 11, 10.5, 12, 9, 9.5, 13, 13, 12, 11, 14, 10, 9, 8, 12, 13, 15, 11, 10, 12, 16, 15, 14, 18, 17]
    for n in (1, 2, 5, 6, 14, 15, 21, 25):
        check(spark, base[:n])


def test_only_gains_gives_neutral_rsi(spark):
    rows = as_dicts(indicators(simple(spark, range(1, 20))))
    assert {r["rsi"] for r in rows} == {50.0}


def test_constant_price_and_zero_volume(spark):
    rows = as_dicts(indicators(simple(spark, [5.0] * 12, volume=0)))
    assert {r["bb_position"] for r in rows} == {0.0} and {r["volume_ratio"] for r in rows} == {1.0}
    assert {r["target"] for r in rows} == {None}


def test_feature_table_has_known_targets_only(spark):
    trades = simple(spark, [5, 6, 6, 4, 7])
    latest = spark.createDataFrame([("A", 0.5, 3)], "symbol string, sentiment_score double, news_count bigint")
    rows = as_dicts(features.build_features(trades, latest, "event_id"), "timestamp_parsed")
    assert [(r["price"], r["target"]) for r in rows] == [(5.0, 1), (6.0, 0), (4.0, 1)]
    assert list(rows[0]) == features.OUTPUT and len(features.OUTPUT) == 22
    assert (rows[0]["sentiment_score"], rows[0]["news_count"], rows[0]["hour"], rows[0]["day_of_week"]) == (0.5, 3, 10, 4)
    none = features.build_features(trades, latest.filter("false"), "event_id").first()
    assert (none["sentiment_score"], none["news_count"]) == (0.0, 0)


def test_past_features_ignore_the_future(spark):
    before = as_dicts(indicators(simple(spark, [5, 6, 7, 3, 4, 8, 9])), "event_id")
    after = as_dicts(indicators(simple(spark, [5, 6, 7, 3, 40, 80, 90])), "event_id")
    for a, b in zip(before[:4], after[:4]):
        for name in a.keys() - {"price_next", "target"}:
            assert a[name] == b[name]


def test_market_hour_flag_bounds(spark):
    df = spark.createDataFrame([(f"2024-01-07 {h:02d}:30:00",) for h in (8, 9, 16, 17)], "t string").select(
        F.col("t").cast("timestamp").alias("timestamp_parsed"))
    rows = as_dicts(features.calendar(df), "timestamp_parsed")
    assert [r["is_market_open_hour"] for r in rows] == [0, 1, 1, 0] and rows[0]["day_of_week"] == 1
