"""Small frames in the shape of enriched ticks."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickforge.operators import ticks

START = datetime(2024, 1, 3, 10, 0, 0)   # a Wednesday

TICK = ("event_id bigint, symbol string, ts timestamp, price double, price_change double, "
        "price_change_pct double, volume bigint")


def at(seconds=0.0):
    return START + timedelta(seconds=seconds)


def tick_frame(spark, rows):
    """rows: (event_id, symbol, ts, price, price_change, price_change_pct, volume)"""
    df = spark.createDataFrame(rows, TICK)
    return df.withColumns({"sector": F.lit("Tech"), "exchange": F.lit("NYSE"), "currency": F.lit("USD"),
                           "name": F.col("symbol")})


def simple(spark, prices, symbol="A", step=1.0, volume=10):
    """Enriched ticks of one symbol, one per ``step`` seconds."""
    return ticks.enrich(tick_frame(spark, [
        (i, symbol, at(i * step), float(p), 0.0, 0.0, volume) for i, p in enumerate(prices)
    ]), ts="ts")


def as_dicts(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [r.asDict() for r in rows]
