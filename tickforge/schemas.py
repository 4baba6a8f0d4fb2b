"""Column contracts of the wire, the lake and the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def _fields(ddl: str) -> str:
    return ", ".join(line.strip().rstrip(",") for line in ddl.strip().splitlines())


# Names and types below are the data contract.

ENVELOPE_DDL = _fields("""
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP
""")

STOCK_DDL = _fields("""
    symbol STRING, name STRING, sector STRING, exchange STRING, currency STRING
    price DOUBLE, open DOUBLE, day_high DOUBLE, day_low DOUBLE, prev_close DOUBLE
    volume BIGINT, price_change DOUBLE, price_change_pct DOUBLE
    timestamp STRING, date STRING, market_hours BOOLEAN, source STRING
""")

CRYPTO_DDL = _fields("""
    symbol STRING, name STRING, sector STRING, exchange STRING, currency STRING
    price DOUBLE, day_high DOUBLE, day_low DOUBLE, prev_close DOUBLE
    volume BIGINT, market_cap BIGINT, price_change DOUBLE, price_change_pct DOUBLE
    timestamp STRING, date STRING, market_open BOOLEAN, source STRING
""")

NEWS_DDL = _fields("""
    symbol STRING, headline STRING, description STRING, source STRING, url STRING
    published_at STRING, sentiment_score DOUBLE, sentiment_label STRING
    positive_words BIGINT, negative_words BIGINT, timestamp STRING, date STRING
""")

DIM_DDL = _fields("""
    symbol STRING NOT NULL, name STRING NOT NULL, sector STRING NOT NULL
    exchange STRING NOT NULL, currency STRING NOT NULL, is_current BOOLEAN NOT NULL
    valid_from TIMESTAMP NOT NULL, valid_to TIMESTAMP
""")

WAREHOUSE_DDL = {
    "raw.stock_trades": _fields("""
        symbol STRING, timestamp_parsed TIMESTAMP_NTZ, trade_date DATE, sector STRING
        exchange STRING, currency STRING, price DOUBLE, volume BIGINT, price_change DOUBLE
        price_change_pct DOUBLE, is_anomaly BOOLEAN, is_price_spike BOOLEAN
        is_high_volume BOOLEAN, price_direction STRING, volatility DOUBLE, source STRING
        loaded_at TIMESTAMP_NTZ
    """),
    "raw.ohlc_candles": _fields("""
        symbol STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, sector STRING
        exchange STRING, currency STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE
        volume BIGINT, avg_price DOUBLE, tick_count INT, max_change_pct DOUBLE
        min_change_pct DOUBLE, anomaly_count INT, candle_color STRING
        candle_range_pct DOUBLE, loaded_at TIMESTAMP_NTZ
    """),
    "raw.stock_sentiment": _fields("""
        symbol STRING, timestamp_parsed TIMESTAMP_NTZ, price DOUBLE, price_change_pct DOUBLE
        news_sentiment DOUBLE, news_count INT, positive_news_count INT
        negative_news_count INT, loaded_at TIMESTAMP_NTZ
    """),
    "raw.dim_stocks": _fields("""
        symbol STRING, name STRING, sector STRING, exchange STRING, currency STRING
        is_current BOOLEAN, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ
    """),
    "ml.features": _fields("""
        symbol STRING, timestamp_parsed TIMESTAMP_NTZ, price DOUBLE, price_change_pct DOUBLE
        price_ma_5 DOUBLE, price_ma_10 DOUBLE, price_ma_20 DOUBLE, price_std_5 DOUBLE
        price_std_10 DOUBLE, momentum_5 DOUBLE, price_change_pct_1 DOUBLE, rsi DOUBLE
        bb_position DOUBLE, volume BIGINT, volume_ratio DOUBLE, sentiment_score DOUBLE
        news_count INT, hour INT, day_of_week INT, is_market_open_hour INT, target INT
        price_next DOUBLE
    """),
    "ml.predictions": _fields("""
        symbol STRING, timestamp_parsed TIMESTAMP_NTZ, price DOUBLE, prediction INT
        prediction_label STRING, probability_down DOUBLE, probability_up DOUBLE
        confidence DOUBLE, actual INT, correct BOOLEAN, created_at TIMESTAMP_NTZ
    """),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str, absent: tuple[str, ...] = (), keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto a contract: order, names and types; ``keep`` names columns that
    follow as they are.

    Columns named in ``absent`` may be missing and become NULL; any other missing
    column is an error, so a renamed upstream column cannot turn into NULLs.
    """
    schema, have = struct(ddl), {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name not in have and f.name not in absent]
    if missing:
        raise ValueError(f"columns missing for this contract: {', '.join(missing)}")
    return df.select([
        (F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ] + [F.col(c) for c in keep or [] if c.lower() not in {f.name.lower() for f in schema}])
