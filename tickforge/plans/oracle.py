"""SQL with the same answers as the registered queries, for an independent engine.

Written from the definitions, in plain window and join SQL, over the supplied tables.
"""

from __future__ import annotations

from tickforge import settings
from tickforge.sources.fixtures import COMMON_NEGATIVE, COMMON_POSITIVE


#: A run of characters outside Unicode white space, spelled out for RE2.
WORD = (r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
        r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def _round(x: str, places: int) -> str:
    """Correctly rounded decimal of a double (the formatter rounds the binary value)."""
    return f"CAST(format('{{:.{places}f}}', CAST({x} AS DOUBLE)) AS DOUBLE)"


def _hits(text: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, '{t}') AS BIGINT)" for t in terms) + ")"


def _built(source: str, scale: int, levels: list[str], extra: str) -> str:
    rounded = ", ".join(f"{_round(f'coalesce({c}, 0.0)', scale)} AS {c}" for c in levels)
    base = "nullif(prev_close, 0.0)"
    return f"""
  SELECT event_id, event_type, symbol, name, {extra}, timestamp, {rounded},
         {_round('price', scale)} AS price, coalesce(volume, 0) AS volume,
         {_round(f'CASE WHEN {base} IS NULL THEN price - price ELSE price - {base} END', scale)} AS price_change,
         {_round(f'CASE WHEN {base} IS NULL THEN 0.0 ELSE (price - {base}) / {base} * 100 END', 4)} AS price_change_pct
  FROM {source}"""


def _enriched(source: str) -> str:
    return f"""
  SELECT *, (is_price_spike OR is_high_volume) AS is_anomaly FROM (
    SELECT *, timestamp AS timestamp_parsed, CAST(timestamp AS DATE) AS date_parsed,
           CAST(hour(timestamp) AS INTEGER) AS hour, CAST(minute(timestamp) AS INTEGER) AS minute,
           abs(price_change_pct) > 2.0 AS is_price_spike, volume > 1000000 AS is_high_volume,
           abs(price_change_pct) AS volatility,
           CASE WHEN price_change > 0 THEN 'UP' WHEN price_change < 0 THEN 'DOWN' ELSE 'FLAT' END AS price_direction
    FROM {source} WHERE price > 0 AND volume >= 0)"""


def _ohlc(source: str, size: str, keys: str) -> str:
    return f"""
  SELECT {keys}, time_bucket(INTERVAL '{size}', timestamp_parsed) AS window_start,
         time_bucket(INTERVAL '{size}', timestamp_parsed) + INTERVAL '{size}' AS window_end,
         arg_min(price, (timestamp_parsed, event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (timestamp_parsed, event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume,
         round(avg(price), 6) AS avg_price, count(*) AS tick_count, max(price_change_pct) AS max_change_pct,
         min(price_change_pct) AS min_change_pct, count(*) FILTER (WHERE is_anomaly) AS anomaly_count
  FROM {source} GROUP BY ALL"""


def _scored(positive: list[str], negative: list[str]) -> str:
    return f"""
  SELECT *, CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative'
                 ELSE 'neutral' END AS sentiment_label
  FROM (
    SELECT *, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN n_words = 0 THEN 0.0::DOUBLE ELSE
             {_round('(positive_words - negative_words) / (n_words * 0.1::DOUBLE)', 4)} END)) AS sentiment_score
    FROM (SELECT *, {_hits('body', positive)} AS positive_words, {_hits('body', negative)} AS negative_words,
                 len(regexp_extract_all(body, '{WORD}')) AS n_words FROM articles))"""


_DEFAULT_POSITIVE = settings.POSITIVE_TERMS
_DEFAULT_NEGATIVE = settings.NEGATIVE_TERMS
_COUNTS = "news_count, positive_news_count, negative_news_count"
_MEASURES = f"round(news_sentiment, 6) AS news_sentiment, {_COUNTS}"
_W = "PARTITION BY symbol ORDER BY timestamp_parsed, event_id"
_STOCK_LEVELS = ["open", "day_high", "day_low", "prev_close"]
_OPEN = """(weekday(timestamp) BETWEEN 1 AND 5 AND (exchange = 'Crypto' OR
            (hour(timestamp) >= 9 AND hour(timestamp) < CASE WHEN exchange = 'NSE' THEN 16 ELSE 17 END)))"""

_AFTER = "(SELECT now FROM as_of) - INTERVAL '{} hours'"

#: Named steps; each may use the ones before it.
STEPS = {
    "as_of": "SELECT max(ts) AS now FROM events",
    "quotes": """
  SELECT event_id, event_type, 'S' || user_id AS symbol, 'S' || user_id AS name,
         'sector' || (user_id % 5) AS sector,
         CASE user_id % 3 WHEN 0 THEN 'NSE' WHEN 1 THEN 'NYSE' ELSE 'Crypto' END AS exchange,
         CASE WHEN user_id % 3 = 0 THEN 'INR' ELSE 'USD' END AS currency,
         price, 2000.0::DOUBLE + k::DOUBLE / 2 AS open, price + 1.25::DOUBLE AS day_high,
         price - 1.25::DOUBLE AS day_low,
         CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 67 = 0 THEN 0.0::DOUBLE
              ELSE k + 2000.07::DOUBLE END AS prev_close,
         k * 20000 AS volume, ts AS timestamp
  FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k,
               CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 0.0::DOUBLE
                    ELSE value + 2000 END AS price FROM events)""",
    "ticks": _built("quotes", 2, _STOCK_LEVELS, f"sector, exchange, currency, {_OPEN} AS market_hours"),
    "crypto": _built(
        "(SELECT * REPLACE (price * 1.03125::DOUBLE AS price, day_high * 1.03125::DOUBLE AS day_high, "
        "day_low * 1.03125::DOUBLE AS day_low, prev_close * 1.03125::DOUBLE AS prev_close) FROM quotes)",
        4, ["day_high", "day_low", "prev_close"],
        "'Crypto' AS sector, 'Crypto' AS exchange, 'USD' AS currency, volume * 1000 AS market_cap, "
        "true AS market_open"),
    "enriched": _enriched("ticks"),
    "crypto_enriched": _enriched("crypto"),
    "trades": """
  SELECT symbol, timestamp_parsed, date_parsed AS trade_date, sector, exchange, currency, price, volume,
         price_change, price_change_pct, is_anomaly, is_price_spike, is_high_volume, price_direction,
         volatility, event_id FROM enriched""",
    "bars": _ohlc("enriched", "1 minute", "symbol, sector, exchange, currency"),
    "candles": """
  SELECT *, CASE WHEN close > open THEN 'GREEN' WHEN close < open THEN 'RED' ELSE 'DOJI' END AS candle_color,
         round((high - low) / nullif(open, 0) * 100, 6) AS candle_range_pct FROM bars""",
    "stg_candles": """
  SELECT *, round(high - low, 6) AS price_range, round(close - open, 6) AS price_movement,
         round(CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END, 6) AS candle_change_pct
  FROM candles WHERE open IS NOT NULL AND close IS NOT NULL AND high >= low""",
    "hourly": """
  SELECT symbol, sector, exchange, date_trunc('hour', timestamp_parsed) AS hour_start,
         date_trunc('hour', timestamp_parsed) + INTERVAL '1 hour' AS hour_end,
         arg_min(price, (timestamp_parsed, event_id)) AS hour_open, max(price) AS hour_high,
         min(price) AS hour_low, arg_max(price, (timestamp_parsed, event_id)) AS hour_close,
         round(avg(price), 6) AS hour_avg_price, CAST(sum(volume) AS BIGINT) AS hour_volume,
         count(*) AS tick_count, round(stddev_samp(price), 6) AS price_stddev,
         count(*) FILTER (WHERE is_anomaly) AS anomaly_count
  FROM enriched GROUP BY symbol, sector, exchange, date_trunc('hour', timestamp_parsed)""",
    "articles": """
  SELECT doc_id, 'S' || (doc_id % 150) AS symbol, seen AS timestamp, seen AS published_at,
         lower(coalesce(CASE WHEN doc_id % 13 <> 0 THEN 'Report ' || source END, 'None') || ' ' ||
               coalesce(text, 'None')) AS body
  FROM (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER))
                  + to_hours(CAST(doc_id % 24 AS INTEGER)) AS seen FROM documents)""",
    "scored_default": _scored(_DEFAULT_POSITIVE, _DEFAULT_NEGATIVE),
    "news": f"""
  SELECT *, timestamp AS timestamp_parsed, CAST(timestamp AS DATE) AS date_parsed,
         CASE WHEN sentiment_score > 0.3 THEN 'POSITIVE' WHEN sentiment_score < -0.3 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment_category
  FROM ({_scored(COMMON_POSITIVE, COMMON_NEGATIVE)})""",
    "daily_news": """
  SELECT symbol, date_parsed AS news_date, avg(sentiment_score) AS news_sentiment, count(*) AS news_count,
         count(*) FILTER (WHERE sentiment_category = 'POSITIVE') AS positive_news_count,
         count(*) FILTER (WHERE sentiment_category = 'NEGATIVE') AS negative_news_count
  FROM news GROUP BY symbol, date_parsed""",
    "sentiment": """
  SELECT e.*, coalesce(n.news_sentiment, 0) AS news_sentiment, coalesce(n.news_count, 0) AS news_count,
         coalesce(n.positive_news_count, 0) AS positive_news_count,
         coalesce(n.negative_news_count, 0) AS negative_news_count
  FROM enriched e LEFT JOIN daily_news n ON e.symbol = n.symbol AND e.date_parsed = n.news_date""",
    "stg_sentiment": f"""
  SELECT symbol, timestamp_parsed, price, price_change_pct, news_sentiment, {_COUNTS},
         CASE WHEN news_sentiment > 0.3 THEN 'POSITIVE' WHEN news_sentiment < -0.3 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment_category,
         CASE WHEN news_count > 0 THEN positive_news_count::DOUBLE / news_count * 100 ELSE 0 END AS positive_ratio
  FROM sentiment WHERE news_sentiment IS NOT NULL""",
    "metrics24": f"""
  SELECT m.*, c.close AS current_price,
    coalesce(s.avg_sentiment_24h, 0) AS avg_sentiment_24h, coalesce(s.total_news_24h, 0) AS total_news_24h,
    coalesce(s.avg_positive_ratio, 0) AS avg_positive_ratio
  FROM (SELECT symbol, max(sector) AS sector, max(exchange) AS exchange, count(*) AS candle_count_24h,
          round(avg(close), 6) AS avg_price_24h, round(stddev_samp(close), 6) AS price_volatility_24h,
          CAST(sum(volume) AS BIGINT) AS total_volume_24h, max(high) AS high_24h, min(low) AS low_24h
        FROM stg_candles WHERE window_start >= {_AFTER.format(24)} GROUP BY symbol) m
  LEFT JOIN (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn
             FROM stg_candles) c ON m.symbol = c.symbol AND c.rn = 1
  LEFT JOIN (SELECT symbol, round(avg(news_sentiment), 6) AS avg_sentiment_24h,
               CAST(sum(news_count) AS BIGINT) AS total_news_24h, round(avg(positive_ratio), 6) AS avg_positive_ratio
             FROM stg_sentiment WHERE timestamp_parsed >= {_AFTER.format(24)} GROUP BY symbol) s
    ON m.symbol = s.symbol""",
    "dim": """
  SELECT 'S' || c_custkey AS symbol, c_name AS name, c_mktsegment AS sector, n_name AS exchange,
         r_name AS currency, true AS is_current, TIMESTAMP '2024-01-01' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "listed_again": """
  SELECT * REPLACE (CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 3 = 0 THEN 'MOVED' ELSE sector END AS sector)
  FROM dim WHERE CAST(substr(symbol, 2) AS BIGINT) % 7 <> 2""",
    "relisted": """
  SELECT w.*, n.symbol IS NOT NULL AND w.sector = n.sector AS same FROM (
    SELECT * FROM dim WHERE CAST(substr(symbol, 2) AS BIGINT) % 11 <> 5) w
  LEFT JOIN listed_again n ON w.symbol = n.symbol""",
    "history": """
  SELECT * EXCLUDE (same) REPLACE (same AS is_current,
         CASE WHEN NOT same THEN TIMESTAMP '2024-01-15 12:00:00' END AS valid_to) FROM relisted
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '2024-01-15 12:00:00' AS valid_from) FROM listed_again
  WHERE symbol NOT IN (SELECT symbol FROM relisted WHERE same)""",
    "arrivals": """
  SELECT *, CASE WHEN date_parsed = DATE '2024-01-24' AND event_id % 7 = 3 THEN 3 WHEN date_parsed < DATE '2024-01-20' THEN 1
                 WHEN date_parsed < DATE '2024-01-26' THEN 2 ELSE 3 END AS step FROM enriched""",
    "ranked_days": """
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_date ORDER BY timestamp_parsed, event_id) AS first_rank,
         row_number() OVER (PARTITION BY symbol, trade_date ORDER BY timestamp_parsed DESC, event_id DESC) AS last_rank
  FROM trades""",
    "days": """
  SELECT symbol, trade_date, min(price) AS day_low, max(price) AS day_high, round(avg(price), 6) AS day_avg_price,
         CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS tick_count,
         round(stddev_samp(price), 6) AS price_volatility,
         count(*) FILTER (WHERE is_anomaly) AS anomaly_count, count(*) FILTER (WHERE is_price_spike) AS spike_count,
         count(*) FILTER (WHERE price_direction = 'UP') AS up_ticks,
         count(*) FILTER (WHERE price_direction = 'DOWN') AS down_ticks,
         max(price) FILTER (WHERE first_rank = 1) AS day_open, max(price) FILTER (WHERE last_rank = 1) AS day_close
  FROM ranked_days GROUP BY symbol, trade_date""",
    "performance": """
  SELECT *, round(day_close - day_open, 6) AS day_change,
         round(CASE WHEN day_open <> 0 THEN (day_close - day_open) / day_open * 100 ELSE 0 END, 6) AS day_change_pct,
         CASE WHEN day_close > day_open THEN 'GREEN' WHEN day_close < day_open THEN 'RED' ELSE 'DOJI' END
           AS day_candle_color FROM days""",
    "enhanced": """
  SELECT d.symbol, d.name, d.sector, d.exchange, d.currency, t.price AS latest_price,
         t.timestamp_parsed AS last_trade_time,
         coalesce(t.timestamp_parsed >= (SELECT now FROM as_of) - INTERVAL '1 hour', false) AS is_actively_trading
  FROM dim d LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_parsed DESC, event_id DESC) AS rn FROM trades
  ) t ON d.symbol = t.symbol AND t.rn = 1""",
    "lags": f"""
  SELECT *, lag(price, 1) OVER w AS price_lag_1, lag(price, 2) OVER w AS price_lag_2,
         lag(price, 3) OVER w AS price_lag_3, lag(price, 5) OVER w AS price_lag_5,
         lead(price) OVER w AS price_next,
         {", ".join(f"avg(price) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS price_ma_{n}" for n in (5, 10, 20))},
         {", ".join(f"stddev_samp(price) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS price_std_{n}" for n in (5, 10))},
         avg(volume) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS volume_ma_5
  FROM trades WINDOW w AS ({_W})""",
    "moves": """
  SELECT *, CASE WHEN price - price_lag_1 > 0 THEN price - price_lag_1 ELSE 0 END AS gain,
         CASE WHEN price - price_lag_1 < 0 THEN price_lag_1 - price ELSE 0 END AS loss FROM lags""",
    "strength": f"""
  SELECT *, CASE WHEN avg_loss <> 0 THEN 100 - 100 / (1 + avg_gain / avg_loss) ELSE 50.0::DOUBLE END AS rsi
  FROM (SELECT *, avg(gain) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS avg_gain,
               avg(loss) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS avg_loss
        FROM moves WINDOW w AS ({_W}))""",
    "last_sentiment": """
  SELECT symbol, arg_max(news_sentiment, (timestamp_parsed, event_id)) AS sentiment_score,
         arg_max(news_count, (timestamp_parsed, event_id)) AS news_count FROM sentiment GROUP BY symbol""",
    "features": """
  SELECT s.symbol, s.timestamp_parsed, price, price_change_pct,
         round(price_ma_5, 6) AS price_ma_5, round(price_ma_10, 6) AS price_ma_10, round(price_ma_20, 6) AS price_ma_20,
         round(price_std_5, 6) AS price_std_5, round(price_std_10, 6) AS price_std_10,
         round(CASE WHEN price_lag_5 <> 0 THEN (price - price_lag_5) / price_lag_5 * 100 ELSE 0 END, 6) AS momentum_5,
         round(CASE WHEN price_lag_1 <> 0 THEN (price - price_lag_1) / price_lag_1 * 100 ELSE 0 END, 6)
           AS price_change_pct_1,
         rsi,
         round(CASE WHEN price_std_10 > 0 THEN (price - price_ma_20) / price_std_10 ELSE 0 END, 6) AS bb_position,
         volume, round(CASE WHEN volume_ma_5 > 0 THEN volume / volume_ma_5 ELSE 1 END, 6) AS volume_ratio,
         round(coalesce(l.sentiment_score, 0), 6) AS sentiment_score, coalesce(l.news_count, 0) AS news_count,
         CAST(hour(timestamp_parsed) AS INTEGER) AS hour, CAST(dayofweek(timestamp_parsed) + 1 AS INTEGER) AS day_of_week,
         CAST(hour(timestamp_parsed) BETWEEN 9 AND 16 AS INTEGER) AS is_market_open_hour,
         CASE WHEN price_next > price THEN 1 ELSE 0 END AS target, price_next
  FROM strength s LEFT JOIN last_sentiment l ON s.symbol = l.symbol
  WHERE price_next <> price""",
    "latest": """
  SELECT symbol, arg_max(sector, k) AS sector, arg_max(price, k) AS price, arg_max(price_change, k) AS price_change,
         arg_max(price_change_pct, k) AS price_change_pct, arg_max(volume, k) AS volume,
         arg_max(volatility, k) AS volatility, arg_max(is_anomaly, k) AS is_anomaly
  FROM (SELECT *, (timestamp_parsed, event_id) AS k FROM trades) GROUP BY symbol""",
    "predicted": """
  SELECT *, greatest(probability_up, probability_down) AS confidence,
         CASE prediction WHEN 1 THEN 'UP' ELSE 'DOWN' END AS prediction_label, prediction = target AS correct
  FROM (SELECT *, 1 - rsi / 100 AS probability_up, 1 - (1 - rsi / 100) AS probability_down,
               CAST(1 - rsi / 100 > 0.5 AS INTEGER) AS prediction FROM features)""",
}

STEPS["framed"] = STEPS["features"].replace("price_next\n  FROM strength s", f"""price_next, frame_from, frame_to
  FROM (SELECT *, first_value(timestamp_parsed) OVER (w ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS frame_from,
               lead(timestamp_parsed) OVER w AS frame_to FROM strength WINDOW w AS ({_W})) s""")


def _steps_for(select: str) -> str:
    """The WITH clause for the steps that ``select`` refers to, directly or through others."""
    needed: list[str] = []
    names = list(STEPS)

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in names:
            if name in words and name not in needed:
                visit(STEPS[name])
                needed.append(name)

    visit(select)
    ordered = [n for n in names if n in needed]
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in ordered) + "\n" if ordered else ""


_BASE = "event_id, symbol, timestamp_parsed"
_TAG = """SELECT symbol, rank, doc_id, published_at FROM (
  SELECT symbol, doc_id, published_at,
         CAST(row_number() OVER (PARTITION BY symbol ORDER BY published_at DESC, doc_id DESC) AS INTEGER) AS rank
  FROM ({hits})) WHERE rank <= 5"""


def _tagged(keywords: dict[str, list[str]]) -> str:
    parts = [
        f"SELECT '{symbol}' AS symbol, doc_id, published_at FROM articles WHERE "
        + " OR ".join(f"contains(body, '{p.lower()}')" for p in phrases)
        for symbol, phrases in keywords.items()
    ]
    return _TAG.format(hits="\n  UNION ALL ".join(parts))


_COMMON_PHRASES = {"W-THE": ["the ", " der "], "W-AND": [" and ", " und "], "W-OF": ["Of", "des"],
                   "W-RARE": ["zzz-none"]}
_TICK_COLUMNS = ("event_id, symbol, name, sector, exchange, currency, open, day_high, day_low, prev_close, "
                 "price, volume, price_change, price_change_pct")
_FEATURE_SQL = "SELECT * REPLACE (round(rsi, 6) AS rsi) FROM features"
_RECENT_BARS = f"FROM candles WHERE symbol = 'S7' AND window_start >= {_AFTER.format(24)}"
_NOT_NULL = "SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS rule, count(*) AS failures FROM {s} WHERE {c} IS NULL"
_UNIQUE = ("SELECT '{t}' AS table_name, '{c}' AS column_name, 'unique' AS rule, count(*) AS failures FROM "
           "(SELECT {c} FROM {s} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")

#: A row's set by the leading digits of its identity's md5; the hex digits are read one by one.
_DIGEST = "md5(coalesce(symbol, '') || '|' || CAST(epoch_us(timestamp_parsed) AS VARCHAR) || '|42')"
_DRAW = "(" + " + ".join(
    f"(position(substr({_DIGEST}, {k + 1}, 1) IN '0123456789abcdef') - 1) * {16 ** (7 - k)}::BIGINT" for k in range(8)) + ")"
_PREPARED = " AND ".join(f"{c} IS NOT NULL" for c in settings.FEATURE_COLUMNS)


def _split(rows: str) -> str:
    """Rows with their set: the fifth of each class with the smallest draws is for tests."""
    return f"""(SELECT *, CASE WHEN rank() OVER (PARTITION BY target ORDER BY draw)
    <= floor(count(*) OVER (PARTITION BY target) * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS dataset
  FROM (SELECT *, {_DRAW} AS draw FROM {rows} ))"""


def _time_split(share: float, minutes: int) -> str:
    """Prepared rows with their set by time."""
    return f"""(SELECT *, CASE WHEN timestamp_parsed < cut AND coalesce(frame_to, timestamp_parsed) < cut THEN 'train'
      WHEN frame_from >= cut AND timestamp_parsed >= cut + INTERVAL '{minutes} minutes' THEN 'test' ELSE 'purged' END AS dataset
    FROM framed, (SELECT timestamp_parsed AS cut FROM (
      SELECT timestamp_parsed, row_number() OVER (ORDER BY timestamp_parsed) AS place, count(*) OVER () AS n
      FROM framed WHERE {_PREPARED} ) WHERE place = CAST(floor({1.0 - share!r}::DOUBLE * n) AS BIGINT) + 1)
    WHERE {_PREPARED} )"""


_SELECTS = {
    "ticks_built": f"SELECT {_TICK_COLUMNS}, timestamp, market_hours FROM ticks WHERE price <> 0",
    "crypto_built": "SELECT event_id, symbol, name, sector, exchange, currency, market_cap, market_open, timestamp, "
                    "day_high, day_low, prev_close, price, volume, price_change, price_change_pct "
                    "FROM crypto WHERE price <> 0",
    "crypto_enriched": f"SELECT {_BASE}, price, volume, market_cap, price_direction, is_price_spike, "
                       "is_high_volume, volatility, is_anomaly FROM crypto_enriched",
    "metadata_lookup": """SELECT t.event_id, t.symbol, coalesce(d.name, t.symbol) AS name,
  coalesce(d.sector, 'Unknown') AS sector, coalesce(d.exchange, 'Unknown') AS exchange,
  coalesce(d.currency, 'USD') AS currency, t.price FROM ticks t LEFT JOIN dim d ON t.symbol = d.symbol""",
    "market_open": "SELECT exchange, market_hours, count(*) AS ticks, min(timestamp) AS first_tick, "
                   "max(timestamp) AS last_tick FROM ticks GROUP BY exchange, market_hours",
    "ticks_enriched": "SELECT * EXCLUDE (event_type, timestamp) FROM enriched",
    "wire_roundtrip": "SELECT event_id, symbol AS kafka_key, symbol, timestamp_parsed, date_parsed, hour, minute, "
                      "price, volume, price_change, price_change_pct, market_hours, is_anomaly FROM enriched",
    "anomalies": f"SELECT {_BASE}, price, price_change_pct, is_price_spike, is_high_volume, volatility, "
                 "price_direction FROM enriched WHERE is_anomaly",
    "ohlc_1min": "SELECT * FROM bars",
    "ohlc_1hour_busy": _ohlc(
        "(SELECT * REPLACE (event_type AS symbol, 'all' AS sector, 'all' AS exchange, 'USD' AS currency) FROM enriched)",
        "1 hour", "symbol, sector, exchange, currency"),
    "hourly_metrics": "SELECT * FROM hourly",
    "fact_candles": "SELECT * FROM candles",
    "fact_trades": "SELECT * FROM trades",
    "news_scored": "SELECT doc_id, symbol, sentiment_score, sentiment_label, positive_words, negative_words "
                   "FROM scored_default",
    "news_clean": "SELECT doc_id, symbol, timestamp_parsed, date_parsed, sentiment_score, sentiment_label, "
                  "positive_words, negative_words, sentiment_category FROM news",
    "news_daily": "SELECT * REPLACE (round(news_sentiment, 6) AS news_sentiment) FROM daily_news",
    "news_tagged": _tagged(settings.NEWS_KEYWORDS),
    "news_tagged_common": _tagged(_COMMON_PHRASES),
    "tick_with_sentiment": f"SELECT {_BASE}, price, price_change_pct, is_anomaly, {_MEASURES} FROM sentiment",
    "sentiment_latest": "SELECT * REPLACE (round(sentiment_score, 6) AS sentiment_score) FROM last_sentiment",
    "stg_trades": "SELECT * FROM trades",
    "stg_candles": "SELECT * FROM stg_candles",
    "stg_sentiment": "SELECT * REPLACE (round(news_sentiment, 6) AS news_sentiment, "
                     "round(positive_ratio, 6) AS positive_ratio) FROM stg_sentiment",
    "dim_current": "SELECT * FROM dim WHERE is_current",
    "daily_performance": "SELECT * FROM performance",
    "stock_metrics_24h": "SELECT * FROM metrics24",
    "metrics_24h_moments": "SELECT * FROM metrics24",
    "dim_enhanced": "SELECT * FROM enhanced",
    "contract_trades": "SELECT * EXCLUDE (event_id), CAST(NULL AS VARCHAR) AS source, "
                       "CAST(NULL AS TIMESTAMP) AS loaded_at FROM trades",
    "price_lags": f"SELECT {_BASE}, price_lag_1, price_lag_2, price_lag_3, price_lag_5 FROM lags",
    "moving_averages": f"SELECT {_BASE}, " + ", ".join(
        f"round({c}, 6) AS {c}" for c in
        ["price_ma_5", "price_ma_10", "price_ma_20", "price_std_5", "price_std_10", "volume_ma_5"]) + " FROM lags",
    "rsi": f"SELECT {_BASE}, round(avg_gain, 6) AS avg_gain, round(avg_loss, 6) AS avg_loss, round(rsi, 6) AS rsi "
           "FROM strength",
    "indicator_ratios": f"""SELECT {_BASE},
  round(CASE WHEN volume_ma_5 > 0 THEN volume / volume_ma_5 ELSE 1 END, 6) AS volume_ratio,
  round(CASE WHEN price_lag_5 <> 0 THEN (price - price_lag_5) / price_lag_5 * 100 ELSE 0 END, 6) AS momentum_5,
  round(price - price_lag_1, 6) AS price_change_1,
  round(CASE WHEN price_lag_1 <> 0 THEN (price - price_lag_1) / price_lag_1 * 100 ELSE 0 END, 6) AS price_change_pct_1,
  round(CASE WHEN price_std_10 > 0 THEN (price - price_ma_20) / price_std_10 ELSE 0 END, 6) AS bb_position FROM lags""",
    "calendar_features": f"SELECT {_BASE}, CAST(hour(timestamp_parsed) AS INTEGER) AS hour, "
                         "CAST(dayofweek(timestamp_parsed) + 1 AS INTEGER) AS day_of_week, "
                         "CAST(hour(timestamp_parsed) BETWEEN 9 AND 16 AS INTEGER) AS is_market_open_hour FROM trades",
    "next_move": f"SELECT {_BASE}, price, price_next, CASE WHEN price_next > price THEN 1 WHEN price_next < price "
                 "THEN 0 END AS target FROM lags",
    "feature_table": _FEATURE_SQL,
    "feature_table_split": _FEATURE_SQL,
    "medallion_features": _FEATURE_SQL,
    "class_distribution": "SELECT target, count(*) AS count FROM features GROUP BY target",
    "newest_trades": f"SELECT {_BASE}, price, price_change_pct FROM trades "
                     "ORDER BY timestamp_parsed DESC, event_id DESC LIMIT 100",
    "latest_per_symbol": "SELECT * FROM latest",
    "market_kpis": "SELECT count(*) AS symbols, round(avg(price_change_pct), 6) AS avg_change_pct, "
                   "count(*) FILTER (WHERE price_change_pct > 0) AS gainers, "
                   "count(*) FILTER (WHERE price_change_pct < 0) AS losers FROM latest",
    "top_gainers": "SELECT symbol, price, price_change_pct, sector FROM latest WHERE price_change_pct IS NOT NULL "
                   "ORDER BY price_change_pct DESC, symbol LIMIT 5",
    "top_losers": "SELECT symbol, price, price_change_pct, sector FROM latest WHERE price_change_pct IS NOT NULL "
                  "ORDER BY price_change_pct, symbol LIMIT 5",
    "sector_rollup": "SELECT sector, symbol, CAST(sum(volume) AS BIGINT) AS total_volume, "
                     "round(sum(price_change_pct * volume) / nullif(sum(volume), 0), 6) AS weighted_change_pct "
                     "FROM latest GROUP BY ROLLUP (sector, symbol)",
    "price_table": "SELECT symbol, sector, price, price_change, price_change_pct, volume, volatility, is_anomaly "
                   "FROM latest",
    "chart_candles": f"SELECT symbol, window_start, open, high, low, close, volume, candle_color {_RECENT_BARS}",
    "chart_stats": "SELECT arg_max(close, window_start) AS current_price, max(high) AS range_high, "
                   f"min(low) AS range_low, CAST(sum(volume) AS BIGINT) AS total_volume {_RECENT_BARS}",
    "chart_volume": f"SELECT window_start, volume, candle_color {_RECENT_BARS}",
    "newest_sentiment": f"SELECT {_BASE}, price, price_change_pct, {_MEASURES} FROM sentiment "
                        "ORDER BY timestamp_parsed DESC, event_id DESC LIMIT 500",
    "sentiment_dist": "SELECT symbol, round(news_sentiment, 6) AS news_sentiment, count "
                      "FROM (SELECT symbol, news_sentiment, count(*) AS count FROM sentiment GROUP BY ALL)",
    "sentiment_correlation": "SELECT round(corr(news_sentiment, price_change_pct), 6) AS correlation, "
                             "count(*) AS ticks FROM sentiment",
    "sentiment_table": "SELECT symbol, round(arg_max(news_sentiment, (timestamp_parsed, event_id)), 6) "
                       "AS news_sentiment, " + ", ".join(
        f"arg_max({c}, (timestamp_parsed, event_id)) AS {c}" for c in
        ["price", "price_change_pct", "news_count", "positive_news_count", "negative_news_count"]
    ) + " FROM sentiment GROUP BY symbol",
    "trading_activity": f"SELECT hour_start, symbol, tick_count FROM hourly WHERE hour_start >= {_AFTER.format(24)}",
    "volatility_top10": f"""SELECT symbol, sector, price_stddev FROM (
  SELECT symbol, arg_max(sector, hour_start) AS sector,
         arg_max(price_stddev, hour_start) FILTER (WHERE price_stddev IS NOT NULL) AS price_stddev
  FROM hourly WHERE hour_start >= {_AFTER.format(24 * 31)} GROUP BY symbol)
WHERE price_stddev IS NOT NULL ORDER BY price_stddev DESC, symbol LIMIT 10""",
    "anomaly_timeline": "SELECT hour_start, symbol, anomaly_count FROM hourly "
                        f"WHERE anomaly_count > 0 AND hour_start >= {_AFTER.format(24)}",
    "dq_tests": "\nUNION ALL ".join([
        _NOT_NULL.format(t=t, c=c, s=s) for t, c, s in [
            ("stock_trades", "symbol", "ticks"), ("stock_trades", "price", "ticks"),
            ("ohlc_candles", "symbol", "candles"), ("ohlc_candles", "window_start", "candles"),
            ("dim_stocks", "symbol", "dim"),
            ("stg_stock_trades", "symbol", "trades"), ("stg_stock_trades", "price", "trades"),
            ("fct_daily_performance", "symbol", "performance"),
            ("fct_daily_performance", "trade_date", "performance"),
            ("fct_stock_metrics", "symbol", "metrics24"),
            ("dim_stocks_enhanced", "symbol", "enhanced")]
    ] + [_UNIQUE.format(t=t, c="symbol", s=s) for t, s in [
        ("dim_stocks", "dim"), ("fct_stock_metrics", "metrics24"), ("dim_stocks_enhanced", "enhanced")]]),
    "dq_duplicates": _UNIQUE.format(t="fact_trades", c="symbol", s="trades"),
    "layer_profile": """SELECT 'stock_prices' AS table_name, count(*) AS total_rows, CAST(NULL AS BIGINT) AS anomalies FROM ticks
UNION ALL SELECT 'stock_prices_enriched', count(*), count(*) FILTER (WHERE is_anomaly) FROM enriched
UNION ALL SELECT 'news_sentiment_clean', count(*), NULL FROM news""",
    "stream_enriched": f"SELECT {_BASE}, price, volume, price_direction, is_anomaly FROM enriched",
    "stream_ohlc": "SELECT * FROM candles WHERE window_end <= "
                   "(SELECT max(timestamp_parsed) FROM enriched) - INTERVAL '2 minutes'",
    "stream_hourly": "SELECT * FROM hourly WHERE hour_end <= "
                     "(SELECT max(timestamp_parsed) FROM enriched) - INTERVAL '5 minutes'",
    "stream_json_decode": f"SELECT {_BASE}, price, volume, price_change_pct, market_hours, is_anomaly FROM enriched",
    "medallion_daily": "SELECT * FROM performance",
    "warehouse_performance": "SELECT * FROM performance",
    "warehouse_trades": "SELECT * FROM trades",
    "warehouse_metrics": """SELECT m.*, current_price FROM (
  SELECT symbol, count(*) AS candle_count_24h, round(avg(close), 6) AS avg_price_24h,
         CAST(sum(volume) AS BIGINT) AS total_volume_24h, max(high) AS high_24h, min(low) AS low_24h
  FROM stg_candles, (SELECT max(timestamp_parsed) AS newest FROM enriched )
  WHERE window_end <= newest - INTERVAL '2 minutes' AND window_start >= newest - INTERVAL '24 hours' GROUP BY symbol) m
JOIN (SELECT symbol, arg_max(close, window_start) AS current_price
      FROM stg_candles, (SELECT max(timestamp_parsed) AS newest FROM enriched )
      WHERE window_end <= newest - INTERVAL '2 minutes' GROUP BY symbol) c ON m.symbol = c.symbol""",
    "warehouse_tests": "\nUNION ALL ".join([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{r}' AS rule, 0 AS failures FROM (SELECT count(*) FROM ticks )"
        for t, c, r in [
            ("stock_trades", "symbol", "not_null"), ("stock_trades", "price", "not_null"),
            ("ohlc_candles", "symbol", "not_null"), ("ohlc_candles", "window_start", "not_null"),
            ("dim_stocks", "symbol", "not_null"), ("dim_stocks", "symbol", "unique"),
            ("stg_stock_trades", "symbol", "not_null"), ("stg_stock_trades", "price", "not_null"),
            ("fct_daily_performance", "symbol", "not_null"), ("fct_daily_performance", "trade_date", "not_null"),
            ("fct_stock_metrics", "symbol", "not_null"), ("fct_stock_metrics", "symbol", "unique"),
            ("dim_stocks_enhanced", "symbol", "not_null"), ("dim_stocks_enhanced", "symbol", "unique")]]),
    "confusion_matrix": "SELECT target AS actual, prediction, count(*) AS count FROM predicted GROUP BY target, prediction",
    "classification_metrics": """SELECT 'rule' AS dataset, tp + fp + fn + tn AS rows,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score
FROM (SELECT count(*) FILTER (WHERE target = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE target = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE target = 1 AND prediction = 0) AS fn,
             count(*) FILTER (WHERE target = 0 AND prediction = 0) AS tn FROM predicted)""",
    "accuracy_by_symbol": "SELECT symbol, count(*) FILTER (WHERE correct) AS correct, count(*) AS total, "
                          "round(avg(CAST(correct AS INTEGER)), 6) AS accuracy FROM predicted "
                          "GROUP BY symbol HAVING count(*) >= 5",
    "prediction_dist": "SELECT prediction_label, count(*) AS count FROM predicted GROUP BY prediction_label",
    "confidence_hist": "SELECT prediction_label, CAST(least(floor((confidence - 0.5) / 0.5 * 20) + 1, 20) AS INTEGER) "
                       "AS bin, count(*) AS count FROM predicted GROUP BY ALL",
    "live_accuracy": f"""SELECT round(live, 6) AS live_accuracy, round((live - test) * 100, 6) AS delta_points
FROM (SELECT avg(CAST(correct AS INTEGER)) AS live, avg(CAST(correct AS INTEGER)) FILTER (WHERE dataset = 'test') AS test
      FROM {_split('predicted')})""",
    "split_sizes": f"SELECT dataset, target, count(*) AS count FROM {_split(f'features WHERE {_PREPARED}')} GROUP BY ALL",
    "time_split": f"SELECT symbol, timestamp_parsed, price, target, frame_from, frame_to, dataset FROM {_time_split(0.2, 60)}",
    "time_split_short": "\n  UNION ALL ".join(f"""SELECT dataset, {share!r}::DOUBLE AS share, {minutes} AS minutes, count(*) AS rows,
      min(timestamp_parsed) AS first, max(timestamp_parsed) AS last FROM {_time_split(share, minutes)} GROUP BY dataset"""
        for share, minutes in ((0.5, 0), (0.35, 1_440), (0.05, 30))),
    "gbt_facts": f"""SELECT dataset, count(*) AS rows,
  CAST(count(*) AS DOUBLE) AS probability, 0 AS wrong_side, 0 AS too_low, 0 AS wrong_mark,
  CAST(sum(target) AS BIGINT) AS ups, 1.0::DOUBLE AS importance, {len(settings.FEATURE_COLUMNS)} AS features
FROM {_split(f'features WHERE {_PREPARED}')} GROUP BY 1""",
    "prepared_features": f"SELECT target, count(*) AS rows FROM features WHERE {_PREPARED} GROUP BY target",
    "stream_restarted": f"SELECT {_BASE}, price FROM enriched",
    "progress_recorded": "SELECT CAST(event_id % 3 <> 0 AS BIGINT) AS batch_id, count(*) AS input_rows, CAST(0 AS BIGINT) "
                         "AS late_rows FROM events GROUP BY 1",
    "refreshed_sentiment": f"SELECT {_BASE}, price, {_MEASURES} FROM sentiment",
    "refreshed_features": _FEATURE_SQL,
    "refreshed_days": """SELECT step, 'stock_with_sentiment' AS refreshed, date_parsed AS day FROM (
        SELECT step, date_parsed FROM arrivals UNION
        SELECT CASE WHEN date_parsed < DATE '2024-01-20' THEN 1 WHEN date_parsed < DATE '2024-01-26' THEN 2 ELSE 3 END,
               date_parsed FROM news)
      UNION ALL SELECT step, 'indicators', CASE WHEN step > 1 THEN min(date_parsed) END FROM arrivals GROUP BY step""",
    "evolved_ticks": f"""SELECT {_BASE}, price,
        CASE WHEN timestamp_parsed >= TIMESTAMP '2024-01-10' THEN 'V' || (event_id % 4) END AS venue,
        CASE WHEN timestamp_parsed >= TIMESTAMP '2024-01-10' THEN event_id % 5 END AS lots, true AS known FROM enriched""",
    **dict.fromkeys(["sentiment_as_of", "sentiment_as_of_split"], """
      SELECT e.event_id, e.symbol, e.timestamp_parsed, e.price, n.doc_id, n.reported, n.sentiment_score
      FROM enriched e ASOF LEFT JOIN (
        SELECT symbol, timestamp_parsed AS reported, max(doc_id) AS doc_id, arg_max(sentiment_score, doc_id) AS sentiment_score
        FROM news GROUP BY symbol, timestamp_parsed) n ON e.symbol = n.symbol AND e.timestamp_parsed >= n.reported"""),
    "news_once": "SELECT * REPLACE (round(news_sentiment, 6) AS news_sentiment) FROM daily_news",
    "dim_history": "SELECT * FROM history",
    "trades_by_validity": """SELECT t.event_id, t.symbol, t.timestamp_parsed, t.price, h.name AS dim_name, h.sector AS dim_sector
      FROM trades t LEFT JOIN history h ON t.symbol = h.symbol AND h.valid_from <= t.timestamp_parsed
       AND (h.valid_to IS NULL OR t.timestamp_parsed < h.valid_to)""",
    "epoch_times": "SELECT event_id, date_trunc('milliseconds', timestamp_parsed) AS timestamp_parsed FROM trades",
    "preview_trades": f"SELECT {_BASE}, price FROM trades ORDER BY event_id DESC LIMIT 5",
    "stream_interval": f"SELECT {_BASE}, price FROM enriched",
    "stream_progress": "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM events",
    "ohlc_null_ids": "SELECT symbol, time_bucket(INTERVAL '1 hour', timestamp_parsed) AS window_start, max(price) AS high, "
                     "min(price) AS low, count(*) AS tick_count, true AS opens, true AS closes FROM enriched GROUP BY ALL",
    "predictions_contract": "SELECT symbol, timestamp_parsed, price, prediction, prediction_label, "
                            "round(probability_down, 6) AS probability_down, round(probability_up, 6) AS probability_up, "
                            "round(confidence, 6) AS confidence, target AS actual, correct FROM predicted",
}

#: Six places are shown with a nudge, as a mean of prices in cents often lies exactly on a half.
_SHOWN = (", 6)", " + 1e-9, 6)")
ORACLE = {name: (_steps_for(select) + select).replace(*_SHOWN) for name, select in _SELECTS.items()}
