"""Default parameters of the engine.

Everything below the marker is a fixed value: results depend on these exact
words, names and numbers, so they are stated as plain text.  All of them are
defaults; the operators take them as arguments.
"""

# ---------------------------------------------------------------- fixed values

TOPICS = {
    "stocks": "stock-prices",
    "crypto": "crypto-prices",
    "news": "news-sentiment",
}

# symbol, name, sector, exchange, currency
INSTRUMENTS = [
    ("TCS.NS", "Tata Consultancy Services", "IT", "NSE", "INR"),
    ("INFY.NS", "Infosys", "IT", "NSE", "INR"),
    ("WIPRO.NS", "Wipro", "IT", "NSE", "INR"),
    ("TECHM.NS", "Tech Mahindra", "IT", "NSE", "INR"),
    ("HDFCBANK.NS", "HDFC Bank", "Banking", "NSE", "INR"),
    ("ICICIBANK.NS", "ICICI Bank", "Banking", "NSE", "INR"),
    ("SBIN.NS", "State Bank of India", "Banking", "NSE", "INR"),
    ("RELIANCE.NS", "Reliance Industries", "Energy", "NSE", "INR"),
    ("ADANIENT.NS", "Adani Enterprises", "Energy", "NSE", "INR"),
    ("TATAMOTORS.NS", "Tata Motors", "Auto", "NSE", "INR"),
    ("AAPL", "Apple", "Tech", "NYSE", "USD"),
    ("GOOGL", "Alphabet", "Tech", "NYSE", "USD"),
    ("MSFT", "Microsoft", "Tech", "NYSE", "USD"),
    ("NVDA", "Nvidia", "Tech", "NYSE", "USD"),
    ("AMZN", "Amazon", "Tech", "NYSE", "USD"),
    ("META", "Meta", "Tech", "NYSE", "USD"),
    ("BTC-USD", "Bitcoin", "Crypto", "Crypto", "USD"),
    ("ETH-USD", "Ethereum", "Crypto", "Crypto", "USD"),
    ("BNB-USD", "Binance Coin", "Crypto", "Crypto", "USD"),
    ("SOL-USD", "Solana", "Crypto", "Crypto", "USD"),
]

# symbol: phrases, any of which selects an article
NEWS_KEYWORDS = {
    "TCS.NS": ["TCS", "Tata Consultancy"],
    "INFY.NS": ["Infosys", "INFY"],
    "WIPRO.NS": ["Wipro"],
    "TECHM.NS": ["Tech Mahindra"],
    "HDFCBANK.NS": ["HDFC Bank"],
    "ICICIBANK.NS": ["ICICI Bank"],
    "SBIN.NS": ["SBI", "State Bank"],
    "RELIANCE.NS": ["Reliance Industries", "Jio"],
    "ADANIENT.NS": ["Adani"],
    "TATAMOTORS.NS": ["Tata Motors"],
    "AAPL": ["Apple", "iPhone"],
    "GOOGL": ["Google", "Alphabet"],
    "MSFT": ["Microsoft"],
    "NVDA": ["Nvidia", "NVDA"],
    "AMZN": ["Amazon", "AWS"],
    "META": ["Meta", "Facebook"],
    "BTC-USD": ["Bitcoin", "BTC"],
    "ETH-USD": ["Ethereum", "ETH"],
    "BNB-USD": ["Binance", "BNB"],
    "SOL-USD": ["Solana", "SOL"],
}

POSITIVE_TERMS = [
    "surge", "jump", "gain", "rise", "rally", "growth", "profit", "beat", "record", "strong",
    "bullish", "upgrade", "buy", "positive", "up", "high", "win", "success", "expand", "revenue",
    "earnings beat",
]

NEGATIVE_TERMS = [
    "fall", "drop", "decline", "loss", "crash", "weak", "miss", "concern", "risk", "sell",
    "bearish", "down", "low", "fail", "cut", "downgrade", "negative", "fear", "uncertainty",
    "layoff", "debt", "earnings miss",
]

UNKNOWN = "Unknown"             # sector and exchange of an unlisted symbol
DEFAULT_CURRENCY = "USD"
ARTICLES_PER_SYMBOL = 5

SPIKE_PCT = 2.0                 # |change %| above this is a price spike
HIGH_VOLUME = 1_000_000         # volume above this is high
LABEL_CUTOFF = 0.1              # lexicon label: positive / negative
CATEGORY_CUTOFF = 0.3           # stored category: POSITIVE / NEGATIVE

TICK_LATENESS = "2 minutes"     # watermark ahead of minute candles
HOURLY_LATENESS = "5 minutes"   # watermark ahead of hourly metrics
REPOLL_LATENESS = "2 days"      # how long a repeated article is recognised
INGEST_TRIGGER = "10 seconds"   # raw and cleaned layers
SERVING_TRIGGER = "30 seconds"  # star-schema layer

NEUTRAL_RSI = 50.0
MIN_SUPPORT = 5                 # predictions per symbol before it is ranked
SCORED_ROWS = 100               # newest feature rows scored for display

FEATURE_COLUMNS = [
    "price_change_pct", "price_ma_5", "price_ma_10", "price_ma_20",
    "price_std_5", "price_std_10", "momentum_5", "price_change_pct_1",
    "rsi", "bb_position", "volume", "volume_ratio",
    "sentiment_score", "news_count", "hour", "day_of_week", "is_market_open_hour",
]

# ------------------------------------------------------------ end fixed values
