import random

import pytest
from hypothesis import given, settings as hsettings, strategies as st
from pyspark.sql import functions as F

from tickforge import settings
from tickforge.functions import market, text
from tickforge.functions.clock import order_key, parse_time
from tickforge.functions.numbers import round_exact
from tickforge.operators import news

from tests.helpers import at


def test_round_exact_matches_correct_rounding(spark):
    rng = random.Random(1)
    values = [2.675, 0.15625, 0.03125, 1.005, -2.675, -0.00001, 0.0, 0.00625, 1e12 + 0.5, 123456789.125, 5e-5]
    values += [rng.uniform(-3000, 3000) for _ in range(3000)]
    values += [rng.randint(-10**6, 10**6) / 100000 for _ in range(3000)]      # many decimal ties
    values += [rng.randint(-10**6, 10**6) / 2**rng.randint(1, 12) for _ in range(3000)]  # binary ties
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (2, 4):
        got = [r[0] for r in df.select(round_exact(F.col("x"), places)).collect()]
        assert got == [round(v, places) for v in values]


def test_round_exact_keeps_null_and_nan(spark):
    row = spark.range(1).select(round_exact(F.lit(None).cast("double"), 2).alias("a"),
                                round_exact(F.lit(float("nan")), 2).alias("b")).first()
    assert row.a is None and row.b != row.b


@pytest.mark.parametrize("exchange,hour,day,expected", [
    ("NSE", "08:59", 3, False), ("NSE", "09:00", 3, True), ("NSE", "15:59", 3, True), ("NSE", "16:00", 3, False),
    ("NYSE", "16:00", 3, True), ("NYSE", "16:59", 3, True), ("NYSE", "17:00", 3, False),
    ("Crypto", "03:00", 3, True), ("Crypto", "12:00", 6, False), ("Unknown", "10:00", 7, False),
])
def test_market_hours(spark, exchange, hour, day, expected):
    ts = F.lit(f"2024-01-{day:02d} {hour}:00").cast("timestamp")
    assert spark.range(1).select(market.market_open(F.lit(exchange), ts)).first()[0] is expected


def test_three_way_bounds_are_exclusive(spark):
    df = spark.createDataFrame([(0.3,), (-0.3,), (0.31,), (-0.31,), (None,)], "s double")
    got = [r[0] for r in df.select(market.sentiment_category(F.col("s"))).collect()]
    assert got == ["NEUTRAL", "NEUTRAL", "POSITIVE", "NEGATIVE", "NEUTRAL"]


def test_malformed_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-03T10:00:00.123456",), ("2024-01-03T10:00:00",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_time(df, "t")).collect()]
    assert got[0] == at(0).replace(microsecond=123456) and got[1] == at(0) and got[2:] == [None, None]


def test_order_key_is_a_total_order(spark):
    df = spark.createDataFrame([(at(1), 5), (at(1), 4), (at(0), 9 * 10**18), (at(1.000001), 0)], "ts timestamp, id bigint")
    got = [tuple(r) for r in df.orderBy(order_key("ts", "id")).collect()]
    assert got == sorted((r["ts"], r["id"]) for r in df.collect())


def brute_sentiment(body, positive, negative):
    lowered = body.lower()
    p = sum(t in lowered for t in positive)
    n = sum(t in lowered for t in negative)
    count = len(lowered.split())
    score = max(-1.0, min(1.0, round((p - n) / (count * 0.1), 4))) if count else 0.0
    return score, "positive" if score > 0.1 else "negative" if score < -0.1 else "neutral", p, n


CASES = [
    ("Profit up", "strong growth and record revenue"), ("", ""), (None, "supply chain"), ("losses", None),
    (None, None), ("gain gain gain", "gain"), ("down " * 30, "low"), ("up " + "word " * 62, "end"),
    ("up " + "word " * 318, "x"), ("earnings beat", "earnings miss"), ("a b c\x1cd", "　x\x85y"),
    ("SURGE\tRALLY\nfear", "Debt"), ("x", "   "),
]


def test_sentiment_against_brute_force(spark):
    positive, negative = settings.POSITIVE_TERMS, settings.NEGATIVE_TERMS
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(CASES)], "id int, headline string, description string")
    got = [tuple(r)[3:] for r in news.score(df).select(
        "id", "headline", "description", "sentiment_score", "sentiment_label", "positive_words", "negative_words"
    ).orderBy("id").collect()]
    assert got == [brute_sentiment(f"{a} {b}", positive, negative) for a, b in CASES]


@hsettings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab up\t\n  \x1c\x85é", max_size=40), min_size=1, max_size=20))
def test_word_count_matches_split(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.word_count(F.col("t"))).collect()]
    assert got == [len(t.split()) for t in texts]


def test_default_lists_are_complete():
    assert len(settings.INSTRUMENTS) == 20 and len(settings.NEWS_KEYWORDS) == 20
    assert len(settings.POSITIVE_TERMS) == 21 and len(settings.NEGATIVE_TERMS) == 22
