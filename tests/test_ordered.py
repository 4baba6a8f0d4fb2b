"""Cut windows give what one window per symbol gives, with bounded pieces."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Window, functions as F

from tickforge.operators import features, ordered

from tests.helpers import START

SCHEMA = "symbol string, timestamp_parsed timestamp, event_id bigint, price double, volume bigint"


def hot_frame(spark, seed, rows=1500, missing_times=False):
    """One symbol holds most rows; half of its rows share a second, a fifth share one instant."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        symbol = "HOT" if rng.random() < 0.7 else rng.choice(["A", "B", "C", None])
        kind = rng.random()
        if kind < 0.2:
            ts = START
        elif kind < 0.5:
            ts = START + timedelta(microseconds=rng.randrange(1_000_000))
        else:
            ts = START + timedelta(seconds=rng.randrange(20 * 86400), microseconds=rng.randrange(1_000_000))
        if missing_times and rng.random() < 0.05:
            ts = None
        data.append((symbol, ts, i, float(rng.randint(1, 50)), rng.randint(0, 9)))
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("seed,piece_rows,missing", [(1, 40, False), (2, 20, False), (3, 150, True), (4, 5000, False)])
def test_indicators_equal_plain_windows(spark, seed, piece_rows, missing):
    df = hot_frame(spark, seed, missing_times=missing).cache()
    plain = features.indicators(df, Window.partitionBy("symbol").orderBy("timestamp_parsed", "event_id"))
    cut = ordered.over_sequence(df, features.indicators, "symbol", "timestamp_parsed", "event_id",
                                before=20, after=1, piece_rows=piece_rows)
    assert cut.columns == plain.columns
    assert collected(cut) == collected(plain)


def sparse_ids(i):
    return "A", START, i if i else 10 ** 15


def one_instant(i):
    return "A", START, i


def microsecond_burst(i):
    return "A", START + timedelta(microseconds=100 * i), i


def no_symbol(i):
    return None, START + timedelta(seconds=i), i


def many_symbols(i):
    return f"S{i}", START, i


@pytest.mark.parametrize("shape", [sparse_ids, one_instant, microsecond_burst, no_symbol, many_symbols])
def test_pieces_and_borrowed_rows_are_bounded(spark, shape):
    n, size, before, after = 4000, 100, 20, 1
    df = spark.createDataFrame([(*shape(i), float(i), 1) for i in range(n)], SCHEMA)
    found = ordered.lent(ordered.positioned(df, "symbol", "timestamp_parsed", "event_id"), before, after, size).cache()
    assert found.filter("_to = _piece").count() == n
    own = found.filter("_to = _piece").groupBy("_piece").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(own) == (size, n // size)
    assert found.groupBy("_to").count().agg(F.max("count")).first()[0] <= size + before + after
    assert found.filter("_to <> _piece").count() <= (before + after) * n // size


def test_positions_are_the_order(spark):
    df = hot_frame(spark, 9, missing_times=True)
    got = ordered.positioned(df, "symbol", "timestamp_parsed", "event_id").orderBy("_position").collect()
    assert [r["_position"] for r in got] == list(range(len(got)))
    assert [r.event_id for r in got] == [r.event_id for r in df.orderBy("symbol", "timestamp_parsed", "event_id").collect()]


def test_a_piece_must_hold_its_neighbours_frames(spark):
    with pytest.raises(ValueError):
        ordered.over_sequence(hot_frame(spark, 6), features.price_lags, "symbol", "timestamp_parsed", "event_id",
                              before=5, piece_rows=4)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    out = ordered.over_sequence(none, features.price_lags, "symbol", "timestamp_parsed", "event_id", before=5)
    assert out.collect() == []


def test_lookahead_only(spark):
    df = hot_frame(spark, 8)
    plain = features.next_move(df, Window.partitionBy("symbol").orderBy("timestamp_parsed", "event_id"))
    cut = ordered.over_sequence(df, features.next_move, "symbol", "timestamp_parsed", "event_id",
                                before=0, after=1, piece_rows=9)
    assert collected(cut) == collected(plain)
