"""Refreshes by changed days, schema versions, values as of a time, dimension history, repeated articles."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import asof, dimension, facts, features, marts, news, ticks
from tickforge.plans import refresh
from tickforge.sinks import lake as sink
from tickforge.sources import commits, contracts, topics
from tickforge.sources.lake import batch_table
from tickforge.streaming import jobs

from tests.helpers import as_dicts, tick_frame

DAY = datetime(2024, 1, 1)


# ------------------------------------------------------------- commit logs

def added(spark, root, days, batch):
    """One micro-batch of rows on ``days``."""
    df = spark.createDataFrame([(batch * 100 + i, d) for i, d in enumerate(days)], "id int, day date").coalesce(1)
    df.write.mode("append").parquet(f"{root}/landing")
    live = spark.readStream.schema(df.schema).parquet(f"{root}/landing")
    jobs.drain([sink.append_stream(live, f"{root}/table", f"{root}/checkpoint", None, partition_by=["day"])])


def test_changed_days_come_from_the_log(spark, tmp_path):
    root, first = str(tmp_path), commits.Mark()
    assert commits.changed_days(spark, f"{root}/table", "day", first) == commits.Changes(frozenset(), first)
    added(spark, root, [date(2024, 1, 1), None], 0)
    one = commits.changed_days(spark, f"{root}/table", "day", first)
    assert one.days == {date(2024, 1, 1), None} and one.mark.batch == 0
    assert commits.changed_days(spark, f"{root}/table", "day", one.mark).days == frozenset()
    added(spark, root, [date(2024, 1, 3)], 1)
    added(spark, root, [date(2024, 1, 2), date(2024, 1, 3)], 2)
    assert commits.changed_days(spark, f"{root}/table", "day", one.mark).days == {date(2024, 1, 2), date(2024, 1, 3)}


def write_log(root, batches, compact):
    """Log files by hand: ``batches`` of (path, time), of which those up to ``compact`` are in one file."""
    log = root / "_spark_metadata"
    log.mkdir(parents=True)

    def lines(rows):
        return "\n".join(["v1", *(json.dumps({"path": p, "size": 1, "isDir": False, "modificationTime": t,
                                              "blockReplication": 1, "blockSize": 1, "action": "add"}) for p, t in rows)])
    (log / f"{compact}.compact").write_text(lines([r for b in batches[:compact + 1] for r in b]))
    for n, rows in enumerate(batches):
        if n > compact:
            (log / str(n)).write_text(lines(rows))


def test_a_compact_log_never_names_too_few_days(spark, tmp_path):
    hour = 3_600_000
    batches = [[(f"file:///t/day=2024-01-{n + 1:02d}/part-{n}.parquet", n * 10 * hour)] for n in range(12)]
    write_log(tmp_path / "t", batches, 9)
    path = str(tmp_path / "t")
    everything = commits.changed_days(spark, path, "day", commits.Mark())
    assert len(everything.days) == 12 and everything.mark == commits.Mark(11, 110 * hour)
    assert commits.changed_days(spark, path, "day", commits.Mark(9, 90 * hour)).days == {date(2024, 1, 11), date(2024, 1, 12)}
    assert commits.changed_days(spark, path, "day", commits.Mark(6, 60 * hour)).days == {
        date(2024, 1, n) for n in range(7, 13)}     # the mark's own day, within the slack, comes again


# ------------------------------------------------------ refreshes of a lake

def quotes(r, days, n, start=0):
    """Rows of tick_frame on ``days``, as wire-like enriched ticks."""
    rows = []
    for i in range(n):
        at = DAY + timedelta(days=r.choice(days), seconds=r.randrange(0, 86_400, 600))
        rows.append((start + i, r.choice("AAAAAABCD"), at, float(r.randrange(90, 110)), 0.5, 0.5, r.randrange(1, 99)))
    return rows


def arrive(spark, lake, rows, articles=()):
    enriched = ticks.enrich(tick_frame(spark, rows), ts="ts").drop("ts").withColumnRenamed("event_id", "offset")
    written = news.clean(spark.createDataFrame(
        [(s, u, t, x) for s, u, t, x in articles], "symbol string, url string, timestamp timestamp, sentiment_score double"))
    for table, df in (("stock_prices_enriched", enriched), ("news_sentiment_clean", written)):
        if not df.isEmpty():
            declared = jobs.cleaned_schemas(spark, lake)[table]
            df = df.select([F.col(f.name).cast(f.dataType) for f in declared if f.name in df.columns])
            df.write.mode("append").parquet(lake.table("landing", table))
            live = spark.readStream.schema(df.schema).parquet(lake.table("landing", table))
            jobs.drain([sink.append_stream(live, lake.table("silver", table), lake.checkpoint("silver", table), None,
                                           partition_by=["date_parsed"])])
    jobs.drain(jobs.serve(spark, lake, only=("fact_stock_trades",)))


def refreshed(spark, lake):
    return refresh.refresh_sentiment(spark, lake), refresh.refresh_indicators(spark, lake, piece_rows=40)


def files(root, folder):
    return {str(p): p.stat().st_mtime_ns for p in (root / folder).rglob("*.parquet")}


def same_as_rebuilt(spark, lake):
    trades = batch_table(spark, lake.table("gold", "fact_stock_trades"))
    found = jobs.cleaned_table(spark, lake, "stock_prices_enriched")
    joined = news.ticks_with_sentiment(found, news.daily(jobs.cleaned_table(spark, lake, "news_sentiment_clean")))
    columns = ["symbol", "offset", "timestamp_parsed", "price", *news.MEASURES]

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)
    assert rows(refresh.sentiment_table(spark, lake).select(columns)) == rows(joined.select(columns))
    want = features.build_features(trades, news.latest_sentiment(joined, "offset"), "offset")
    shown = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert rows(refresh.feature_table(spark, lake).select(shown)) == rows(want.select(shown))
    assert want.count() > 0


def test_refreshes_compute_changed_days_only(spark, tmp_path):
    lake, r = jobs.Lake(str(tmp_path)), random.Random(3)
    arrive(spark, lake, quotes(r, [0, 1, 2], 120), [("A", "u1", DAY, 0.5), ("B", "u2", DAY + timedelta(days=1), -0.4)])
    assert refreshed(spark, lake) == ({date(2024, 1, d) for d in (1, 2, 3)}, "all")
    same_as_rebuilt(spark, lake)
    assert refreshed(spark, lake) == (frozenset(), None)

    old = files(tmp_path, "gold/stock_with_sentiment"), files(tmp_path, "ml/indicators")
    arrive(spark, lake, quotes(r, [3, 4], 60, 1000))
    assert refreshed(spark, lake) == ({date(2024, 1, 4), date(2024, 1, 5)}, date(2024, 1, 4))
    for was, folder in zip(old, ("gold/stock_with_sentiment", "ml/indicators"), strict=True):
        now = files(tmp_path, folder)
        assert was.items() <= now.items() and len(now) > len(was)
    same_as_rebuilt(spark, lake)

    # late ticks of a refreshed day, and an article for a day whose ticks are older
    arrive(spark, lake, quotes(r, [3], 9, 2000), [("A", "u3", DAY, 0.9), ("A", "u4", DAY + timedelta(days=4), 0.7)])
    assert refreshed(spark, lake) == ({date(2024, 1, d) for d in (1, 4, 5)}, date(2024, 1, 4))
    same_as_rebuilt(spark, lake)

    # later than any carried rows reach: all is computed again
    arrive(spark, lake, quotes(r, [0, 5], 12, 3000))
    assert refreshed(spark, lake)[1] == "all"
    same_as_rebuilt(spark, lake)
    assert len(refresh.carried_days(spark, lake.table("ml", "carried"))) == refresh.KEPT_STATES


def test_a_refresh_that_died_is_repeated(spark, tmp_path, monkeypatch):
    lake, r = jobs.Lake(str(tmp_path)), random.Random(4)
    arrive(spark, lake, quotes(r, [0, 1], 60))
    refreshed(spark, lake)
    arrive(spark, lake, quotes(r, [2], 30, 1000), [("A", "u1", DAY + timedelta(days=2), 0.5)])
    with monkeypatch.context() as m:
        m.setattr(refresh, "save_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        for step in (refresh.refresh_sentiment, refresh.refresh_indicators):
            with pytest.raises(RuntimeError, match="lost"):
                step(spark, lake)
    arrive(spark, lake, quotes(r, [3], 30, 2000))
    assert refreshed(spark, lake) == ({date(2024, 1, 3), date(2024, 1, 4)}, date(2024, 1, 3))
    same_as_rebuilt(spark, lake)


# --------------------------------------------------------- schema versions

def sent(spark, folder, bodies, start):
    rows = [("k", json.dumps(b) if isinstance(b, dict) else b, "stock-prices", 0, start + i, DAY) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows, topics.FILE_ENVELOPE).coalesce(1).write.mode("append").json(folder)


def test_fields_reach_readers_whenever_they_are_declared(spark, tmp_path):
    lake, folder = jobs.Lake(str(tmp_path / "lake")), str(tmp_path / "topic")
    tick = {"symbol": "A", "price": 1.0, "volume": 3, "timestamp": "2024-01-01T10:00:00"}

    def run():
        jobs.drain(jobs.ingest(lake, {"stocks": topics.replay_topic(spark, folder)}))
        jobs.drain(jobs.refine(spark, lake, only=("stock_prices_enriched",)))

    sent(spark, folder, [tick, {**tick, "lots": 7, "venue": "X", "book": {"bid": 1}}, {**tick, "lots": "many"}, "no json"], 0)
    run()
    raw = jobs.raw_table(spark, lake, "stocks")
    assert "lots" not in raw.columns
    kept = {x.offset: x[contracts.UNKNOWN] for x in raw.collect()}
    assert kept == {0: None, 1: {"lots": "7", "venue": "X", "book": '{"bid":1}'}, 2: {"lots": "many"}, 3: None}

    jobs.declare(spark, lake, "stocks", "lots BIGINT, book STRUCT<bid: INT>")
    jobs.declare(spark, lake, "stocks", "lots BIGINT")      # known already
    sent(spark, folder, [{**tick, "lots": 9, "venue": "Y"}], 4)
    run()
    for found in (jobs.raw_table(spark, lake, "stocks"), jobs.cleaned_table(spark, lake, "stock_prices_enriched")):
        got = {x.offset: (x.lots, x.book and x.book.bid, x[contracts.UNKNOWN]) for x in found.where("symbol = 'A'").collect()}
        assert got == {0: (None, None, None), 1: (7, 1, {"venue": "X"}), 2: (None, None, None), 4: (9, None, {"venue": "Y"})}


def test_versions_only_add(spark, tmp_path):
    path, start = str(tmp_path / "c"), schemas.struct("a INT")
    assert contracts.contract(spark, path, start) == start
    two = contracts.declare(spark, path, "b STRING", start)
    assert contracts.contract(spark, path, start) == two == schemas.struct("a INT, b STRING")
    for bad in ("a STRING", f"{contracts.UNKNOWN} STRING"):
        with pytest.raises(ValueError, match="cannot become"):
            contracts.declare(spark, path, bad, start)


# -------------------------------------------------------------- as of a time

@pytest.mark.parametrize("piece", [1, 7, 10_000])
def test_as_of_against_all_pairs(spark, piece):
    r = random.Random(piece)
    keys = ["A"] * 8 + ["B", "C", None]

    def moment():
        return None if r.random() < 0.05 else DAY + timedelta(seconds=r.randrange(40))
    left = [(i, r.choice(keys), moment()) for i in range(150)]
    right = [(r.choice([i, i // 2, None]), r.choice(keys[:-2] + [None]), moment(), r.choice([None, float(i)])) for i in range(60)]
    got = asof.as_of_join(spark.createDataFrame(left, "id int, s string, t timestamp"),
                          spark.createDataFrame(right, "vid int, s string, u timestamp, x double"),
                          "s", "t", "u", ["u", "vid"], "vid", piece)
    for row in got.collect():
        known = [(u, -1 if v is None else v) for v, s, u, _ in right if s is not None and s == row.s and u and row.t and u <= row.t]
        want = max(known, default=None)
        assert (row.u, -1 if row.vid is None and row.u else row.vid) == (want or (None, None)), row
    assert got.count() == 150 and got.columns == ["id", "s", "t", "u", "vid"]


def test_as_of_without_values(spark):
    some = spark.createDataFrame([(1, "A", DAY)], "id int, s string, t timestamp")
    none = spark.createDataFrame([], "vid int, s string, u timestamp")
    assert [tuple(x) for x in asof.as_of_join(some, none, "s", "t", "u", ["vid"], "vid").collect()] == [(1, "A", DAY, None)]
    assert asof.as_of_join(some.limit(0), none, "s", "t", "u", ["vid"], "vid").count() == 0


# --------------------------------------------------------- dimension history

def listing(spark, *rows):
    return spark.createDataFrame([(s, f"n{s}", sector, "X", "USD") for s, sector in rows],
                                 ", ".join(f"{c} string" for c in facts.LISTED))


def shown(history):
    return sorted((x.symbol, x.sector, x.is_current, x.valid_from.day, x.valid_to and x.valid_to.day) for x in history.collect())


def test_history_closes_and_opens(spark):
    def day(n):
        return F.lit(DAY + timedelta(days=n - 1))
    one = facts.as_dimension(listing(spark, ("A", "s1"), ("B", "s1"), ("C", None)), day(1))
    second = listing(spark, ("A", "s1"), ("B", "s2"), ("C", None), ("D", "s1"))
    two = dimension.merge_history(one, second, day(5))
    want = [("A", "s1", True, 1, None), ("B", "s1", False, 1, 5), ("B", "s2", True, 5, None), ("C", None, True, 1, None),
            ("D", "s1", True, 5, None)]
    assert shown(two) == want
    assert shown(dimension.merge_history(two, second, day(5))) == want == shown(dimension.merge_history(two, second, day(7)))
    again = dimension.merge_history(two, listing(spark, ("B", "s3"), ("D", "s1"), (None, "s9")), day(5))
    assert shown(again) == [("A", "s1", False, 1, 5), ("B", "s1", False, 1, 5), ("B", "s3", True, 5, None),
                            ("C", None, False, 1, 5), ("D", "s1", True, 5, None)]
    rows = spark.createDataFrame([("B", DAY), ("B", DAY + timedelta(days=4)), ("E", DAY), (None, DAY)], "symbol string, t timestamp")
    got = dimension.by_validity(rows, two, "t", ["sector"])
    assert as_dicts(got, "symbol", "t") == [
        {"symbol": None, "t": DAY, "dim_sector": None}, {"symbol": "B", "t": DAY, "dim_sector": "s1"},
        {"symbol": "B", "t": DAY + timedelta(days=4), "dim_sector": "s2"}, {"symbol": "E", "t": DAY, "dim_sector": None}]


# --------------------------------------------------------- repeated articles

def test_articles_polled_again_count_once(spark, tmp_path):
    out, landing = str(tmp_path / "out"), str(tmp_path / "in")
    kind = "symbol string, url string, timestamp_parsed timestamp"

    def poll(*rows):
        df = spark.createDataFrame([(s, u, DAY + timedelta(hours=h)) for s, u, h in rows], kind).coalesce(1)
        df.write.mode("append").parquet(landing)
        live = spark.readStream.schema(df.schema).parquet(landing)
        jobs.drain([sink.append_stream(jobs.first_reports(live, lateness="1 day"), out, f"{out}-checkpoint", None)])
        return sorted((x.symbol, x.url, x.timestamp_parsed) for x in batch_table(spark, out).collect())

    first = poll(
        ("A", "u", 0), ("A", "u", 0), ("B", "u", 0))
    assert [x[:2] for x in first] == [("A", "u"), ("B", "u")]
    assert len(poll(("A", "u", 5), ("A", "v", 60))) == 3            # the copy comes again after a restart
    assert len(poll(("A", "u", 0), ("C", "w", 61))) == 4            # a late copy: its entry is gone, the watermark drops it
    assert len(poll(("A", "u", 70))) == 5                           # the same address much later is news again


# ------------------------------------------------------------ hourly moments

def test_moments_of_changed_days_give_the_direct_metrics(spark, tmp_path):
    lake, r = jobs.Lake(str(tmp_path)), random.Random(5)
    kind = refresh.candle_schema(spark, lake)

    def build(days, n):
        rows = [(r.choice("AAAB"), DAY + timedelta(days=r.choice(days), minutes=r.randrange(1440)), float(r.randrange(10 ** 8, 10 ** 8 + 9)))
                for _ in range(n)]
        df = spark.createDataFrame(rows, "symbol string, window_start timestamp, close double").withColumns({
            "open": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") - 1, "volume": F.lit(3).cast("bigint"),
            "sector": F.lit("s"), "exchange": F.lit("e"), "candle_date": F.to_date("window_start")})
        df = df.dropDuplicates(["symbol", "window_start"]).select([F.col(f.name).cast(f.dataType) for f in kind if f.name in df.columns])
        df.write.mode("append").parquet(lake.table("landing", "bars"))
        live = spark.readStream.schema(df.schema).parquet(lake.table("landing", "bars"))
        jobs.drain([sink.append_stream(live, f"{lake.root}/{refresh.CANDLES}", lake.checkpoint("gold", "bars"), None,
                                       partition_by=["candle_date"])])
        return refresh.refresh_moments(spark, lake)

    assert build([0, 1], 400) == {date(2024, 1, 1), date(2024, 1, 2)}
    old = files(tmp_path, "gold/candle_moments")
    assert build([2], 300) == {date(2024, 1, 3)} and refresh.refresh_moments(spark, lake) == frozenset()
    assert old.items() <= files(tmp_path, "gold/candle_moments").items()
    bars = marts.stg_ohlc_candles(batch_table(spark, f"{lake.root}/{refresh.CANDLES}"))
    mood = marts.stg_sentiment(spark.createDataFrame([], "symbol string, timestamp_parsed timestamp, price double, "
        "price_change_pct double, news_sentiment double, news_count bigint, positive_news_count bigint, negative_news_count bigint"))
    for at in (DAY + timedelta(days=2, hours=15, minutes=25), DAY + timedelta(days=2, hours=12)):
        got = marts.stock_metrics_from_moments(refresh.moments_table(spark, lake), bars, mood, F.lit(at))
        want = marts.stock_metrics(bars, mood, F.lit(at))
        for a, b in zip(as_dicts(got, "symbol"), as_dicts(want, "symbol"), strict=True):
            assert a == {k: pytest.approx(v, rel=1e-7) if isinstance(v, float) else v for k, v in b.items()}
