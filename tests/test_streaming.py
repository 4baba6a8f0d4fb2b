import json

from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import candles, ticks
from tickforge.sinks.lake import append_stream
from tickforge.sources import topics
from tickforge.sources.lake import batch_table
from tickforge.streaming import jobs

from tests.helpers import at


def drop_file(folder, name, seconds, first_offset, price=10.0):
    """One topic file: a tick per entry of ``seconds`` since the start."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = []
    for i, s in enumerate(seconds):
        value = {"symbol": "A", "sector": "Tech", "exchange": "NYSE", "currency": "USD", "price": price + i, "volume": 1,
                 "price_change": 0.0, "price_change_pct": 0.0, "timestamp": at(s).isoformat()}
        lines.append(json.dumps({"key": "A", "value": json.dumps(value), "topic": "stock-prices", "partition": 0,
                                 "offset": first_offset + i, "timestamp": at(s).isoformat()}))
    (folder / name).write_text("\n".join(lines))


def run_candles(spark, tmp_path, files_per_trigger=1):
    raw = topics.replay_topic(spark, str(tmp_path / "in"), "stock-prices", files_per_trigger)
    live = jobs.stream_candles(ticks.enrich(topics.decode(raw, schemas.STOCK_DDL)))
    return jobs.drain([append_stream(live, str(tmp_path / "out"), str(tmp_path / "ck"), "candles")])


def stored(spark, tmp_path):
    return [tuple(r) for r in batch_table(spark, str(tmp_path / "out")).orderBy("window_start").collect()]


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [0, 30, 61, 200], 0)
    drop_file(tmp_path / "in", "2.json", [201, 260, 400, 900], 10)
    run_candles(spark, tmp_path)
    raw = spark.read.schema(topics.FILE_ENVELOPE).json(str(tmp_path / "in"))
    batch = candles.ohlc(ticks.enrich(topics.decode(raw, schemas.STOCK_DDL)), tiebreak="offset")
    closed = batch.filter(F.col("window_end") <= F.lit(at(900 - 120))).orderBy("window_start")
    assert stored(spark, tmp_path) == [tuple(r) for r in closed.collect()]
    assert batch.count() == closed.count() + 1


def test_late_ticks_within_and_beyond_the_watermark(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [0, 600], 0)               # watermark 480 s
    run_candles(spark, tmp_path)                                    # emits the first window
    drop_file(tmp_path / "in", "2.json", [1, 490, 700], 10)         # 1 s too late, 490 s accepted
    queries = run_candles(spark, tmp_path)
    got = {r[4]: r for r in stored(spark, tmp_path)}
    assert got[at(0)][12] == 1                                      # tick_count unchanged by the late tick
    assert at(480) in got
    assert jobs.progress(spark, queries).agg(F.sum("late_rows")).first()[0] == 1


def test_restart_continues_without_duplicates(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [0, 30, 300], 0)
    run_candles(spark, tmp_path)
    first = stored(spark, tmp_path)
    run_candles(spark, tmp_path)                                    # nothing new
    assert stored(spark, tmp_path) == first and len(first) == 1
    drop_file(tmp_path / "in", "2.json", [301, 900], 10)
    run_candles(spark, tmp_path)
    after = stored(spark, tmp_path)
    assert after[0] == first[0] and [r[12] for r in after] == [2, 2]   # the open window kept its state


def test_supervise_refreshes_and_ends_with_its_queries(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [0], 0)
    raw = topics.decode(topics.replay_topic(spark, str(tmp_path / "in")), schemas.STOCK_DDL)
    query = append_stream(raw, str(tmp_path / "out"), str(tmp_path / "ck"), "raw", every="1 second")
    calls = []

    def refresh():
        calls.append(batch_table(spark, str(tmp_path / "out")).count() if query.recentProgress else 0)
        if len(calls) >= 2 and calls[-1]:
            query.stop()

    jobs.supervise([query], refresh, every_seconds=1.0, poll_seconds=0.5)
    assert calls[-1] == 1 and not query.isActive
