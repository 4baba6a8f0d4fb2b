import json

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.session import shared_dir, stage
from tickforge.sinks import lake as sink
from tickforge.sources import lake, topics

from tests.helpers import at


def envelope(spark, values):
    return spark.createDataFrame([("k", v, "t", 0, i, at(i)) for i, v in enumerate(values)], topics.FILE_ENVELOPE)


def test_decode_is_permissive(spark):
    good = {"symbol": "A", "price": 1.5, "volume": 7, "extra": 1}
    values = [json.dumps(good), "not json", json.dumps({"symbol": "A", "price": "x"}),
              json.dumps({"symbol": "A", "volume": 1.5}), json.dumps({"symbol": "T", "price": 2.0, "test": True})]
    rows = topics.decode(envelope(spark, values), schemas.STOCK_DDL).orderBy("offset").collect()
    assert (rows[0].symbol, rows[0].price, rows[0].volume, rows[0].sector, rows[0].kafka_key) == ("A", 1.5, 7, None, "k")
    assert rows[1].symbol is None and rows[1].offset == 1
    assert (rows[2].symbol, rows[2].price) == ("A", None)
    assert rows[3].volume is None
    assert (rows[4].price, rows[4].volume) == (2.0, None)
    assert len(rows[0]) == 17 + 4


def test_messages_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.25, None), ("B", None, 3)], "symbol string, price double, volume bigint")
    msgs = sink.messages(df, "stock-prices", at=F.lit(at()), offset=F.lit(1))
    assert msgs.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    sink.publish_messages(msgs, "json", str(tmp_path / "t"))
    back = topics.decode(spark.read.schema(topics.FILE_ENVELOPE).json(str(tmp_path / "t")), schemas.STOCK_DDL)
    assert sorted((r.kafka_key, r.symbol, r.price, r.volume) for r in back.collect()) == [
        ("A", "A", 1.25, None), ("B", "B", None, 3)]


def test_overwrite_keeps_readers_on_a_complete_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        lake.snapshot(spark, path)
    sink.overwrite(spark.range(3), path)
    reader = lake.snapshot(spark, path)
    sink.overwrite(spark.range(5), path)
    (tmp_path / "t" / "v=3").mkdir()          # a write in progress has no success marker
    assert reader.count() == 3 and lake.snapshot(spark, path).count() == 5
    assert lake.versions(spark, path) == [1, 2]


def test_additive_columns_are_merged_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("extra", F.lit("x")).write.mode("append").parquet(path)
    merged = lake.batch_table(spark, path, merge=True)
    assert set(merged.columns) == {"id", "extra"} and merged.filter("extra is null").count() == 2


def test_publish_and_epoch(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_lake")
    sink.publish(spark.range(3), "t_lake.numbers")
    sink.publish(spark.range(2), "t_lake.numbers")
    assert spark.table("t_lake.numbers").count() == 2
    ms = spark.createDataFrame([(1704276000000,)], "timestamp_parsed bigint")
    fixed = sink.epoch_to_time(ms)
    assert fixed.first()[0] == at() and sink.epoch_to_time(fixed).schema == fixed.schema


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(4), "numbers")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark)) and staged.count() == 4


def test_topics_and_tables_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "MESSAGES_PER_FILE", 10)
    rows = spark.range(25).select(F.col("id"), F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"))
    msgs = sink.messages(rows, "ticks", offset=F.col("id")).coalesce(1)
    sink.publish_messages(msgs, "json", f"{tmp_path}/topic")
    files = [p.name for p in (tmp_path / "topic").iterdir() if p.name.startswith("part-")]
    assert len(files) == 3 and all(name.endswith(".json.snappy") for name in files)
    assert sorted(r.offset for r in spark.read.json(f"{tmp_path}/topic").collect()) == list(range(25))
    sink.overwrite(rows, f"{tmp_path}/table")
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "table" / "v=1").glob("part-*"))
    assert spark.read.parquet(f"{tmp_path}/table/v=1").count() == 25
