"""Streaming layers: watermarks, the three stages, supervision and progress.

The transformations are the batch operators; this module only adds event-time
watermarks, checkpoints and triggers.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickforge import schemas, settings
from tickforge.operators import candles, facts, news, ticks
from tickforge.sinks.lake import TRIGGERS, append_stream
from tickforge.sources import contracts
from tickforge.sources.lake import exists, stream_table, table_or_empty
from tickforge.sources.topics import decode


@dataclass(frozen=True)
class Lake:
    """Where tables and checkpoints live, and in which format."""

    root: str
    fmt: str = "parquet"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{layer}/{name}"


def with_lateness(df: DataFrame, lateness: str, ts: str = "timestamp_parsed") -> DataFrame:
    """Declare event time.  Set it once per query: Spark rejects a second watermark.

    Rows later than the watermark are dropped by the aggregation; their number is in
    the query's progress (:func:`progress`).
    """
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def stream_candles(enriched: DataFrame, tiebreak: str | None = "offset",
                   lateness: str = settings.TICK_LATENESS) -> DataFrame:
    return candles.ohlc(with_lateness(enriched, lateness), tiebreak=tiebreak)


def stream_hourly(enriched: DataFrame, tiebreak: str | None = "offset",
                  lateness: str = settings.HOURLY_LATENESS) -> DataFrame:
    return candles.hourly_metrics(with_lateness(enriched, lateness), tiebreak=tiebreak)


def first_reports(cleaned: DataFrame, keys: tuple[str, ...] = ("symbol", "url"),
                  lateness: str = settings.REPOLL_LATENESS) -> DataFrame:
    """Cleaned news without the copies that later polls bring again.

    The state holds one entry per article for ``lateness`` of event time.  A copy that arrives after that is older than
    the watermark if its time is the article's, and dropped as late; only one polled with a newer time counts again.
    """
    return with_lateness(cleaned, lateness).dropDuplicatesWithinWatermark(list(keys))


# name of the raw table, wire contract, topic key
RAW = {
    "stocks": ("stock_prices", schemas.STOCK_DDL),
    "crypto": ("crypto_prices", schemas.CRYPTO_DDL),
    "news": ("news_sentiment", schemas.NEWS_DDL),
}


def contract_path(lake: Lake, kind: str) -> str:
    return lake.table("_contracts", kind)


def wire_contract(spark: SparkSession, lake: Lake, kind: str) -> StructType:
    """The wire contract in force: the newest that was declared for this lake."""
    return contracts.contract(spark, contract_path(lake, kind), schemas.struct(RAW[kind][1]))


def declare(spark: SparkSession, lake: Lake, kind: str, fields: str) -> StructType:
    """Declare further fields of a topic.  Queries that are started from now on write and read them."""
    return contracts.declare(spark, contract_path(lake, kind), fields, schemas.struct(RAW[kind][1]))


def raw_schema(spark: SparkSession, lake: Lake, kind: str) -> StructType:
    """Columns of a raw table: the wire contract, unknown fields and where a message came from."""
    envelope = spark.createDataFrame([], schemas.ENVELOPE_DDL)
    decoded = decode(envelope, wire_contract(spark, lake, kind), keep_unknown=True)
    return decoded.withColumn("ingested_at", F.current_timestamp()).schema


def cleaned_schemas(spark: SparkSession, lake: Lake) -> dict[str, StructType]:
    """Columns of the cleaned tables, from the raw ones through the same operators."""
    def empty(kind: str) -> DataFrame:
        return spark.createDataFrame([], raw_schema(spark, lake, kind))

    stocks = ticks.enrich(empty("stocks"))
    return {
        "stock_prices_enriched": stocks.schema,
        "stock_prices_1min_ohlc": candles.ohlc(stocks.withColumn(
            "timestamp_parsed", F.col("timestamp_parsed").cast("timestamp")), tiebreak="offset").withColumn(
            "processed_at", F.current_timestamp()).schema,
        "crypto_prices_enriched": ticks.enrich(empty("crypto")).schema,
        "news_sentiment_clean": news.clean(empty("news")).schema,
    }


#: The topic that each cleaned table's columns come from.
SOURCE_OF = {"stock_prices_enriched": "stocks", "crypto_prices_enriched": "crypto", "news_sentiment_clean": "news"}


def raw_table(spark: SparkSession, lake: Lake, kind: str) -> DataFrame:
    """A raw table as of now, every row in the contract in force."""
    found = table_or_empty(spark, lake.table("bronze", RAW[kind][0]), raw_schema(spark, lake, kind), lake.fmt)
    return contracts.promoted(found, wire_contract(spark, lake, kind))


def cleaned_table(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A cleaned table as of now, every row in the contract in force."""
    found = table_or_empty(spark, lake.table("silver", table), cleaned_schemas(spark, lake)[table], lake.fmt)
    return contracts.promoted(found, wire_contract(spark, lake, SOURCE_OF[table]))


def trade_schema(spark: SparkSession, lake: Lake) -> StructType:
    stocks = spark.createDataFrame([], cleaned_schemas(spark, lake)["stock_prices_enriched"])
    return facts.fact_trades(stocks, keep=("offset",)).withColumn("loaded_at", F.current_timestamp()).schema


def _append(lake: Lake, df: DataFrame, layer: str, table: str, stamp: str | None, continuous: bool,
            **kwargs) -> StreamingQuery:
    return append_stream(
        df, lake.table(layer, table), lake.checkpoint(layer, table), name=f"{layer}.{table}",
        fmt=lake.fmt, every=TRIGGERS[layer] if continuous else None, stamp=stamp, **kwargs,
    )


def ingest(lake: Lake, topics: dict[str, DataFrame], continuous: bool = False) -> list[StreamingQuery]:
    """Topics to raw tables, one query each, by the contract in force when they start."""
    return [
        _append(lake, decode(raw, wire_contract(raw.sparkSession, lake, kind), keep_unknown=True), "bronze", RAW[kind][0],
                "ingested_at", continuous)
        for kind, raw in topics.items()
    ]


def refine(spark: SparkSession, lake: Lake, continuous: bool = False,
           only: tuple[str, ...] | None = None) -> list[StreamingQuery]:
    """Raw tables to enriched ticks, minute candles and cleaned news, or to those of these tables that ``only`` names."""
    def raw(kind: str) -> DataFrame:
        streamed = stream_table(spark, lake.table("bronze", RAW[kind][0]), lake.fmt, raw_schema(spark, lake, kind))
        return contracts.promoted(streamed, wire_contract(spark, lake, kind))

    by_day = {"partition_by": ["date_parsed"]}
    started = {
        "stock_prices_enriched": lambda: (ticks.enrich(raw("stocks")), None, by_day),
        "stock_prices_1min_ohlc": lambda: (stream_candles(ticks.enrich(raw("stocks"))), "processed_at", {}),
        "crypto_prices_enriched": lambda: (ticks.enrich(raw("crypto")), None, {}),
        "news_sentiment_clean": lambda: (news.clean(raw("news")), None, by_day),
    }
    queries = []
    for table in only or started:
        df, stamp, layout = started[table]()
        queries.append(_append(lake, df, "silver", table, stamp, continuous, **layout))
    return queries


def serve(spark: SparkSession, lake: Lake, continuous: bool = False,
          only: tuple[str, ...] | None = None) -> list[StreamingQuery]:
    """Cleaned tables to trade facts, candle facts and hourly metrics (or those that ``only`` names), each by day, so
    that look-backs prune."""
    declared = cleaned_schemas(spark, lake)

    def cleaned(table: str) -> DataFrame:
        return stream_table(spark, lake.table("silver", table), lake.fmt, declared[table])

    def trades():
        return facts.fact_trades(cleaned("stock_prices_enriched"), keep=("offset",)), "loaded_at", "trade_date"

    def bars():
        built = candles.fact_candles(cleaned("stock_prices_1min_ohlc").drop("processed_at"))
        return built.withColumn("candle_date", F.to_date("window_start")), "loaded_at", "candle_date"

    def hours():
        built = stream_hourly(cleaned("stock_prices_enriched"))
        return built.withColumn("hour_date", F.to_date("hour_start")), None, "hour_date"

    started = {"fact_stock_trades": trades, "fact_ohlc_candles": bars, "hourly_metrics": hours}
    queries = []
    for table in only or started:
        df, stamp, day = started[table]()
        queries.append(_append(lake, df, "gold", table, stamp, continuous, evolve=False, partition_by=[day]))
    return queries


def drain(queries: list[StreamingQuery]) -> list[StreamingQuery]:
    """Wait for queries that stop by themselves; a failed one raises."""
    for query in queries:
        query.awaitTermination()
    return queries


def supervise(queries: list[StreamingQuery], refresh: Callable[[], None] | None = None,
              every_seconds: float = 120.0, poll_seconds: float = 5.0) -> None:
    """Run continuous queries until one ends, calling ``refresh`` on its interval.

    An interrupt stops all queries; a failure is raised after the others are stopped.
    """
    due = time.monotonic() + every_seconds
    try:
        while all(q.isActive for q in queries):
            time.sleep(poll_seconds)
            if refresh and time.monotonic() >= due:
                refresh()
                due = time.monotonic() + every_seconds
        for query in queries:
            if query.exception():
                raise query.exception()
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            query.stop()


PROGRESS = "query string, batch_id bigint, input_rows bigint, rows_per_second double, late_rows bigint"


def record_progress(spark: SparkSession, lake: Lake, queries: list[StreamingQuery]) -> None:
    """Append the micro-batches that are not recorded yet, beyond the history that Spark keeps.

    A query's name and batch number identify a batch.  The newest recorded one is written again, as a restarted query
    may repeat it; so recording twice, or after a restart, counts nothing twice.  Call it more often than Spark's history
    (100 batches) fills; queries need names.
    """
    path, seen = lake.table("_progress", "batches"), {}
    if exists(spark, path):
        last = spark.read.schema(f"{PROGRESS}, recorded_at timestamp").parquet(path).groupBy("query").agg(F.max("batch_id"))
        seen = {name: batch for name, batch in last.collect()}      # one row per query
    found = progress(spark, queries)
    names = F.create_map(*[F.lit(x) for pair in seen.items() for x in pair]) if seen else None
    fresh = found if names is None else found.where(F.col("batch_id") >= F.coalesce(names[F.col("query")], F.lit(0)))
    fresh.where("query is not null").withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def recorded_progress(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every recorded micro-batch once, as it was recorded last."""
    path = lake.table("_progress", "batches")
    schema = f"{PROGRESS}, recorded_at timestamp"
    found = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return found.groupBy("query", "batch_id").agg(F.max_by(
        F.struct("input_rows", "rows_per_second", "late_rows"), "recorded_at").alias("_last")).select("query", "batch_id", "_last.*")


def progress(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """Recent micro-batches: rows, rate, late rows dropped (Spark keeps a bounded history)."""
    rows = [
        (p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond,
         sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        for query in queries for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS)
