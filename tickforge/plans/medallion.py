"""The whole chain: topics -> raw -> cleaned -> star schema -> marts and features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickforge.operators import dimension, facts
from tickforge.plans import refresh, warehouse
from tickforge.sinks.lake import overwrite
from tickforge.sources.lake import exists, snapshot
from tickforge.streaming.jobs import Lake, drain, ingest, refine, serve


def refresh_dimension(spark: SparkSession, lake: Lake, at: datetime,
                      rows: list[tuple[str, ...]] | None = None) -> None:
    """Merge the configured listing into the dimension's history; what changed is valid from ``at``."""
    path = lake.table("gold", "dim_stocks")
    listed = facts.dim_stocks(spark, at, rows)
    if exists(spark, path):
        listed = dimension.merge_history(snapshot(spark, path, lake.fmt), listed, F.lit(at))
    overwrite(listed, path, lake.fmt)


def refresh_features(spark: SparkSession, lake: Lake) -> None:
    """Bring the indicators, of which the feature table is made, up to date."""
    refresh.refresh_indicators(spark, lake)


def refresh_sentiment(spark: SparkSession, lake: Lake) -> None:
    refresh.refresh_sentiment(spark, lake)


def run(spark: SparkSession, lake: Lake, topics: dict[str, DataFrame], valid_from: datetime,
        database: str | None = None, as_of: Column | None = None) -> DataFrame | None:
    """Bring every layer up to date with what the topics hold, then load the warehouse.

    Each stage takes what is available and ends, so the next one can start; running the
    chain again continues from the checkpoints.  The marts look back from ``as_of``, by
    default the newest trade, so a replay of past ticks gives their marts.  Returns the
    report of the warehouse's data tests.
    """
    drain(ingest(lake, topics))
    drain(refine(spark, lake))
    drain(serve(spark, lake))
    refresh_dimension(spark, lake, valid_from)
    refresh_sentiment(spark, lake)
    refresh_features(spark, lake)
    if database:
        warehouse.load(spark, lake, database)
        if as_of is None:
            newest = spark.table(f"{database}.raw_stock_trades").agg(F.max("timestamp_parsed")).first()[0]
            as_of = F.lit(newest or datetime.now())
        return warehouse.build(spark, database, as_of)
    return None
