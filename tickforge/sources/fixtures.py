"""The supplied tables read as market data: pure projections, batch or stream.

events -> quotes and ticks, documents -> articles, customer/nation/region -> dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickforge.operators import facts, news, ticks

#: Frequent words of the supplied texts, for a lexicon that hits most documents.
COMMON_POSITIVE = ["the", "and", "that", "with", "for"]
COMMON_NEGATIVE = ["der", "was", "die", "und", "des"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, with event time in a type that takes a watermark."""
    schema = table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def quotes(events: DataFrame) -> DataFrame:
    """Raw quotes: unrounded levels, some prices and previous closes missing or zero."""
    eid, k, listing, price = F.col("event_id"), F.col("_k"), F.col("_listing"), F.col("price")
    symbol = F.concat(F.lit("S"), F.col("user_id").cast("string"))
    # values used more than once are computed in a projection of their own
    parsed = events.withColumns({
        "_k": F.get_json_object("props", "$.k").cast("bigint"),
        "_listing": F.col("user_id") % 3,
        "price": F.when(eid % 97 != 0, F.when(eid % 89 == 0, F.lit(0.0)).otherwise(F.col("value") + 2000)),
    })
    return parsed.select(
        "event_id", "event_type", symbol.alias("symbol"), symbol.alias("name"),
        F.concat(F.lit("sector"), (F.col("user_id") % 5).cast("string")).alias("sector"),
        F.when(listing == 0, "NSE").when(listing == 1, "NYSE").otherwise("Crypto").alias("exchange"),
        F.when(listing == 0, "INR").otherwise("USD").alias("currency"),
        price, (F.lit(2000.0) + k / 2).alias("open"),
        (price + 1.25).alias("day_high"), (price - 1.25).alias("day_low"),
        F.when(eid % 61 != 0, F.when(eid % 67 == 0, F.lit(0.0)).otherwise(k + F.lit(2000.07))).alias("prev_close"),
        (k * 20000).alias("volume"), F.col("ts").alias("timestamp"),
    )


def stock_ticks(events: DataFrame) -> DataFrame:
    return ticks.build_stock_ticks(quotes(events))


def crypto_ticks(events: DataFrame) -> DataFrame:
    levels = {c: F.col(c) * 1.03125 for c in ("price", "day_high", "day_low", "prev_close")}
    return ticks.build_crypto_ticks(quotes(events).withColumns(levels).withColumn(
        "market_cap", F.col("volume") * 1000).drop("open"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks.enrich(stock_ticks(table(spark, sf_dir, "events")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; the whole text is the description, some titles are missing."""
    did = F.col("doc_id")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        (did % 30).cast("int"), (did % 24).cast("int"))
    return table(spark, sf_dir, "documents").select(
        did, F.concat(F.lit("S"), (did % 150).cast("string")).alias("symbol"),
        F.when(did % 13 != 0, F.concat_ws(" ", F.lit("Report"), F.col("source"))).alias("headline"),
        F.col("text").alias("description"), F.col("source"),
        F.concat(F.lit("doc/"), F.lpad(did.cast("string"), 12, "0")).alias("url"),
        at.alias("published_at"), at.alias("timestamp"),
    )


def clean_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = news.score(articles(spark, sf_dir), COMMON_POSITIVE, COMMON_NEGATIVE)
    return news.clean(scored)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as instruments, valid from the first day of the ticks."""
    listed = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("symbol"),
            F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("exchange"), F.col("r_name").alias("currency"),
        )
    )
    return facts.as_dimension(listed, F.lit("2024-01-01").cast("timestamp_ntz"))


def as_of(events: DataFrame):
    """Newest event time, in place of the wall clock (one value, from file statistics or one scan)."""
    return F.lit(events.agg(F.max("ts")).first()[0]).cast(dict(events.dtypes)["ts"])
