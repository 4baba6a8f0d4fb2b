"""Keyed message streams and their decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickforge import schemas
from tickforge.sources import contracts

#: Broker envelope as JSON lines: the same columns with text instead of bytes.
FILE_ENVELOPE = schemas.ENVELOPE_DDL.replace("BINARY", "STRING")


def read_topic(spark: SparkSession, topic: str, bootstrap: str, starting: str = "latest", **options: str) -> DataFrame:
    """A broker topic as an unbounded frame (needs the Kafka connector on the class path)."""
    reader = spark.readStream.format("kafka").options(**{
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **options,
    })
    return reader.load()


def replay_topic(spark: SparkSession, path: str, topic: str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON envelopes as an unbounded frame: the broker-free equivalent."""
    reader = spark.readStream.schema(FILE_ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.json(path)
    return raw if topic is None else raw.filter(F.col("topic") == topic)


def decode(raw: DataFrame, contract: str | StructType, keep_unknown: bool = False) -> DataFrame:
    """Message payload as typed columns plus where the message came from.

    Missing or mistyped fields are NULL, and a payload that is not JSON becomes a row of NULLs, which the tick filter
    drops.  Unknown fields are ignored, or with ``keep_unknown`` kept as text in a map column.
    """
    known = schemas.struct(contract) if isinstance(contract, str) else contract
    value = F.col("value").cast("string")
    unknown = [contracts.unknown_fields(value, known).alias(contracts.UNKNOWN)] if keep_unknown else []
    return raw.select(
        F.from_json(value, known).alias("_payload"), *unknown,
        F.col("key").cast("string").alias("kafka_key"),
        "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("_payload.*", *[contracts.UNKNOWN for _ in unknown], "kafka_key", "partition", "offset", "kafka_timestamp")
