"""Writes: streaming appends, snapshots, published tables, keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickforge import settings
from tickforge.sources.lake import versions


#: Of parquet files, whose bytes are mostly text and ticks.
COMPRESSION = "zstd"
#: Messages in a file of a topic.  Compressed text is read by one task a file, so files stay small.
MESSAGES_PER_FILE = 100_000


def layout(fmt: str) -> dict[str, str]:
    """Options of a table's files."""
    return {"compression": COMPRESSION} if fmt == "parquet" else {}


def stamped(df: DataFrame, column: str) -> DataFrame:
    """Audit time, added on write so that operators stay deterministic."""
    return df.withColumn(column, F.current_timestamp())


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str | None, fmt: str = "parquet",
                  every: str | None = None, evolve: bool = True, stamp: str | None = None,
                  partition_by: list[str] | None = None) -> StreamingQuery:
    """Start an append query.

    ``every`` is the micro-batch interval; without it the query takes what is available
    and stops.  A restarted query resumes from its checkpoint, and the sink's commit log
    keeps a repeated batch from appearing twice.
    """
    out = stamped(df, stamp) if stamp else df
    writer = out.writeStream.format(fmt).options(**layout(fmt)).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if evolve and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 3,
              partition_by: list[str] | None = None) -> None:
    """Replace a whole table without readers seeing it half-written.

    Plain files have no atomic overwrite, so each write is a new ``v=<n>`` folder that
    counts from the moment its success marker exists.  A writer claims its number by
    making the folder's claim file, which only one can; the ``keep`` newest complete
    snapshots stay, so a reader has that many refreshes to finish.
    """
    spark = df.sparkSession
    writer = df.write.format(fmt).options(**layout(fmt)).mode("overwrite")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    if fmt == "delta":
        writer.save(path)
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = versions(spark, path)
    n = (found[-1] if found else 0) + 1
    while not fs.createNewFile(hadoop.Path(f"{path}/_claims/{n}")):
        n += 1
    writer.save(f"{path}/v={n}")
    for old in versions(spark, path)[:-keep]:
        fs.delete(hadoop.Path(f"{path}/v={old}"), True)


def by_day(df: DataFrame, day: str) -> DataFrame:
    """Rows dealt by day before they are written, else every task has a file in every day; adaptive execution joins
    small days in a task and splits a large one."""
    return df.hint("rebalance", day)


def replace_days(df: DataFrame, path: str, day: str, fmt: str = "parquet", days: list | None = None) -> None:
    """Replace the days that ``df`` holds, leaving the files of all others as they are.

    Plain files: each day's folder is exchanged when all tasks are done (dynamic partition overwrite); a day without
    rows stays, so ``df`` must hold rows of every day that lost some.  Delta replaces ``days`` in one commit.
    """
    writer = by_day(df, day).write.format(fmt).options(**layout(fmt)).mode("overwrite").partitionBy(day)
    if fmt == "delta" and days is not None:
        values = " OR ".join([f"{day} IS NULL" if d is None else f"{day} = DATE'{d}'" for d in days]) or "false"
        writer.option("replaceWhere", values).save(path)
    else:
        writer.option("partitionOverwriteMode", "dynamic").save(path)


def publish(df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace a catalog table, keeping the layout that look-backs prune."""
    writer = df.write.format(fmt).options(**layout(fmt)).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def epoch_to_time(df: DataFrame, column: str = "timestamp_parsed") -> DataFrame:
    """Epoch milliseconds to a timestamp; a column that already is a time stays as it is."""
    if dict(df.dtypes).get(column) in ("bigint", "int", "double"):
        return df.withColumn(column, F.timestamp_millis(F.col(column).cast("bigint")))
    return df


def messages(df: DataFrame, topic: str, key: str = "symbol", payload: list[str] | None = None,
             at: Column | None = None, offset: Column | None = None, partitions: int = 8) -> DataFrame:
    """Rows as keyed JSON messages in the broker envelope; equal keys share a partition."""
    body = F.to_json(F.struct(*(payload or df.columns)), {"ignoreNullFields": "false"})
    return df.select(
        F.col(key).cast("string").alias("key"), body.alias("value"), F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col(key).cast("string")), F.lit(partitions)).cast("int").alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("bigint").alias("offset"),
        (at if at is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
    )


def publish_messages(msgs: DataFrame, fmt: str, target: str) -> None:
    """Send messages to a broker topic (``fmt='kafka'``, target = servers) or append compressed JSON files of bounded size."""
    if fmt == "kafka":
        (msgs.select("key", "value", "topic").write.format("kafka")
         .option("kafka.bootstrap.servers", target).option("kafka.acks", "all").save())
    else:
        writer = msgs.write.format(fmt).mode("append").option("maxRecordsPerFile", MESSAGES_PER_FILE)
        (writer.option("compression", "snappy") if fmt == "json" else writer).save(target)


TRIGGERS = {"bronze": settings.INGEST_TRIGGER, "silver": settings.INGEST_TRIGGER,
            "gold": settings.SERVING_TRIGGER}
