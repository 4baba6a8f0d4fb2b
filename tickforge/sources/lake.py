"""Lake tables as streams and as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType


def optional(schema: StructType) -> StructType:
    """``schema`` with every column optional, as older files may lack any of them."""
    return StructType([StructField(f.name, f.dataType) for f in schema])


def stream_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
                 **options: str) -> DataFrame:
    """A table as a stream.  File formats need a schema: given, or that of the files present.

    With a schema the table may still be empty, or not exist: its folder is made, and the
    stream waits for the first file.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "delta":
        if schema is not None and not exists(spark, path):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        reader = reader.schema(optional(schema or spark.read.format(fmt).load(path).schema))
    return reader.load(path)


def table_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A streamed table as of now in the columns of ``schema``, which older files need not have; no rows where nothing
    was written.  No file is opened to find out what it holds."""
    if fmt == "delta":
        return batch_table(spark, path, fmt)
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(f"{path}/_spark_metadata/*"))
    if not found:
        return spark.createDataFrame([], optional(schema))
    return spark.read.format(fmt).schema(optional(schema)).load(path)


def batch_table(spark: SparkSession, path: str, fmt: str = "parquet", merge: bool = False) -> DataFrame:
    """A table as of now; ``merge`` unites the columns of all files (additive evolution)."""
    reader = spark.read.format(fmt)
    if merge and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshots below ``path``, oldest first, on any Hadoop file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = fs.globStatus(hadoop.Path(f"{path}/v=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Newest complete snapshot written by :func:`tickforge.sinks.lake.overwrite`."""
    if fmt == "delta":
        return batch_table(spark, path, fmt)
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete snapshot below {path}")
    return spark.read.format(fmt).load(f"{path}/v={found[-1]}")


def day_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table that :func:`tickforge.sinks.lake.replace_days` writes, in its declared columns; no rows before the
    first write."""
    if fmt == "delta":
        return batch_table(spark, path, fmt)
    if not exists(spark, path):
        return spark.createDataFrame([], optional(schema))
    return spark.read.format(fmt).schema(optional(schema)).load(path)


def on_days(df: DataFrame, day: str, days) -> DataFrame:
    """Rows of these days (None: without a day), by partition filters."""
    known = sorted(d for d in days if d is not None)
    wanted = F.col(day).isin(known) if known else F.lit(False)
    return df.where(wanted | F.col(day).isNull()) if None in days else df.where(wanted)


def off_days(df: DataFrame, day: str, days) -> DataFrame:
    """Rows of all other days."""
    known = sorted(d for d in days if d is not None)
    other = F.coalesce(~F.col(day).isin(known), F.lit(True)) if known else F.lit(True)
    return df.where(other & F.col(day).isNotNull()) if None in days else df.where(other)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
