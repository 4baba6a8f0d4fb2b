"""What a streaming sink has added: its commit log read as changed days.

The file sink of a stream writes one log file per micro-batch, every tenth holding all before it.  A reader keeps a
mark, the last batch it has taken and the newest file it has seen; the files of later batches name the days they hold
in their paths, so neither tables nor footers are read to find out what to refresh.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Milliseconds by which clocks of writers may differ.  Only read where single batch files are gone.
SLACK_MS = 3_600_000
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Mark:
    """How far a table's log has been taken."""

    batch: int = -1
    modified: int = -1


@dataclass(frozen=True)
class Changes:
    """Days that files were added to (None: rows without a day), and the mark behind them."""

    days: frozenset[date | None]
    mark: Mark


def log_files(spark: SparkSession, path: str) -> dict[int, tuple[str | None, str | None]]:
    """Log files below ``path`` by batch: the batch's own, and the compact one up to it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, tuple[str | None, str | None]] = {}
    for status in fs.globStatus(hadoop.Path(f"{path}/_spark_metadata/*")) or []:
        name = status.getPath().getName()
        number, _, kind = name.partition(".")
        if number.isdigit() and kind in ("", "compact"):
            own, compact = found.get(int(number), (None, None))
            full = status.getPath().toString()
            found[int(number)] = (own, full) if kind else (full, compact)
    return found


def entries(spark: SparkSession, files: list[str]) -> DataFrame:
    """path and modified of the files that the log files name; the log's version line has neither.

    Spark's file sources skip everything below a log folder, so the lines are read as text lines of Hadoop files.
    """
    lines = spark.sparkContext.textFile(",".join(files))
    found = spark.read.schema("path STRING, modificationTime BIGINT, action STRING").json(lines)
    return found.where("action = 'add'").select("path", F.col("modificationTime").alias("modified"))


def changed_days(spark: SparkSession, path: str, day: str, mark: Mark) -> Changes:
    """Days of ``path``, partitioned by ``day``, with files that were added after ``mark``.

    Batch files tell exactly.  A compact file stands for batches whose own files are gone; it is taken from the mark's
    newest file on, less :data:`SLACK_MS`, which may name a day too many but never one too few.
    """
    logs = log_files(spark, path)
    newest = max(logs, default=-1)
    if newest <= mark.batch:
        return Changes(frozenset(), mark)
    wanted = range(mark.batch + 1, newest + 1)
    # a compact batch has no file of its own: its log holds its files and all earlier ones
    compact = max((b for b in wanted if b not in logs or logs[b][0] is None), default=None)
    if compact is None:
        rows = entries(spark, [logs[b][0] for b in wanted])
    else:
        last = min(b for b, (_, whole) in logs.items() if whole and b >= compact)
        own = [logs[b][0] for b in wanted if b > last]
        rows = entries(spark, [logs[last][1]]).where(F.col("modified") >= mark.modified - SLACK_MS)
        rows = rows.union(entries(spark, own)) if own else rows
    value = F.regexp_extract("path", f"/{day}=([^/]*)/", 1)
    per_day = rows.groupBy(value.alias("day")).agg(F.max("modified").alias("modified")).collect()    # one row per day
    days = frozenset(None if r.day == NO_DAY else date.fromisoformat(r.day) for r in per_day)
    return Changes(days, Mark(newest, max([mark.modified, *(r.modified for r in per_day)])))
