"""Event-time expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

MICROS = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}


def parse_time(df: DataFrame, column: str) -> Column:
    """Event time of ``column``: ISO text is parsed (bad text gives NULL), time types pass through."""
    if df.schema[column].dataType.typeName() == "string":
        return F.try_to_timestamp(F.col(column))
    return F.col(column)


def micros(ts) -> Column:
    """Microseconds since the epoch, for TIMESTAMP and (in UTC) TIMESTAMP_NTZ."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def order_key(ts, tiebreak=None) -> Column:
    """Total order over (time, tiebreak) in a fixed-width value.

    A struct key would force ``min_by/max_by`` into a sort-based aggregation; a
    decimal keeps the buffer mutable, so Spark hash-aggregates on the map side.
    ``tiebreak`` is a non-negative long, such as a broker offset or an event id; a NULL
    one comes before all others of its time.  Offsets are unique within a partition of
    a topic only: ticks of one time and offset from two partitions tie, and either may
    be chosen; keyed topics hold a symbol in one partition, so its ticks do not.
    """
    if tiebreak is None:
        return _col(ts)
    head = micros(ts).cast("decimal(18,0)") * F.lit(Decimal(10 ** 19))
    last = F.coalesce(_col(tiebreak).cast("decimal(19,0)") + 1, F.lit(0))
    return (head + last).cast("decimal(38,0)")


def since(ts, as_of: Column, hours: int) -> Column:
    """Look-back predicate, closed at ``as_of - hours``."""
    return _col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours))


def day_of_week(ts) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_col(ts))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
