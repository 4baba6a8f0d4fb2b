"""Dimension history: rows with validity intervals, merged load by load, and facts joined by validity."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.operators.facts import LISTED, as_dimension

KEY, ATTRIBUTES = LISTED[0], LISTED[1:]


def merge_history(history: DataFrame, listed: DataFrame, at: Column) -> DataFrame:
    """History after a load: ``listed`` is the whole listing as of ``at``.

    A current row whose attributes changed, or whose key is no longer listed, is closed at ``at``; new and changed keys
    open a current row there.  Unchanged and closed rows stay as they are, so a repeated load changes nothing.  A load at
    the time a row was opened replaces that row instead of leaving an empty interval.  Loads come in order of time; keys
    are unique in ``listed``, and rows without a key take no part.
    """
    at = at.cast("timestamp")
    fresh = listed.where(F.col(KEY).isNotNull()).select(
        F.col(KEY).alias("_key"), F.struct(*ATTRIBUTES).alias("_now"))
    current, closed = history.where("is_current"), history.where(~F.col("is_current"))
    met = current.join(fresh, F.col(KEY) == F.col("_key"), "full")
    same = F.col("_key").isNotNull() & reduce(and_, [F.col(c).eqNullSafe(F.col(f"_now.{c}")) for c in ATTRIBUTES])
    known = F.col(KEY).isNotNull()
    stays = met.where(known & same).select(*history.columns)
    ended = met.where(known & ~same & (F.col("valid_from") < at)).withColumns(
        {"is_current": F.lit(False), "valid_to": at}).select(*history.columns)
    opened = as_dimension(met.where(F.col("_key").isNotNull() & ~(known & same)).select(
        F.col("_key").alias(KEY), "_now.*"), at)
    return closed.select(*history.columns).unionByName(stays).unionByName(ended).unionByName(opened.select(*history.columns))


def by_validity(rows: DataFrame, history: DataFrame, ts: str, columns: list[str] | None = None,
                prefix: str = "dim_") -> DataFrame:
    """``rows`` with the attributes that were valid at their time, null where none was.

    Intervals of a key do not overlap, so every row keeps its number.  Equality on the key carries the join; pass
    ``history`` stored, so that its size is known: below the threshold Spark broadcasts it, beyond it adaptive
    execution may split a hot key on the side of ``rows``.
    """
    wanted = columns or ATTRIBUTES
    valid = history.select(F.col(KEY).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
                           *[F.col(c).alias(f"{prefix}{c}") for c in wanted])
    time = F.col(ts).cast("timestamp")
    inside = (F.col("_from") <= time) & (F.col("_to").isNull() | (time < F.col("_to")))
    return rows.join(valid, (F.col(KEY) == F.col("_key")) & inside, "left").drop("_key", "_from", "_to")
