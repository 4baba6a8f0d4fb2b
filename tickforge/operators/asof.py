"""As-of join: every row takes the last values known at its time.

Both sides are put in one order of (key, time), values ahead of the rows of the same time, and cut into pieces of equal
row count (:mod:`tickforge.operators.ordered`).  Within a piece the last value is carried forward by a window; what a
piece ends with is one row per key, carried from piece to piece.  No key is held by one task, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickforge.operators.ordered import PIECE_ROWS, _POSITION, positioned

_SIDE, _ID, _KNOWN, _ROW, _PIECE, _TIME = "_side", "_id", "_known", "_row", "_piece", "_time"


def as_of_join(rows: DataFrame, values: DataFrame, key: str, ts: str, value_ts: str, columns: list[str],
               value_id: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``rows`` with ``columns`` of the newest row of ``values`` of the same ``key`` at or before ``ts``.

    Of values of one time the one with the largest ``value_id`` counts.  The columns are null where no value is known
    yet, where key or time of the row is null; values with a null key or time are never found.  Every row stays.
    """
    late = values.where(F.col(key).isNotNull() & F.col(value_ts).isNotNull()).select(
        F.col(key), F.col(value_ts).cast("timestamp").alias(_TIME), F.lit(0).alias(_SIDE),
        F.col(value_id).cast("bigint").alias(_ID), F.struct(*columns).alias(_KNOWN))
    early = rows.select(
        F.col(key), F.col(ts).cast("timestamp").alias(_TIME), F.lit(1).alias(_SIDE), F.lit(None).cast("bigint").alias(_ID),
        F.lit(None).cast(late.schema[_KNOWN].dataType).alias(_KNOWN), F.struct(*rows.columns).alias(_ROW))
    both = early.unionByName(late, allowMissingColumns=True)
    pieces = positioned(both, key, _TIME, [_SIDE, _ID]).withColumn(_PIECE, F.expr(f"{_POSITION} div {piece_rows}"))
    within = Window.partitionBy(_PIECE, key).orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, 0)
    filled = pieces.withColumn("_here", F.last(_KNOWN, ignorenulls=True).over(within))
    ends = pieces.where(F.col(_SIDE) == 0).groupBy(F.col(_PIECE).alias("_p"), F.col(key).alias("_k")).agg(
        F.max_by(_KNOWN, _POSITION).alias("_end"))
    # per key one row for every piece in which it has values; a piece takes the last of those ahead
    starts = pieces.groupBy(F.col(_PIECE).alias("_p"), F.col(key).alias("_k")).agg(F.count("*").alias("_n")).join(
        ends, ["_p", "_k"], "left")
    ahead = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.withColumn("_before", F.last("_end", ignorenulls=True).over(ahead)).where(
        F.col("_before").isNotNull()).select("_p", "_k", "_before")
    found = filled.where(F.col(_SIDE) == 1).join(
        carried, (F.col(_PIECE) == F.col("_p")) & (F.col(key) == F.col("_k")), "left")
    known = F.when(F.col(_TIME).isNotNull() & F.col(key).isNotNull(), F.coalesce("_here", "_before"))
    return found.select(f"{_ROW}.*", known.alias(_KNOWN)).select(
        *rows.columns, *[F.col(f"{_KNOWN}.{c}").alias(c) for c in columns])
