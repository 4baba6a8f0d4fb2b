"""Row windows over long, skewed sequences.

``Window.partitionBy("symbol")`` sorts all ticks of one symbol in one task, which
fails when a symbol holds a large share of all rows.  :func:`over_sequence` gives the
same result with bounded tasks, in one way for every size and every key:

1. Rows are range-partitioned and sorted by (key, time, id), and stored.  Ranges cut
   through a key, a second, even one instant, wherever the rows are; a NULL key or
   time sorts like any other.
2. A row's position in this order is its place in its partition plus the sizes of the
   partitions ahead: one number per partition.  Pieces are equal runs of positions.
3. The last ``before`` rows of a piece are lent to the next one, the first ``after``
   to the one ahead; frames reach no further.
4. The window runs per (piece, key), and the lent rows are dropped.

A task's window holds ``piece_rows + before + after`` rows at most, and no more than
``before + after`` rows per piece are lent.  Frames must be bounded by ``before`` and
``after`` rows; the result is then exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickforge.session import stage

PIECE_ROWS = 200_000

_AT, _POSITION, _PIECE, _TO = "_at", "_position", "_piece", "_to"
_PLACE_BITS = 33    # of monotonically_increasing_id: place in the partition; above, the partition


def over_sequence(
    df: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    key: str,
    ts: str,
    tiebreak: str,
    before: int,
    after: int = 0,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Apply ``compute(df, window)`` to each key's rows in (ts, tiebreak) order.

    ``df`` is evaluated twice, once to find the ranges; stage it first if it is an
    expensive plan.  Rows equal in key, time and id keep one order in all pieces.
    """
    if piece_rows < max(before, after, 1):
        raise ValueError("a piece must hold the rows that its neighbours' frames reach into")
    pieces = lent(positioned(df, key, ts, tiebreak), before, after, piece_rows)
    window = Window.partitionBy(_TO, key).orderBy(_POSITION)
    return compute(pieces, window).filter(F.col(_TO) == F.col(_PIECE)).drop(_POSITION, _PIECE, _TO)


def positioned(df: DataFrame, key: str, ts: str, tiebreak: str | list[str]) -> DataFrame:
    """``df`` (stored) with each row's position in the order of (key, ts, tiebreak)."""
    order = [key, ts, *([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    rows = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn(_AT, F.monotonically_increasing_id()), "ordered")
    part: Column = F.shiftright(_AT, _PLACE_BITS)
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, however many rows there are
    offsets = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    place = F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(_POSITION, F.col("_ahead") + place).drop("_part", "_ahead", _AT))


def lent(df: DataFrame, before: int, after: int, piece_rows: int) -> DataFrame:
    """Rows with their own piece and the piece they are handed to: their own, and a
    neighbour whose frames may reach them."""
    within = F.col(_POSITION) % piece_rows
    piece = F.expr(f"{_POSITION} div {piece_rows}")
    to = F.array_compact(F.array(
        piece,
        F.when(within >= piece_rows - before, piece + 1),
        F.when((within < after) & (piece > 0), piece - 1)))
    return df.withColumns({_PIECE: piece, _TO: F.explode(to)})
