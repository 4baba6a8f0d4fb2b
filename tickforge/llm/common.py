"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickforge.session import stage

#: Rows sent to Python at once.  Texts may be long, so batches are short.
BATCH_ROWS = 512

#: Rows of one cell of a salted running total.
CELL_ROWS = 200_000


_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: UTF-8 in which ASCII capitals are small and all but digits, letters and bytes beyond ASCII are blanks.
NORMAL = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())


def word_list(text: str | None) -> list[bytes]:
    """Words of digits, ASCII letters (lower-cased) and characters beyond ASCII, as UTF-8."""
    return [] if text is None else text.encode().translate(NORMAL).split()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of a session that runs these operators."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")     # stored steps are read once or twice
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def id_remainder(c: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.encode(c.cast("string"), "UTF-8")) % modulus


def cells(n_rows: int, rows: int = CELL_ROWS) -> int:
    """How many cells a group of ``n_rows`` is dealt over."""
    return max(1, -(-n_rows // rows))


def running(df: DataFrame, by: list[str], order: list[str], amount: Column, n_cells: int, name: str) -> DataFrame:
    """Exact sum of ``amount`` over the rows before each row of its group, as column ``name``.

    A group is dealt over ``n_cells`` cells by the hash of its ordering columns; rows are summed within a
    cell, cells within a group.  So no task holds a whole group, and the order is by (cell, ordering columns).
    Rows alike in all ordering columns take any order among themselves.
    """
    df = df.withColumns({"_cell": F.pmod(F.xxhash64(F.lit(17), *order), F.lit(n_cells)), "_amount": amount})
    per_cell = df.groupBy(*by, "_cell").agg(F.sum("_amount").alias("_sum"))
    before = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_cell.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_cell").alias("_kc"),
                              F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    match = F.col("_cell") == F.col("_kc")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    within = W.partitionBy(*by, "_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.withColumn("_before", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
            .join(offsets, match)
            .withColumn(name, F.col("_before") + F.col("_offset"))
            .drop("_cell", "_amount", "_before", "_offset", "_kc", *[f"_k{i}" for i in range(len(by))]))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an undirected graph: component is its smallest reachable node.

    Alternating star contraction: every round hangs the larger neighbours, then the smaller ones, below the
    smallest.  All steps are joins and minima, rounds grow with the logarithm of the longest path, and each
    round is a table in the shared folder.
    """
    pairs = (edges.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    pairs, mark = stage(pairs, "edges"), None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                pairs.select("lo", "lo")).distinct()
        mark = now
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stage(large, "edges")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", "m")).distinct())
        pairs = stage(small, "edges")
