"""Mixing sources to target weights, in DataFrame operations only.

Each source's documents, laid end to end in pseudorandom order, are cut into blocks of a fixed number of words.  A
source's target is its weight's share of all words, at most ``MOST`` times its own words; what exceeds that is shared
among the others by weight.  The target fixes how many slots of the mix the source fills; every slot falls to an output
shard by hash, so a shard's counts by source are a multinomial draw given the shard's size and the sources' totals.  The
k-th slot of a source takes block ``permutation(k mod blocks)``, with another permutation for every pass over the
source, and blocks join slots by (source, index): ``mixed`` returns the mix, shard by shard, as word ranges of documents,
``mix`` what it takes of every document.  Everything follows from a seed: reruns agree.

Offsets are running sums over cells, so a source with a third of all rows is split; weights and targets need one row per
source and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickforge.llm.common import cells, quoted, running
from tickforge.session import stage

BLOCK = 128                 # words
SHARD = 100_000             # slots of an output shard, about
MOST = 3                    # times its own size a source may be taken
SEED = 9
#: Primes above any number of blocks: modulo that number they are coprime to it.
PRIMES = [1_000_000_000_000_000_003, 1_000_000_000_000_000_009, 2_305_843_009_213_693_951]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """source, source_size, target, n_blocks, n_slots, first (slot): one row per source.

    ``sizes``: source, size.  Sources by code point, null last, weigh 1, 2, 3, 1, ...  The level at which the shares
    settle is found in order of the ratio of limit to weight: a source is at its limit if its share of what is left
    there would exceed it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything, ordered = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = per.withColumns({
        "weight": ((F.row_number().over(ordered) - 1) % 3 + 1).cast("double"),
        "total": F.sum("source_size").over(everything).cast("double"),
        "limit": (MOST * F.col("source_size")).cast("double")})
    by_ratio = W.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - before) / rest)
    full = F.col("limit") <= F.col("level") * F.col("weight")
    # the first source below its limit has the level of all that are
    settled = F.min(F.when(~full, F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)["level"]
    per = per.withColumn("target", F.when(full, F.col("limit")).otherwise(F.col("weight") * settled))
    per = per.withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("bigint"))
    # a slot takes source_size / n_blocks words on average: the last block may be short
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")))
    per = per.withColumn("n_slots", F.coalesce(slots, F.lit(0)).cast("bigint"))
    first = F.coalesce(F.sum("n_slots").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return per.select("source", "source_size", "target", "n_blocks", "n_slots", first.alias("first"))


def permuted(index: Column, n: Column, turn: Column, *seed: Column) -> Column:
    """A permutation of 0 .. n-1, one for each turn and seed: multiply by a number coprime to n, add, reduce."""
    prime = F.element_at(F.array(*[F.lit(p) for p in PRIMES]), (F.pmod(turn, F.lit(len(PRIMES))) + 1).cast("int"))
    step = F.pmod(prime, n).cast("decimal(18,0)")
    shift = F.pmod(F.xxhash64(F.lit(SEED), turn, *seed), n).cast("decimal(19,0)")
    return ((step * index.cast("decimal(18,0)") + shift) % n.cast("decimal(18,0)")).cast("bigint")


def slots(goals: DataFrame, shard: int = SHARD) -> DataFrame:
    """source, shard, slot, turn, index: every slot of the mix and the block it takes.  Slots are numbered 0 .. n-1, in an
    order that mixes the sources."""
    chunk = 50_000
    total = goals.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))
    parts = goals.where("n_slots > 0").withColumn(
        "part", F.explode(F.expr(f"sequence(0L, (n_slots - 1) div {chunk})"))).repartition("source", "part")
    each = parts.withColumn("k", F.explode(F.expr(
        f"sequence(part * {chunk}, least(n_slots, (part + 1) * {chunk}) - 1)")))
    turn = F.expr("k div n_blocks")
    number = permuted(F.col("first") + F.col("k"), F.lit(max(1, total)), F.lit(0), F.lit("slot"))
    return each.select(
        "source", F.pmod(F.xxhash64(F.lit(SEED), F.col("first") + F.col("k")), F.lit(shards)).alias("shard"),
        number.alias("slot"),
        turn.alias("turn"), permuted(F.col("k") % F.col("n_blocks"), F.col("n_blocks"), turn, F.col("source")).alias("index"))


def measured(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """key, source, size, tie of every row, stored: texts are read once."""
    return stage(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                             F.xxhash64(text).alias("tie")), "sizes")


def laid(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows with words, each with its place ``start`` in its source's stream and, exploded, the blocks (``index``) it
    reaches into, with ``share`` words in each."""
    words = sizes.where("size > 0")
    most = words.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    along = running(words, ["source"], ["key", "tie", "size"], F.col("size"), cells(most), "start")
    spread = along.withColumn("index", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    return spread.withColumn("share", F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * block) -
                             F.greatest(F.col("start"), F.col("index") * block))


def placed(sizes: DataFrame, goals: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Rows of ``laid`` once for every slot that takes their block (shard, slot), or once with a null slot."""
    each = slots(goals, shard).select(F.col("source").alias("s"), F.col("index").alias("i"), "shard", "slot")
    # both sides grow with the words; the planner sees only the few rows that the slots are unfolded from
    return laid(sizes, block).join(
        each.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("index") == F.col("i")), "left").drop("s", "i")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
          shard: int = SHARD) -> DataFrame:
    """shard, slot, source, index, at, ``key``, tie, first_word, end_word: the mix itself.

    A slot holds block ``index`` of its source: words ``first_word`` to ``end_word`` (exclusive, from 0) of each document
    that reaches into the block, from the block's word ``at`` on.  A shard's slots are read by number, which mixes the
    sources.  ``tie`` tells apart texts of one id.
    """
    sizes = measured(docs, key, text, source)
    goals = stage(targets(sizes, block), "goals")
    begin = F.greatest(F.col("start"), F.col("index") * block)
    return placed(sizes, goals, block, shard).where("slot is not null").select(
        "shard", "slot", F.col("source").alias(source), "index", (begin - F.col("index") * block).alias("at"),
        F.col("key").alias(key), "tie", (begin - F.col("start")).alias("first_word"),
        (begin - F.col("start") + F.col("share")).alias("end_word"))


def _taken(sizes: DataFrame, goals: DataFrame, block: int) -> DataFrame:
    """key, source, size, tie, taken of every row with words."""
    words = F.when(F.col("slot").isNotNull(), F.col("share")).otherwise(0)
    return placed(sizes, goals, block).groupBy("source", "start", "key", "size", "tie").agg(
        F.sum(words).cast("bigint").alias("taken")).select("key", "source", "size", "tie", "taken")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        block: int = BLOCK) -> DataFrame:
    """``key``, size, source_size, target, taken, tie: one row per document, counted over the slots of ``mixed``.

    A null or empty text has size 0 and is taken 0 times; a null source is a source, the last; rows repeated with the
    same id are documents each by itself (``tie``, a hash of the text, tells texts apart); null ids stay null; an empty
    table gives no rows.  Other columns are not read.  No document is taken more than ``MOST`` times.
    """
    sizes = measured(docs, key, text, source)
    goals = stage(targets(sizes, block), "goals")
    rows = _taken(sizes, goals, block).union(
        sizes.where("size = 0").select("key", "source", "size", "tie", F.lit(0).cast("bigint")))
    ends = goals.select(F.col("source").alias("s"), "source_size", "target")
    return rows.join(ends, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("key").alias(key), "size", "source_size", "target", "taken", "tie")


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           block: int = BLOCK) -> DataFrame:
    """The documents, each as often as the mix takes its words, in whole copies.

    Fractions of copies are added up along each source, from short to long documents, and every whole number passed
    gives a copy: a source's words are those that the mix takes but for about its longest document (twice that for each
    cell of the running sum).  Columns are those of ``docs``.  Rows without words are in no block and are dropped; rows
    alike in id, source and text share their copies as evenly as these go.
    """
    sizes = measured(docs, key, text, source)
    goals = stage(targets(sizes, block), "goals")
    same = _taken(sizes, goals, block).groupBy("key", "source", "tie", "size").agg(
        F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    same = stage(same, "taken")
    most = same.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    one = 1 << 32       # a copy, in fixed point, so that sums are exact
    part = F.expr(f"(taken % size) * {one}L div size")
    summed = running(same, ["source"], ["size", "key", "tie"], part, cells(most), "before").withColumn(
        "before", F.col("before") + F.pmod(F.xxhash64(F.lit(SEED), "source"), F.lit(one)))
    times = summed.select(
        F.struct(F.col("key").alias("k"), F.col("source").alias("s"), F.col("tie").alias("t")).alias("_of"), "rows",
        (F.expr("taken div size") + F.expr(f"(before + (taken % size) * {one}L div size) div {one}L - before div {one}L"))
        .alias("_times")).where("_times > 0")
    # the row travels as one value: its columns may have any names
    rows = docs.select(F.struct(F.col(key).alias("k"), F.col(source).alias("s"), F.xxhash64(text).alias("t")).alias("of"),
                       F.struct(*quoted(docs)).alias("row"),
                       F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]).alias("h"))
    rows = rows.withColumn("n", F.row_number().over(W.partitionBy("of").orderBy("h")))
    return rows.join(times.hint("merge"), F.col("of") == F.col("_of")).withColumn(
        "_copies", F.expr("_times div rows + if(n <= _times % rows, 1, 0)")).where("_copies > 0").withColumn(
        "_copy", F.explode(F.expr("sequence(1L, _copies)"))).select("row.*")
