"""Near-duplicate vectors by a forest of random-projection trees with spill.

Equal vectors of a label form a class and go on as one row.  Every tree cuts a label's classes again and again: a cell
that is too large is projected on random directions (of a few drawn, the one along which the cell is widest) and split
at the medians of a bounded sample of the cell; points near a cut go to both sides, so a pair at the threshold is rarely
parted, and several trees part it in all of them hardly ever.  A round cuts every large cell ``DEPTH`` times; rounds go
on until cells are small.  A cell whose points would mostly go to both sides (they are all near each other, and mostly
linked) is not split but compared in tiles, exactly.  Within cells all pairs are verified in double precision.  Links
are not handed on: a cell gives each member's count of those that no earlier cell has found, and as many links as hold
its members together; counts are summed, and stars of these links give the components.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickforge.llm.common import components
from tickforge.llm.topk_search import usable
from tickforge.session import stage

TREES = 5
LEAF = 512
TILE = 1024         # of a dense cell
COLUMNS = 4096      # cells that members share, looked at at once
DEPTH = 3           # cuts of a cell in one round
NODES = (1 << DEPTH) - 1
DRAWN = 8           # directions drawn for a cut
SAMPLE = 2_000      # of a cell, for its medians
SPILL = 0.6         # standard deviations of a threshold pair's projected distance
MOST = 2.4          # times its points a cell may hand on in a round; beyond, it is dense
ROUNDS = 40
GATHER = 20_000     # rows routed at once


def unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=float) for v in vectors])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def directions(cell: str, width: int) -> np.ndarray:
    """The random directions drawn for a cell's cuts, (width, NODES, DRAWN), from its name alone."""
    d = np.random.default_rng(zlib.crc32(cell.encode())).normal(size=(width, NODES, DRAWN))
    return d / np.linalg.norm(d, axis=0)


def reach(cosine: float, width: int) -> float:
    """How far beyond a cut points go to both sides: a pair at ``cosine`` is sqrt(2 - 2 cosine) apart, and a random
    direction shows 1 / sqrt(width) of that."""
    return SPILL * math.sqrt((2 - 2 * cosine) / width)


def spilled(m: np.ndarray, pick, cuts, far: float) -> list[np.ndarray]:
    """Positions of the points in each leaf of a cell's cuts.  ``pick(node, points)`` gives their projection."""
    inside = {0: np.arange(len(m))}
    for node in range(NODES):
        at = inside.pop(node)
        x = pick(node, m[at])
        cut = cuts[node] if cuts is not None else None
        x = x - (cut if cut is not None else 0.0)
        inside[2 * node + 1], inside[2 * node + 2] = at[x <= far], at[x >= -far]
    return [inside[leaf] for leaf in range(NODES, 2 * NODES + 1)]


def _cuts(cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        m = unit(pdf["vector"])
        drawn, cuts, picks = directions(key[0], m.shape[1]), np.zeros(NODES), np.zeros(NODES, dtype=int)

        def widest(node, points):
            p = points @ drawn[:, node]
            picks[node] = int(p.std(axis=0).argmax()) if len(p) else 0
            cuts[node] = np.median(p[:, picks[node]]) if len(p) else 0.0
            return p[:, picks[node]] - cuts[node]

        leaves = spilled(m, widest, None, reach(cosine, m.shape[1]))
        return pd.DataFrame({"cell": [key[0]], "cuts": [cuts.tolist()], "picks": [picks.tolist()],
                             "growth": [sum(map(len, leaves)) / len(m)]})
    return run


ROUTED = pa.schema([("cell", pa.string()), ("node", pa.int64()), ("vector", pa.list_(pa.float64()))])


def _route(cosine: float):
    def one(table: pa.Table):
        cells, vectors = table["cell"].to_numpy(), table["vector"].to_pylist()
        order = np.argsort(cells, kind="stable")
        edges = np.flatnonzero(np.r_[True, cells[order][1:] != cells[order][:-1], True])
        take, names = [], []
        for s, e in zip(edges[:-1], edges[1:]):
            at = order[s:e]
            cell, first = cells[at[0]], int(at[0])
            m = unit([vectors[i] for i in at])
            picks = table["picks"][first].as_py()
            drawn = directions(cell, m.shape[1])[:, np.arange(NODES), picks]
            for leaf, rows in enumerate(spilled(m, lambda node, x: x @ drawn[:, node], table["cuts"][first].as_py(),
                                                reach(cosine, m.shape[1]))):
                take.append(at[rows])
                names += [f"{cell}.{leaf}"] * len(rows)
        at = pa.array(np.concatenate(take))
        yield from pa.table({"cell": pa.array(names, pa.string()), "node": table["node"].take(at),
                             "vector": table["vector"].take(at)}).cast(ROUTED).to_batches(max_chunksize=5000)

    def run(batches):
        held = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= GATHER:
                yield from one(pa.Table.from_batches(held).combine_chunks())
                held = []
        if sum(x.num_rows for x in held):
            yield from one(pa.Table.from_batches(held).combine_chunks())
    return run


def met_before(held: list[np.ndarray], number: int) -> np.ndarray:
    """Which members of a cell also share a cell with a smaller number, (m, m)."""
    who, cell = np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate(held)
    who, cell = who[cell < number], cell[cell < number]
    _, at, times = np.unique(cell, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1          # a cell that one member is in parts nothing
    who, at = who[times[at] > 1], column[at[times[at] > 1]]
    out = np.zeros((len(held), len(held)), dtype=bool)
    for s in range(0, int(at.max(initial=-1)) + 1, COLUMNS):
        inside = np.zeros((len(held), COLUMNS), dtype=np.float32)
        part = (at >= s) & (at < s + COLUMNS)
        inside[who[part], at[part] - s] = 1.0
        out |= inside @ inside.T > 0
    return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a symmetric matrix that connect all it connects, without circles."""
    free, out = linked.any(axis=1), []
    for root in range(len(linked)):
        front = [root] if free[root] else []
        free[root] = False
        while front:
            at = front.pop()
            reached = np.flatnonzero(linked[at] & free)
            free[reached] = False
            out += [(at, int(i)) for i in reached]
            front += reached.tolist()
    return out


def _compare(cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        m, node, tile, n = unit(pdf["vector"]), *(pdf[c].to_numpy() for c in ("node", "tile", "n"))
        linked = np.zeros((len(m), len(m)), dtype=bool)
        for s in range(0, len(m), 1024):
            linked[s:s + 1024] = m[s:s + 1024] @ m.T >= cosine
        if key[1] != key[2]:
            linked &= tile[:, None] != tile      # in a group of two tiles only pairs across them are new
        linked = np.triu(linked, 1)
        linked |= linked.T
        at = np.flatnonzero(linked.any(axis=1))
        if not len(at):
            return pd.DataFrame({"x": [], "y": [], "others": []})
        new = linked[np.ix_(at, at)]
        new &= ~met_before([np.asarray(pdf["held"].iat[i]) for i in at], int(pdf["number"].iat[0]))
        node, others = node[at], new.astype(float) @ n[at].astype(float)     # whole numbers below 2^53
        pairs = spanning(new)
        x = [*node[others > 0], *(node[i] for i, _ in pairs)]
        y = [*([None] * int((others > 0).sum())), *(node[j] for _, j in pairs)]
        return pd.DataFrame({"x": pd.array(x, dtype="Int64"), "y": pd.array(y, dtype="Int64"),
                             "others": [*others[others > 0].astype(np.int64), *([0] * len(pairs))]})
    return run


def cells(classes: DataFrame, cosine: float) -> DataFrame:
    """cell, number (of the cell), size, node, vector: every class in the final cells of every tree."""
    trees = F.explode(F.expr(f"sequence(0, {TREES - 1})"))
    rows = stage(classes.withColumn("tree", trees).select(
        F.concat_ws("/", F.col("label").cast("string"), F.size("vector").cast("string"), F.col("tree").cast("string"))
        .alias("cell"), "node", "vector"), "cells")
    done = None
    for turn in range(ROUNDS):
        sizes = stage(rows.groupBy("cell").agg(F.count("*").alias("size")).withColumn(
            "number", F.monotonically_increasing_id() * ROUNDS + turn), "sizes")     # no two cells share a number
        sized = rows.join(sizes, "cell")
        if turn == ROUNDS - 1 or not sizes.where(F.col("size") > LEAF).head(1):
            return sized if done is None else done.union(sized)
        large = sized.where(F.col("size") > LEAF)
        chance = F.pmod(F.xxhash64("node", "cell"), F.lit(1 << 30)) < F.lit(float(SAMPLE << 30)) / F.col("size")
        cuts = stage(large.where(chance).groupBy("cell").applyInPandas(
            _cuts(cosine), "cell string, cuts array<double>, picks array<int>, growth double"), "cuts")
        cuts = cuts.where(F.col("growth") <= MOST).drop("growth")
        rest = sized.join(cuts.select("cell"), "cell", "left_anti")      # small, or dense
        done = rest if done is None else done.union(rest)
        rows = stage(large.join(cuts, "cell").select("cell", "node", "vector", "cuts", "picks").mapInArrow(
            _route(cosine), "cell string, node bigint, vector array<double>"), "cells")


def links(classes: DataFrame, cosine: float) -> DataFrame:
    """x, y, others: for each class x what its links count in rows, in parts (y null), and links x, y that connect
    all classes which links at ``cosine`` or more connect.

    A link is found in every cell that holds both its ends; it counts in the one with the smallest number alone, which
    a class's list of cells tells.  A group of two tiles hands on at most two rows per member, however many links.
    """
    dealt = stage(cells(classes, cosine).select("cell", "number", "size", "node"), "dealt")
    held = dealt.groupBy("node").agg(F.collect_list("number").alias("held"))     # some cells per tree
    full = classes.select("node", "vector", "n").join(held, "node")
    tiles = F.when(F.col("size") <= LEAF, 1).otherwise(F.ceil(F.col("size") / TILE)).cast("int")
    placed = dealt.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    # a cell of one tile is one group; of a dense cell every two tiles meet in a group
    met = placed.join(full, "node").withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)"))).select(
        "cell", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "number", "node",
        "vector", "n", "held")
    return met.groupBy("cell", "a", "b").applyInPandas(_compare(cosine), "x bigint, y bigint, others bigint")


def groups(vectors: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding",
           label: str = "label") -> DataFrame:
    """``key``, n_links, component_id, kept: one row per row of ``vectors``.

    Only rows of equal, non-null label (and vectors of one width) are compared.  Rows whose id, label or vector is null,
    whose vector is zero or holds a null or non-finite component link with nothing: 0 links, their own component, kept.
    Equal vectors of a label link with each other.  Rows repeated with one id count as vectors each.
    """
    x = F.col(vector)
    taking = F.col(key).isNotNull() & F.col(label).isNotNull() & usable(vector) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"),
                          F.transform(x, lambda v: v.cast("double") + 0.0).alias("vector"),
                          F.coalesce(taking, F.lit(False)).alias("taking"))
    # 128 bits of hash tell classes apart; a stored number names them
    name = F.concat(F.hex(F.xxhash64(F.lit(1), "label", "vector")), F.lit("-"),
                    F.hex(F.xxhash64("vector", "label", F.lit(2))))
    rows = stage(rows.withColumn("name", F.when(F.col("taking"), name)), "vectors")
    classes = stage(rows.where("taking").groupBy("name").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("key").alias("least"),
        F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id()), "classes")
    found = stage(links(classes, cosine), "links")
    near = found.where("y is null").groupBy(F.col("x").alias("node")).agg(F.sum("others").alias("others"))
    linked = components(found.where("y is not null"), "x", "y")
    named = classes.select("node", "name", "n", "least").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").join(near, "node", "left").select(
        "name", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("key", "name").join(facts, "name", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
