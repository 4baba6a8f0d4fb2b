"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging.

Vectors are packed into tiles of bounded size where they lie, so tiles are equal whatever the ids; their whole numbers
take two or four bytes where they fit.  A cell of the work is a run of ``QUERY_RUN`` tiles of queries and one of ``RUN``
tiles of candidates, so a tile travels once to every run of the other side; each cell multiplies, selects the best of
every tile and merges them.  Lists of one query are then merged in a tree, ``FAN`` at a time, until one is left.  No task
holds more than RUN + QUERY_RUN tiles, and nothing passes through the driver but two counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickforge.session import stage

TILE = 4096
RUN = 12
QUERY_RUN = 8
FAN = 32
SCALE = 1024
LOWEST = np.iinfo(np.int64).min
#: Below this, sums of products of whole numbers are exact in doubles.
EXACT = 2.0 ** 53


def usable(vector: str) -> Column:
    """Not null, and every component a finite number."""
    x = F.col(vector)
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def _tiles(scale: int, rows: int):
    def run(batches):
        part, number, ids, vectors = TaskContext.get().partitionId(), 0, [], []

        def tile():
            width = max(map(len, vectors))
            m = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                m[i, :len(v)] = np.floor(np.asarray(v, dtype=float) * scale)
            if not np.isfinite(m).all():
                raise OverflowError(f"a component times {scale} is beyond doubles")
            order = np.argsort(np.array(ids), kind="stable")
            kind = next((k for k in ("<i2", "<i4") if np.abs(m).max(initial=0) <= np.iinfo(k).max), "<f8")
            return pd.DataFrame({"part": [part], "number": [number], "width": [width], "kind": [kind],
                                 "ids": [np.array(ids, dtype=np.int64)[order].tobytes()],
                                 "matrix": [m[order].astype(kind).tobytes()]})

        for pdf in batches:
            for i, v in zip(pdf["id"], pdf["vector"], strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == rows:
                    yield tile()
                    number, ids, vectors = number + 1, [], []
        if ids:
            yield tile()
    return run


TILES = "part int, number int, width int, kind string, ids binary, matrix binary"


def _numbered(rows: DataFrame, scale: int, size: int, label: str) -> tuple[DataFrame, int]:
    """Stored tiles with a number 0 .. n-1, and n.  One row per tile: the numbering is over few rows."""
    tiles = stage(rows.mapInPandas(_tiles(scale, size), TILES), label)
    per = tiles.groupBy("part").agg(F.count("*").alias("n"))
    first = per.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(
        W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return tiles.join(first, F.col("part") == F.col("p")).withColumn(
        "tile", F.col("first") + F.col("number")).drop("p", "first", "part", "number"), tiles.count()


def _read(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, dtype=np.int64)
    return ids, np.frombuffer(row.matrix, dtype=row.kind).reshape(len(ids), row.width).astype(float)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of all rows as exact whole numbers; one that 64 bits cannot hold is an error."""
    width = min(q.shape[1], c.shape[1])      # a missing component counts as 0
    q, c = q[:, :width], c[:, :width]
    if width * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (q, c)]
    scores = whole[0] @ whole[1].T
    if scores.size and max(scores.max(), -scores.min()) > np.iinfo(np.int64).max:
        raise OverflowError("a score is beyond 64 bits")
    return scores.astype(np.int64)


def best_of(qi, q, ci, c, k: int):
    """(query position, candidate id, score) of the best ``k`` of one tile.  Candidates are in order of id, so of those
    that tie with the k-th score the first are taken."""
    scores = products(q, c)
    scores[qi[:, None] == ci[None, :]] = LOWEST
    if len(ci) > k:
        weakest = np.partition(scores, len(ci) - k, axis=1)[:, len(ci) - k, None]
        above, level = scores > weakest, scores == weakest
        room = k - above.sum(axis=1, keepdims=True)
        taken = above | (level & (level.cumsum(axis=1) <= room))
    else:
        taken = np.ones(scores.shape, dtype=bool)
    at, place = np.nonzero(taken & (scores != LOWEST))
    return at, ci[place], scores[at, place]


def _cell(k: int):
    def run(key, queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        best = []
        for q in queries.itertuples():
            (qi, qm), found = _read(q), None
            for c in shards.itertuples():
                at, ids, scores = best_of(qi, qm, *_read(c), k)
                now = pd.DataFrame({"at": at, "vec_id": ids, "score": scores})
                if found is not None:      # one list per query at any time
                    both = pd.concat([found, now]).sort_values(["at", "score", "vec_id"], ascending=[True, False, True])
                    now = both.groupby("at", sort=False).head(k)
                found = now
            if found is not None:
                best.append(found.assign(query_id=qi[found["at"].to_numpy()], copy=q.tile * TILE + found["at"]))
        out = pd.concat(best) if best else pd.DataFrame(columns=["query_id", "copy", "vec_id", "score"])
        return out.assign(run=key[1])[["query_id", "copy", "run", "vec_id", "score"]].astype("int64")
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """query_id, rank, ``key``, score: the ``k`` largest integer inner products of every query row, ties to smaller ids.

    Components become floor(scale * x).  Rows with a null id, or a vector that is null or holds a null or non-finite
    component, take no part; a shorter vector's missing components count as 0.  Rows with the query's own id are not its
    candidates; other repeated rows each are.  Identical query rows give one list.  Fewer candidates than ``k`` give
    fewer rows; an empty table none.  Scores are exact whatever the components' size; one beyond 64 bits is an error.
    """
    rows = vectors.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("q"))
    asked = rows.where("q").select("id", "vector").distinct()
    shards, n_shards = _numbered(rows.select("id", "vector"), scale, TILE, "shards")
    queries, n_queries = _numbered(asked, scale, TILE, "queries")
    n_runs, n_blocks = max(1, -(-n_shards // RUN)), max(1, -(-n_queries // QUERY_RUN))
    left = queries.withColumn("block", F.expr(f"tile div {QUERY_RUN}")).withColumn("run", F.explode(F.expr(f"sequence(0L, {n_runs - 1}L)")))
    right = shards.withColumn("run", F.expr(f"tile div {RUN}")).withColumn(
        "block", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")))
    lists = left.groupBy("block", "run").cogroup(right.groupBy("block", "run")).applyInPandas(
        _cell(k), "query_id bigint, copy bigint, run bigint, vec_id bigint, score bigint")
    best = [F.col("score").desc(), F.col("vec_id")]
    while n_runs > 1:
        n_runs = -(-n_runs // FAN)
        lists = lists.withColumn("run", F.expr(f"run div {FAN}"))
        lists = lists.withColumn("r", F.row_number().over(W.partitionBy("copy", "run").orderBy(*best))).where(
            F.col("r") <= k).drop("r")
    ranked = lists.withColumn("rank", F.row_number().over(W.partitionBy("copy").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(key), "score")
