"""Ranked lexical search by a dual tree: hierarchies over items and documents bound each other's scores.

1. Items come in blocks of at most ``ITEM_CHARS`` characters; a block's terms are its vocabulary.
2. Every document becomes its length and the frequencies of vocabulary terms, stored once per block of items; document
   frequencies are sums over that table.
3. A task reads stored documents in runs, sorts a run by leading terms and builds a tree over it: a node holds, for each
   term, the largest share any document below adds for it.  The items' tree holds the terms of the items below a node.
4. The trees are walked together.  The sum of a document node's maxima over an item node's terms bounds every score
   between them; it is dropped when below the weakest k-th score of the items below, so whole batches go at once.
   Ties with the k-th score stay.  Single items meet single documents in exact whole numbers.
5. A task hands on the best ``k`` of each item; lists of one item are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tickforge.llm.common import word_list
from tickforge.session import stage

ITEM_CHARS = 2_000_000
#: Documents of one tree, and most cells (terms x documents) of its matrix.
RUN_DOCS, CELLS = 1024, 8_000_000
#: Documents of a leaf, and children of every other node of both trees.
LEAF, FAN = 16, 8
MERGED = 64

VECTORS = "id bigint, length bigint, terms array<int>, counts array<int>"
LISTS = "item int, name string, score bigint, id bigint"


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches):
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch[1].to_pylist():
                words = word_list(text)
                found = Counter(w for w in words if w in vocabulary)
                lengths.append(len(words))
                terms.append([vocabulary[w] for w in found])
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], names=["id", "length", "terms", "counts"])
    return run


class ItemTree:
    """Items in the order of their rarest terms; nodes are (first, last, terms, children), an item has no children."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        leading = [tuple(sorted(t, key=lambda x: (-weights[x], x))[:2]) for t in terms]
        self.order = sorted(range(len(terms)), key=lambda i: leading[i])
        level = [(i, i + 1, terms[item], ()) for i, item in enumerate(self.order)]
        while len(level) > FAN:
            level = [(g[0][0], g[-1][1], np.unique(np.concatenate([n[2] for n in g])), tuple(g))
                     for g in (level[i:i + FAN] for i in range(0, len(level), FAN))]
        self.top = level


class Best:
    """The ``k`` best documents of every item so far: highest score first, ties by id, a missing id last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = [np.empty(0, np.int64)] * n
        self.ids = [np.empty(0, np.int64)] * n
        self.missing = [np.empty(0, bool)] * n
        self.weakest = np.ones(n, np.int64)     # no score below 1 counts

    def offer(self, item: int, scores, ids, missing) -> None:
        scores = np.concatenate([self.scores[item], scores])
        ids = np.concatenate([self.ids[item], ids])
        missing = np.concatenate([self.missing[item], missing])
        top = np.lexsort((ids, missing, -scores))[:self.k]
        self.scores[item], self.ids[item], self.missing[item] = scores[top], ids[top], missing[top]
        if len(top) == self.k:
            self.weakest[item] = max(1, scores[top[-1]])


class DocumentTree:
    """Shares of a run of documents by term, and their maxima over runs of ``LEAF``, ``LEAF * FAN``, ... documents."""

    def __init__(self, rows: list[tuple], weights: np.ndarray, n_docs: int, n_words: int):
        self.present = np.unique(np.concatenate([r[2] for r in rows]))
        lead = [r[2][weights[r[2]].argmax()] if len(r[2]) else -1 for r in rows]
        rows = [rows[i] for i in np.argsort(lead, kind="stable")]
        self.missing = np.array([r[0] is None for r in rows])
        self.ids = np.array([0 if r[0] is None else r[0] for r in rows], np.int64)
        sizes = [len(r[2]) for r in rows]
        terms, tf = (np.concatenate([r[i] for r in rows]).astype(np.int64) for i in (2, 3))
        norm = np.array([100 - 90 + 90 * r[1] * n_docs // n_words for r in rows], np.int64)
        at = np.repeat(np.arange(len(rows)), sizes)
        shares = np.zeros((len(self.present), -(-len(rows) // LEAF) * LEAF), np.int64)
        shares[np.searchsorted(self.present, terms), at] = weights[terms] * ((1_000_000_000 * tf) // (
            1000 * tf + 8 * norm[at]))
        self.levels, self.fan = [shares], [1]
        size = LEAF
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            width = -(-below.shape[1] // size) * size
            if width > below.shape[1]:
                below = np.pad(below, ((0, 0), (0, width - below.shape[1])))
            self.levels.append(below.reshape(len(below), -1, size).max(axis=2))
            self.fan.append(size)
            size = FAN

    def rows_of(self, terms: np.ndarray) -> np.ndarray:
        """Rows of the terms that any document here holds."""
        at = np.searchsorted(self.present, terms)
        at[at == len(self.present)] = 0
        return at[self.present[at] == terms] if len(self.present) else at[:0]

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = (nodes[:, None] * self.fan[level] + np.arange(self.fan[level])).ravel()
        return below[below < self.levels[level - 1].shape[1]]


def walk(tree: DocumentTree, items: ItemTree, best: Best) -> int:
    """Offer every document that may be among an item's best; returns how many scores were worked out in full.

    Both trees are descended together down to the leaves of documents, then items to single ones, then documents.
    """
    top = len(tree.levels) - 1
    stack = [(node, top, np.arange(tree.levels[top].shape[1])) for node in reversed(items.top)]
    scored = 0
    while stack:
        node, level, docs = stack.pop()
        first, last, terms, below = node
        bounds = tree.levels[level][np.ix_(tree.rows_of(terms), docs)].sum(axis=0)
        near = bounds >= best.weakest[first:last].min()
        scored += len(docs) if level == 0 else 0
        docs = docs[near]
        if not len(docs):
            continue
        if level == 0:
            best.offer(first, bounds[near], tree.ids[docs], tree.missing[docs])
        elif not below:
            stack.append((node, level - 1, tree.children(level, docs)))
        elif level > 1:
            finer = tree.children(level, docs)
            stack.extend((child, level - 1, finer) for child in reversed(below))
        else:
            stack.extend((child, level, docs) for child in reversed(below))
    return scored


def _search(names: list[str | None], item_terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_words: int, k: int):
    def visit(rows, items, best):
        present = len(np.unique(np.concatenate([r[2] for r in rows])))
        if present * len(rows) > CELLS and len(rows) > LEAF:
            half = len(rows) // 2
            visit(rows[:half], items, best)
            visit(rows[half:], items, best)
            return
        walk(DocumentTree(rows, weights, n_docs, n_words), items, best)

    def run(batches):
        items, best, rows = ItemTree(item_terms, weights), Best(len(item_terms), k), []
        for batch in batches:
            terms, counts = batch[2], batch[3]
            for i, (key, length) in enumerate(zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True)):
                rows.append((key, length, terms[i].values.to_numpy(), counts[i].values.to_numpy()))
                if len(rows) == RUN_DOCS:
                    visit(rows, items, best)
                    rows = []
        if rows:
            visit(rows, items, best)
        at = np.repeat(items.order, [len(s) for s in best.scores])
        if len(at):
            yield pa.RecordBatch.from_arrays([
                pa.array(at, pa.int32()), pa.array([names[i] for i in at], pa.string()),
                pa.array(np.concatenate(best.scores)),
                pa.array(np.concatenate(best.ids), mask=np.concatenate(best.missing))],
                names=["item", "name", "score", "id"])
    return run


def _ranked(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    return lists.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def _block(documents: DataFrame, asked: list[tuple], k: int) -> DataFrame:
    """item, name, score, id, rank for one block of (name, text)."""
    texts = [set(word_list(text)) for _, text in asked]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*texts)))}
    terms = [np.array(sorted(vocabulary[w] for w in found), np.int64) for found in texts]
    vectors = stage(documents.mapInArrow(_vectors(vocabulary), VECTORS), "vectors")
    n_docs, n_words = vectors.where("length > 0").agg(F.count("*"), F.sum("length")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    search_all = _search([name for name, _ in asked], terms, weights, n_docs, n_words or 1, k)
    lists = vectors.where(F.size("terms") > 0).mapInArrow(search_all, LISTS)
    part = _ranked(lists.withColumn("part", F.spark_partition_id() % MERGED), ["item", "part"], k)
    return _ranked(part.drop("part", "rank"), ["item"], k)


def search(documents: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """``item_key``, rank, ``key``, score: the ``k`` highest-scoring documents of every item, ties by ascending id.

    Ids of documents are whole numbers.  A null or empty text has no terms: such documents count nowhere and are not
    found, such items find nothing.  A document with a null id counts like any other and comes last among equal scores.
    Repeated document rows are ranked each; identical rows of items are one item, items that share an id but not the text
    are ranked each.  Fewer than ``k`` documents with a score above 0 give fewer rows; empty tables give none.  Other
    columns are not read.
    """
    kind = items.schema[item_key].dataType
    asked = stage(items.select(F.col(f"`{item_key}`").cast("string").alias("name"), F.col(f"`{item_text}`").alias("text"))
                  .where("text is not null").distinct(), "items")
    size = asked.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_chars))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    rows = documents.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    found = None
    for block in range(blocks):     # of about item_chars characters each, whatever the number of items
        texts = [tuple(r) for r in dealt.where(F.col("block") == block).select("name", "text").collect()]
        lists = _block(rows, texts, k)
        found = lists if found is None else found.union(lists)
    return found.select(F.col("name").cast(kind).alias(item_key), "rank", F.col("id").alias(key), "score")
