"""Text quality: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

A text becomes words (runs of letters, of digits, of other signs).  Hashed features are n-grams of three
alphabets: the words themselves (1-2), their shapes (1-3: lower case, capitalised, capitals, digits, or the sign
itself) and whether a word repeats the one before it or the one before that.  A feature's value is its share of
the text's n-grams of that kind, so a score is a sparse dot product, whatever the text's length.

The fit reads a bounded, documented sample of the labelled rows (``fit_rows``, chosen by hash of the id) in one
task; it needs all examples in turn.  Scoring reads every text once where it lies: no shuffle.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BITS = 18
FIT_ROWS = 12_000
EPOCHS = 4
CACHE = 200_000
WORD = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _code(word: str) -> int:
    """Hash of the word (32 bits) and of its shape (8 bits), in one number."""
    if word.isalpha():
        shape = 1 if word.islower() else 2 if word.isupper() and len(word) > 1 else 3 if word[0].isupper() else 4
    elif word.isdecimal():
        shape = 5
    else:
        shape = 8 + zlib.crc32(word[:3].encode()) % 240
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) << 8 | shape


class Hasher:
    """Feature indices of texts.  The cache of word codes is bounded and changes no result."""

    def __init__(self, bits: int = BITS):
        self.bits, self.cache = bits, {}

    def _codes(self, text: str) -> np.ndarray:
        words, cache = WORD.findall(text), self.cache
        if len(cache) > CACHE:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = _code(w)
        return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))

    def _index(self, kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(parts[0]), kind + 1, dtype=np.uint64) * MIX[2]
        for p in parts:
            h = (h ^ (p + np.uint64(1)) * MIX[0]) * MIX[1]
            h ^= h >> np.uint64(32)
        return (h * MIX[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def kinds(self, text: str | None) -> list[np.ndarray]:
        """Feature indices by kind of n-gram; an empty text has one feature of its own."""
        code = self._codes(text) if text else np.zeros(0, dtype=np.uint64)
        if not len(code):
            return [self._index(9, np.zeros(1, dtype=np.uint64))]
        word, shape = code >> np.uint64(8), code & np.uint64(255)
        back = [np.zeros(len(code), dtype=np.uint64) for _ in range(2)]
        for k in (1, 2):
            back[k - 1][k:] = word[k:] == word[:-k]
        out = [self._index(0, word), self._index(1, shape), self._index(2, *back, shape)]
        if len(code) > 1:
            out += [self._index(3, word[:-1], word[1:]), self._index(4, shape[:-1], shape[1:])]
        if len(code) > 2:
            out.append(self._index(5, shape[:-2], shape[1:-1], shape[2:]))
        return out

    def sparse(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct indices and their values."""
        kinds = self.kinds(text)
        index, value = np.concatenate(kinds), np.concatenate([np.full(len(k), 1.0 / len(k)) for k in kinds])
        distinct, where = np.unique(index, return_inverse=True)
        return distinct, np.bincount(where, weights=value)

    def dot(self, weights: np.ndarray, text: str | None) -> float:
        return float(sum(weights[k].mean() for k in self.kinds(text)))


class Ftrl:
    """Follow-the-regularised-leader, proximal, with a step size per coordinate."""

    def __init__(self, bits: int = BITS, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, index: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(index)
        g = (1.0 / (1.0 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - sigma * w
        self.n[index] += g * g


def _examples(batches):
    hasher = Hasher()
    for pdf in batches:
        found = [hasher.sparse(t) for t in pdf["text"]]
        yield pd.DataFrame({"at": pdf["at"], "label": pdf["label"],
                            "index": [i.astype(np.int32).tobytes() for i, _ in found],
                            "value": [v.astype(np.float32).tobytes() for _, v in found]})


def _fit(batches):
    rows = sorted(r for pdf in batches for r in pdf.itertuples(index=False, name=None))
    model, bias = Ftrl(), np.array([1 << BITS])
    examples = [(np.append(np.frombuffer(i, np.int32), bias), np.append(np.frombuffer(v, np.float32), 1.0), y)
                for _, y, i, v in rows]
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(examples)):
            model.learn(*examples[k])
    yield pd.DataFrame({"weights": [model.weights().astype(np.float32).tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights (the last is the bias) from at most ``fit_rows`` labelled documents.

    Several labels of one id count as their majority (ties: 1); null ids and labels are left out.  Without any
    label all weights are 0, so every score is one half.
    """
    chosen = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(key).alias("_key")).agg((F.avg(label) >= 0.5).cast("double").alias("label"))
              .orderBy(F.xxhash64(F.lit(3), "_key"), "_key").limit(fit_rows))
    rows = (docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "_key")    # fit_rows ids at most
            .select(F.xxhash64(F.lit(3), "_key", "text").alias("at"), "label", "text"))
    examples = rows.mapInPandas(_examples, "at bigint, label double, index binary, value binary")
    # repeated rows could exceed the bound that holds for ids
    sample = examples.orderBy("at").limit(fit_rows).repartition(1)
    found = sample.mapInPandas(_fit, "weights binary").collect()    # one vector of 2^BITS + 1
    if not found:
        return np.zeros((1 << BITS) + 1, dtype=np.float32)
    return np.frombuffer(found[0].weights, dtype=np.float32)


def scorer(weights: np.ndarray):
    """Column function: probability of label 1."""
    sent = weights.tobytes()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w = np.frombuffer(sent, dtype=np.float32).astype(float)
        hasher = Hasher()
        logit = np.array([hasher.dot(w, t) for t in texts]) + w[-1]
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))

    return score


def score(docs: DataFrame, labels: DataFrame, held: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``key``, held_out, score, predicted for every row of ``docs``; labels of held-out ids are not read.

    Null and empty texts get the score of "no words"; null ids are not held out; repeated rows stay repeated.
    ``held`` is an expression over the id column, which both tables have.
    """
    weights = fit(docs, labels.where(~F.coalesce(held, F.lit(False))), key, text, label, fit_rows)
    out = docs.select(F.col(key), F.coalesce(held, F.lit(False)).alias("held_out"),
                      scorer(weights)(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
