"""Best-fit packing of tokenized documents into sequences of bounded length, planned over a length histogram.

A document is its token ids and one end id; longer ones are cut into full pieces from the end, so only the first piece
may be shorter.  Piece lengths are counted (at most ``size`` different ones), and best-fit decreasing runs over the
counts on the driver: a length goes into the sequences with the least room that suffices, many alike at a time.  The
plan is a list of slots (length, first rank, count, sequences, offset); it grows with ``size``, not with the pieces.
Pieces then take planned slots by a join on (length, rank within length).  Ranks are running counts over cells, so a
length that a third of all pieces share is no single task's work.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickforge.llm.common import cells, running
from tickforge.session import stage

SIZE = 1024
END_ID = 2
PIECES = "key string, piece int, start bigint, length bigint, ids_crc32 bigint, tie bigint"
_MODELS: dict[str, object] = {}


def _byte_of() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others
    follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def tokenizer(path: str, pattern: str):
    """The vocabulary of a tokenizers file (byte-level BPE whose ids are its merge order) as a tiktoken encoding:
    with ``encode``, the library's ids at four times the speed.  Kept per process.  Texts are split at the file's added
    tokens; those that also take spaces, or stand only between words, or begin like another, are refused."""
    import tiktoken

    if path not in _MODELS:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        special = {t["content"]: t["id"] for t in added}
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")) or any(
                a != b and a.startswith(b) for a in special for b in special):
            raise ValueError(f"added tokens of {path} are not plain strings")
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        _MODELS[path] = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens=special)
    return _MODELS[path]


#: Runs of white space from here on bypass the pattern, whose search keeps a place to return to for every character.
LONG_SPACE = 100_000
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


def encode(model, text: str | None) -> list[int]:
    """The text's ids, added tokens by their own.

    The pattern takes a run of white space as all but its last character, which goes with what follows, or whole where
    nothing or an added token follows; long runs are cut there and merged as one token each, so the ids are the same.
    """
    if not text:
        return []
    ids, done = [], 0
    for run in _SPACE.finditer(text):
        ids += model.encode(text[done:run.start()], allowed_special="all")
        whole = run.end() == len(text) or any(text.startswith(t, run.end()) for t in model.special_tokens_set)
        done = run.end() if whole else run.end() - 1
        ids += model._encode_single_piece(text[run.start():done])
    return ids + model.encode(text[done:], allowed_special="all")


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    first = length % size
    starts = ([0] if first else []) + list(range(first, length, size))
    return [(s, min(size, length - s) if s or not first else first) for s in starts]


def _pieces(path: str, pattern: str, size: int, end_id: int):
    def run(batches):
        model = tokenizer(path, pattern)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for key, text in zip(keys, texts, strict=True):
                ids = np.array([*encode(model, text), end_id], dtype="<u4")
                whole = ids.tobytes()
                tie = zlib.crc32(whole)
                for piece, (start, length) in enumerate(cut(len(ids), size)):
                    part = whole[4 * start:4 * (start + length)]
                    out.append((key, piece, start, length, zlib.crc32(part), tie))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["key", "piece", "start", "length", "ids_crc32", "tie"])
    return run


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram {length: pieces}.

    Returns (length, first rank, n sequences, first sequence, offset, per sequence): the ranks from ``first rank`` on
    fill ``n`` sequences with ``per sequence`` pieces each, one behind the other from ``offset`` on.
    """
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)     # room left: (first sequence, how many)
    out, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = next((r for r in range(length, size) if groups.get(r)), None)
            if room is None:
                fit = size // length
                n = left // fit
                per = fit if n else left
                n = n or 1
                first, room = sequences, size
                sequences += n
            else:
                first, n = groups[room].pop()
                per = min(room // length, left)
                take = min(n, left // per)
                if take < n:
                    groups[room].append((first + take, n - take))
                n = take
            out.append((length, rank, n, first, size - room, per))
            rank += n * per
            left -= n * per
            if room - per * length:
                groups[room - per * length].append((first, n))
    return out


def pieces(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", size: int = SIZE,
           end_id: int = END_ID) -> DataFrame:
    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(
        _pieces(path, pattern, size, end_id), PIECES)


def place(found: DataFrame, size: int) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    spark = found.sparkSession
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(counts, size)
    rows = spark.createDataFrame([(*s, i) for i, s in enumerate(slots)] or [(0, 0, 0, 0, 0, 1, 0)],
                                 "length bigint, rank bigint, n bigint, first bigint, at bigint, per bigint, slot int")
    # rows in chunks, so that a length with very many sequences is no single row's work
    chunk = 10_000
    chunks = rows.where("n > 0").withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {chunk})"))).repartition(
        "slot", "chunk")
    each = chunks.withColumn("k", F.explode(F.expr(
        f"sequence(chunk * {chunk}, least(n, (chunk + 1) * {chunk}) - 1)"))).withColumn(
        "j", F.explode(F.expr("sequence(0L, per - 1)")))
    taken = each.select("length", (F.col("rank") + F.col("k") * F.col("per") + F.col("j")).alias("rank"),
                        (F.col("first") + F.col("k")).alias("sequence_id"),
                        (F.col("at") + F.col("j") * F.col("length")).alias("offset"))
    ranked = running(found, ["length"], ["key", "piece", "tie"], F.lit(1).cast("bigint"),
                     cells(max(counts.values(), default=1)), "rank")
    # both sides grow with the pieces; the planner sees only the few rows that the slots are unfolded from
    return ranked.join(taken.hint("merge"), ["length", "rank"])


def pack(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", size: int = SIZE,
         end_id: int = END_ID) -> DataFrame:
    """``key``, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A null text is empty: its only token is the end.  Added tokens of the file, such as ``<|endoftext|>``, have their own
    id wherever a text holds them, as by the tokenizers library.  Repeated rows are packed each by itself, null ids stay null,
    other columns are not read; an empty table gives no rows.  Rows alike in id, piece and ids may swap their places.
    """
    kind = dict(docs.dtypes)[key]
    found = stage(pieces(docs, path, pattern, key, text, size, end_id), "pieces")
    return place(found, size).select(F.col("key").cast(kind).alias(key), "piece", "start", "length", "ids_crc32",
                                     "sequence_id", "offset")
