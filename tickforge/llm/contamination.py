"""Benchmark decontamination: windows of test items in one Aho-Corasick automaton, every text scanned once.

Texts are normalised bytewise: ASCII capitals become small, everything that is no word byte becomes a blank.  That keeps
the length, so a word's place in the normalised text is its place in the original.  An item's windows are its runs of
``words`` words (an item with fewer is one window).  All windows go into one automaton, which reads each document once,
row-locally, without a shuffle.  An automaton takes windows of at most ``WINDOW_CHARS`` characters with their items;
a benchmark beyond that is dealt by hash over several, one after the other, with the rows stored between them.
"""

from __future__ import annotations

import itertools
from bisect import bisect_right

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickforge.llm.common import NORMAL, word_list
from tickforge.session import stage

WORDS = 10
#: Characters of windows and item ids in one automaton, about 45 bytes of memory each.
WINDOW_CHARS = 2_000_000

SPANS = "array<struct<start:bigint,end:bigint>>"
_STATE = f"key string, text string, n_words bigint, runs array<bigint>, items array<string>, spans {SPANS}"


def normal_text(words: list[bytes]) -> str:
    """One blank between words and at both ends, so that a window matches whole words only."""
    return (b" " + b" ".join(words) + b" ").decode()


def windows_of(text: str | None, words: int) -> set[str]:
    found = word_list(text)
    if not found:
        return set()
    return {normal_text(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def item_windows(items: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """Distinct (window, item): item is the id as text."""
    def run(batches):
        for batch in batches:
            pairs = [(w, k) for k, t in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True)
                     for w in windows_of(t, words)]
            yield pa.RecordBatch.from_pydict({"window": pa.array([p[0] for p in pairs], pa.string()),
                                              "item": pa.array([p[1] for p in pairs], pa.string())})
    rows = items.select(F.col(f"`{key}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "window string, item string").distinct()


class Scanner:
    """The automaton over ``pairs`` of window and item."""

    def __init__(self, pairs):
        self.items: list[tuple[str, ...]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for window, group in itertools.groupby(sorted(pairs, key=lambda p: p[0]), key=lambda p: p[0]):
            self.automaton.add_word(window, (len(self.items), window.count(" ") - 1))
            self.items.append(tuple(item for _, item in group if item is not None))
        self.automaton.make_automaton()
        self._seen: dict[frozenset, tuple[str, ...]] = {}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], tuple[str, ...]]:
        """Runs [first, last] of hit words, joined and in order, and the items whose windows occur."""
        found = list(self.automaton.iter(normal_text(words))) if self.items else []
        if not found:
            return [], ()
        ends = list(itertools.accumulate(len(w.decode()) + 1 for w in words))     # place of the blank behind each word
        runs = []
        for end, (_, size) in found:
            last = bisect_right(ends, end) - 1
            runs.append((last - size + 1, last))
        return joined(runs), self._items(frozenset(number for _, (number, _) in found))

    def _items(self, windows: frozenset) -> tuple[str, ...]:
        """Copies of a document share their windows: the last answers are kept."""
        if windows not in self._seen:
            if len(self._seen) >= 256:
                self._seen.clear()
            self._seen[windows] = tuple(sorted(set().union(*(self.items[w] for w in windows))))
        return self._seen[windows]


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjacent runs as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def original_spans(text: str, words: list[bytes], runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code points of the original text, end exclusive."""
    normal, places, at = text.encode().translate(NORMAL), [], 0
    for word in words:
        at = normal.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    raw, out, seen, points = text.encode(), [], 0, 0
    for first, last in runs:
        start = points + len(raw[seen:places[first][0]].decode())
        end = start + len(raw[places[first][0]:places[last][1]].decode())
        out.append({"start": start, "end": end})
        seen, points = places[last][1], end
    return out


def _pass(pairs):
    """One automaton over rows that may hold the runs and items of earlier ones."""
    def run(batches):
        scanner = Scanner(pairs)
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            old = zip(columns["runs"], columns["items"], strict=True) if "runs" in columns else itertools.repeat(((), ()))
            counts, runs_out, items_out, spans = [], [], [], []
            for text, (had, had_items) in zip(columns["text"], old):
                words = word_list(text)
                runs, items = scanner.scan(words)
                if had:
                    runs = joined([*runs, *zip(had[::2], had[1::2])])
                counts.append(len(words))
                runs_out.append(list(itertools.chain.from_iterable(runs)))
                items_out.append(sorted({*items, *had_items}))
                spans.append(original_spans(text, words, runs) if runs else [])
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("text"), pa.array(counts, pa.int64()),
                pa.array(runs_out, pa.list_(pa.int64())), pa.array(items_out, pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ], names=["key", "text", "n_words", "runs", "items", "spans"])
    return run


def contaminated(documents: DataFrame, items: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", window_chars: int = WINDOW_CHARS) -> DataFrame:
    """Per document row: ``key``, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    A word inside any occurrence of a window is hit; ``items`` are the ids (as text, sorted) of items with occurring
    windows, ``spans`` the hit passages as code points of the original text.  A null or empty text, or one without a
    word, has no words and no hits.  Items without a word, or with a null text, have no windows; the windows of items
    with a null id hit words but name no item.  Repeated document rows each give a row; items that share an id count
    once.  An empty table of items hits nothing; an empty table of documents gives no rows.  Other columns are not read.
    """
    windows = stage(item_windows(items, words, item_key, item_text), "windows")
    size = windows.agg(F.sum(F.char_length("window") + F.coalesce(F.char_length("item"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-size // window_chars))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    kind = documents.schema[key].dataType
    rows = documents.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    for block in range(blocks):
        # at most about window_chars characters, whatever the size of the benchmark
        pairs = [tuple(p) for p in dealt.where(F.col("block") == block).select("window", "item").collect()]
        rows = rows.mapInArrow(_pass(pairs), _STATE)
        if block + 1 < blocks:
            rows = stage(rows, "scanned")
    n_hit = F.expr("aggregate(sequence(0, size(runs) - 2, 2), 0L, (n, i) -> n + runs[i + 1] - runs[i] + 1)")
    return rows.select(
        F.col("key").cast(kind).alias(key), "n_words",
        F.when(F.size("runs") > 0, n_hit).otherwise(F.lit(0).cast("bigint")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"), "items", "spans")
