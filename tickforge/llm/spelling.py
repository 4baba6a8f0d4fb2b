"""Spelling variants: words one edit apart, found with a variable-length gram index.

1. Every task counts the words of its texts; the counts are summed by word.
2. Gram dictionary: all grams of two characters, and longer ones (to ``LONGEST``) as long as the gram one shorter is
   frequent among the words; rare grams are not extended.  Words carry a mark at both ends.
3. A word is decomposed into one gram per place, the longest that the dictionary holds there.  Which gram that is, is
   decided by the characters read at the place; one edit can change the grams only of those places that read the edited
   character.  So every place of an edit has its affected grams; all others are in the lists of both words, those before
   it at the same place from the start, those behind it at the same place from the end.
4. For every place the lists of all unaffected grams are merged: a word's entry in the merged list is what it has before
   the affected grams and behind them, one key.  Two words one edit apart meet in the list of that edit.
5. A join brings the entries of a list together; its condition verifies the distance, and near pairs are all it keeps.

Words that meet agree in all but fewer than two gram lengths around one place, so lists stay short however many words
share a gram.  No list is gathered in a task: the join sorts, and adaptive execution may split it.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickforge.session import stage

SHORTEST, LONGEST = 2, 4
#: A gram that occurs this often among the words is extended.
FREQUENT = 50
#: Most grams of a dictionary, which every task holds; the frequency that extends one is doubled until they fit.
DICTIONARY_GRAMS = 200_000
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000
START, END = "\x01", "\x02"

_LETTERS = frozenset([*range(0x61, 0x7B), *range(0xC0, 0x100)])
#: Latin-1: small letters for ASCII capitals, blanks for all that is no letter.
LETTERS = bytes(b if b in _LETTERS else 0x20 for b in bytes(range(256)).lower())


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0-U+00FF in Latin-1; other characters beyond it become question marks."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def altered(run: bytes, seed: int, modulus: int) -> bytes:
    """The run, without one of its code points if its check sum says so; ``seed`` is that of the text before it."""
    mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if mark % modulus:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1:]


def _counts(shortest: int, modulus: int):
    def emit(found: Counter):
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in found], pa.string()),
                                           "n": pa.array(list(found.values()), pa.int64())})

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                if text is None:
                    continue
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(w for w in runs_of(text) if len(w) >= shortest).items():
                    found[altered(word, seed, modulus)] += n
                if len(found) > COUNTED:
                    yield emit(found)
                    found = Counter()
        yield emit(found)
    return run


def vocabulary(documents: DataFrame, shortest: int = 6, least: int = 5, modulus: int = 199, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """word, n: the words of at least ``shortest`` code points that occur at least ``least`` times."""
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    counted = rows.mapInArrow(_counts(shortest, modulus), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.char_length("word") >= shortest) & (F.col("n") >= least))


def gram_counts(words: DataFrame, longest: int) -> DataFrame:
    """gram, n, parent_n: substrings of the marked words, how many there are, and how many of the gram one shorter."""
    marked = words.select(F.concat(F.lit(START), "word", F.lit(END)).alias("s"))
    length = F.char_length("s")
    per_size = [marked.select(F.explode(F.transform(F.sequence(F.lit(1), length - (q - 1)),
                                                    lambda p, q=q: F.substring("s", p, F.lit(q)))).alias("gram"))
                for q in range(SHORTEST, longest + 1)]
    grams = per_size[0]
    for more in per_size[1:]:
        grams = grams.union(more)
    counted = stage(grams.groupBy("gram").agg(F.count("*").alias("n")), "grams")
    parents = counted.select(F.col("gram").alias("parent"), F.col("n").alias("parent_n"))
    return counted.withColumn("parent", F.expr("substring(gram, 1, char_length(gram) - 1)")).join(
        parents, "parent", "left").select("gram", "n", "parent_n")


def dictionary(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT,
               most: int = DICTIONARY_GRAMS) -> tuple[dict[str, int], int]:
    """Grams with their frequency, and the frequency beyond which one is extended.

    Grams of two letters number at most 94^2; the others are kept below ``most`` by the frequency, whatever the words.
    """
    grams = stage(gram_counts(words, longest), "gram-counts")
    while grams.where(F.col("parent_n") > frequent).count() > most:
        frequent = max(1, 2 * frequent)
    kept = grams.where((F.char_length("gram") == SHORTEST) | (F.col("parent_n") > frequent))
    return {r.gram: r.n for r in kept.select("gram", "n").collect()}, frequent


def decomposed(marked: str, grams: dict[str, int], longest: int, frequent: int) -> list[tuple[str, int, int]]:
    """(gram, place, end of the characters read) for every place but the last."""
    out = []
    for p in range(len(marked) - 1):
        q = SHORTEST
        while q < longest and p + q < len(marked) and marked[p:p + q + 1] in grams:
            q += 1
        # the character that ended the search was read, unless no gram could be longer
        known = grams.get(marked[p:p + q], 0)
        read = q + 1 if q < longest and known > frequent else q
        out.append((marked[p:p + q], p, min(p + read, len(marked))))
    return out


def unaffected(parts: list[tuple[str, int, int]], length: int) -> set[tuple[int, int]]:
    """For every edit: up to where the grams before it reach, and where those behind it start.

    A changed or deleted character leaves the places that do not read it, an inserted one also those that end before it
    or start behind it.  No gram before is 0, none behind the length.
    """
    reach = [0] * (length + 1)
    for gram, place, read in parts:
        reach[read] = max(reach[read], place + len(gram))
    for i in range(1, length + 1):
        reach[i] = max(reach[i], reach[i - 1])
    last = length - 2       # the last place with a gram
    changed = {(reach[i], i + 1 if i < last else length) for i in range(1, length - 1)}
    return changed | {(reach[i], i if i <= last else length) for i in range(1, length)}


def index_keys(word: str, grams: dict[str, int], longest: int, frequent: int) -> list[str]:
    """The merged lists that the word is in."""
    marked = START + word + END
    places = unaffected(decomposed(marked, grams, longest, frequent), len(marked))
    return [f"{marked[:left]}|{marked[right:]}" for left, right in places]


def postings(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT) -> DataFrame:
    """key, word, n: the index, one row for every list that a word is in."""
    grams, frequent = dictionary(words, longest, frequent)

    def run(batches):
        for batch in batches:
            keys, at = [], []
            for i, word in enumerate(batch[0].to_pylist()):
                found = index_keys(word, grams, longest, frequent)
                keys.extend(found)
                at.extend([i] * len(found))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch[0].take(at), batch[1].take(at)],
                                             names=["key", "word", "n"])
    return words.select("word", "n").mapInArrow(run, "key string, word string, n bigint").select(
        F.xxhash64("key").alias("key"), "word", "n")


def near_pairs(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT) -> DataFrame:
    """a, a_n, b, b_n: distinct pairs a < b of words that one inserted, deleted or replaced code point parts.

    Words must have at least ``longest`` code points: then no edit affects all grams.
    """
    lists = stage(postings(words, longest, frequent), "postings")
    left = lists.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = lists.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = F.abs(F.char_length("a") - F.char_length("b")) <= 1
    met = left.join(right, "key").where((F.col("a") < F.col("b")) & close & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word with a form: forms are followed until one has none.

    Paths are doubled round by round; a form occurs several times as often as its word, so they are short and never
    close a circle.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stage(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not longer.where("moved").limit(1).count():
            return longer.drop("moved")
        now = longer.drop("moved")


def variants(documents: DataFrame, shortest: int = 6, least: int = 5, modulus: int = 199, factor: int = 5,
             key: str = "doc_id", text: str = "text", longest: int = LONGEST, frequent: int = FREQUENT) -> DataFrame:
    """word, form, root, n, n_near, form_n.

    Words are runs of letters with A-Z lower-cased, of which about one in ``modulus`` loses a code point by a check sum
    of id and run.  ``form`` is the near word of largest n (ties: smallest in code-point order) if that is at least
    ``factor`` times the word's, else null; ``root`` follows forms to the last.  A null or empty text has no words, a
    null id counts as an empty one, repeated rows count again, other columns are not read; no documents give no rows.
    """
    if shortest < longest:
        raise ValueError("words must be at least as long as the longest gram")
    words = stage(vocabulary(documents, shortest, least, modulus, key, text), "words")
    pairs = stage(near_pairs(words, longest, frequent), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias(
        "near_n")).union(pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    formed = stage(best.select("word", "n_near", *[
        F.when(-F.col("best.k") >= factor * F.col("n"), c).alias(name)
        for name, c in (("form", F.col("best.near")), ("form_n", -F.col("best.k")))]), "forms")
    followed = roots(formed.where("form is not null").select("word", "form"))
    return (words.join(formed, "word", "left").join(followed, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))
