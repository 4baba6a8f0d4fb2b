"""Lexicon scoring of news text."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from tickforge import settings
from tickforge.functions.market import three_way
from tickforge.functions.numbers import round_exact

#: A word is a run of characters outside Unicode white space and the four separator
#: controls (the set Python's ``str.split`` uses).  Possessive, so nothing is retried.
WORD = r"(?U)[^\s\x1c-\x1f]++"


def article_text(title: Column, description: Column) -> Column:
    """Title and description joined by a blank; a missing part reads as the word "None"."""
    return F.concat_ws(" ", F.coalesce(title, F.lit("None")), F.coalesce(description, F.lit("None")))


def distinct_hits(lowered: Column, vocabulary: list[str]) -> Column:
    """How many terms occur in the text as substrings; each term counts once."""
    return reduce(add, [F.contains(lowered, F.lit(t)).cast("bigint") for t in vocabulary])


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def lexicon_score(positive: Column, negative: Column, words: Column) -> Column:
    """Net hits per ten words, to 4 places, clamped to [-1, 1]; 0 for an empty text."""
    raw = F.coalesce(round_exact(F.try_divide(positive - negative, words * F.lit(0.1)), 4), F.lit(0.0))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw))


def lexicon_label(score: Column, cutoff: float = settings.LABEL_CUTOFF) -> Column:
    return three_way(score, cutoff, -cutoff, "positive", "negative", "neutral")
