"""Small tables in the shape of the test data, with the odd rows that every operator must stand."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHING = "key, at, label, print, size, rank, tie, row, index, word, block, node, cell, run, html, captured".split(", ")


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING) if c not in df.columns])


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(["the", "stone", "river", "a", "green", "of", "light", "tower", "moves", "and", "slowly",
                              "old", "bird", "sings", "far"]) + r.choice(["", "", "", "s", "er"]) for _ in range(n))


def odd_rows():
    """Null ids and texts, empty, blank and very long texts, repeated rows, one word, a null source."""
    r = random.Random(4)
    plain = sentence(r, 60)
    return [(1, plain, "src0"), (1, plain, "src0"), (2, None, "src0"), (3, "", None), (4, " \t\n ", None),
            (5, sentence(r, 30_000), "src1"), (6, "x" * 50_000, "src1"), (7, plain, "src2"), (None, plain, None),
            (None, None, None), (8, "word", "src2"), (9, sentence(r, 80), "src1"), (9, sentence(r, 50), None),
            (10, "Zażółć\x1cgęślą jaźń \U0001F600 naïve\x85x", "src1")]


def odd(spark):
    return clashing(docs(spark, odd_rows()))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
