"""Ranked search, decontamination and spelling variants against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import DOCS, clashing, docs, odd, odd_rows, rows, sentence
from tickforge.llm import contamination, dual_tree, spelling
from tickforge.llm.common import prepare

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def words(text):
    return [] if text is None else WORD.findall(text.translate(LOWER))


def odd_items(r):
    base = [(t, k) for k, t, *_ in odd_rows() if t and len(t) > 100]
    return [(1, " ".join(words(base[0][0])[5:25])), (2, "The Stone"), (2, "river, GREEN"), (3, None), (4, ""), (5, "..."),
            (None, sentence(r, 12)), (6, " ".join(words(base[0][0])[:10])), (6, " ".join(words(base[0][0])[:10])),
            (7, "gęślą jaźń"), (8, "x" * 50_000), (9, sentence(r, 300))]


# ----------------------------------------------------------------- decontamination

def hits(documents, items, size=10):
    out = []
    wins = [(i, tuple(w[p:p + size])) for i, t in items for w in [words(t)] if w for p in range(max(1, len(w) - size + 1))]
    for key, text, *_ in documents:
        w, hit, named = words(text), set(), set()
        for i, v in wins:
            for p in range(len(w) - len(v) + 1):
                if tuple(w[p:p + len(v)]) == v:
                    hit.update(range(p, p + len(v)))
                    named.add(i)
        ids = sorted(str(i) for i in named if i is not None)
        out.append((key, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def short_odd_rows():
    return [(k, t if t is None or len(t) < 90_000 else t[:20_000], *rest) for k, t, *rest in odd_rows()]


@pytest.mark.parametrize("chars", [2_000_000, 900])
def test_windows_in_documents(spark, chars):
    r = random.Random(2)
    items = odd_items(r)
    documents = [*short_odd_rows(), (20, "so THE-stoneé the stone! " + sentence(r, 30)),
                 (21, "\U0001F600 " + items[0][1].upper() + " end"), (22, " ".join(words(items[0][1])[:9]))]
    got = contamination.contaminated(clashing(docs(spark, documents)), clashing(spark.createDataFrame(items, ITEMS)),
                                     window_chars=chars)
    assert rows(got.drop("items", "spans")) == hits(documents, items)


def test_spans_are_places_in_the_original(spark):
    text = "\U0001F600 Ünder, THE  (stone)\triver, é; the stone river"
    got = contamination.contaminated(docs(spark, [(1, text)]), spark.createDataFrame([(5, "the stone river")], ITEMS)).first()
    assert [text[s.start:s.end] for s in got.spans] == ["THE  (stone)\triver", "the stone river"]
    assert got.items == ["5"] and got.n_hit == 6


def test_decontamination_without_rows(spark):
    none, some = spark.createDataFrame([], ITEMS), docs(spark, [(1, "a b")])
    assert rows(contamination.contaminated(some, none).select("doc_id", "n_hit", "contaminated")) == [(1, 0, False)]
    assert contamination.contaminated(spark.createDataFrame([], DOCS), none).count() == 0


# ----------------------------------------------------------------- ranked search

def ranking(documents, items, k=10):
    found = [(key, Counter(words(text))) for key, text, *_ in documents]
    found = [(key, tf, sum(tf.values())) for key, tf in found if tf]
    n_docs, n_words = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, tf, _ in found for t in tf)
    out = []
    for item, text in set(items):
        scored = []
        for key, tf, n in found:
            m = 100 - 90 + 90 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(words(text)) if t in tf)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chars", "cells", "run"), [(2_000_000, 8_000_000, 1024), (60_000, 400, 40)])
def test_search_against_all_scores(spark, monkeypatch, chars, cells, run):
    r = random.Random(6)
    items = odd_items(r) + [(100 + i, sentence(r, r.randrange(1, 9))) for i in range(30)]
    documents = [*odd_rows(), *[(1000 + i, sentence(r, r.randrange(1, 60))) for i in range(300)],
                 *[(3000 - i, "green tower sings") for i in range(40)]]
    monkeypatch.setattr(dual_tree, "CELLS", cells)
    monkeypatch.setattr(dual_tree, "RUN_DOCS", run)
    got = dual_tree.search(clashing(docs(spark, documents)), clashing(spark.createDataFrame(items, ITEMS)), item_chars=chars)
    assert rows(got) == ranking(documents, items)


def test_bounds_prune_without_loss():
    r, rng = random.Random(8), np.random.default_rng(8)
    topics = [[rng.integers(t * 40, t * 40 + 40) for _ in range(400)] for t in range(20)]
    weights = rng.integers(1, 9000, 800)
    documents = []
    for i in range(1000):
        found = np.unique(r.choices(topics[i % 20], k=12))
        documents.append((i, int(rng.integers(10, 90)), found, rng.integers(1, 5, len(found))))
    items = [np.unique(r.choices(topics[i % 20], k=6)) for i in range(60)]
    tree = dual_tree.DocumentTree(documents, weights, 1000, 50_000)
    order, best = dual_tree.ItemTree(items, weights), dual_tree.Best(60, 10)
    assert dual_tree.walk(tree, order, best) < 1000 * 60 / 3
    for place, item in enumerate(order.order):
        scores = tree.levels[0][tree.rows_of(items[item])].sum(axis=0)[:1000]
        top = sorted(zip(-scores, tree.ids, strict=True))[:10]
        assert [(-s, i) for s, i in top if s < 0] == list(zip(best.scores[place], best.ids[place], strict=True))


def test_search_without_rows(spark):
    none, some = spark.createDataFrame([], ITEMS), docs(spark, [(1, "a b")])
    assert dual_tree.search(some, none).count() == 0
    assert dual_tree.search(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert dual_tree.search(some, spark.createDataFrame([(1, "c")], ITEMS)).count() == 0


# ----------------------------------------------------------------- spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def spelled(documents):
    counts = Counter()
    for key, text, *_ in documents:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def misspelled(seed, n_docs):
    r = random.Random(seed)
    stems = ["tower", "éclairè", "STRANGE", "überall", "moving", "aaaaaaa", "a×b÷cde", "ÀÉÎõü", "internationalisation"]
    base = ["".join(r.choice(stems)[:r.randrange(2, 9)] for _ in range(r.randrange(1, 4))) for _ in range(60)]

    def noisy(w):
        i = r.randrange(len(w))
        return r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abé") + w[i:], w[:i] + r.choice("xyÿ") + w[i + 1:]])
    pool = base * 12 + [noisy(w) for w in base for _ in range(5)]
    return [(i, r.choice([" ", "-", "ł", "Ā"]).join(r.choice(pool) for _ in range(r.randrange(1, 120))))
            for i in range(n_docs)]


@pytest.mark.parametrize(("longest", "frequent"), [(4, 50), (4, 0), (2, 0), (6, 3)])
def test_variants_against_all_pairs(spark, longest, frequent):
    documents = misspelled(longest, 150) + [(7, "Ægidius ægidius"), (7, "ß" * 6 + " " + "ß" * 7)] * 6
    got = spelling.variants(docs(spark, documents), longest=longest, frequent=frequent)
    want = spelled(documents)
    assert len(want) > 150 and sum(w[1] is not None for w in want) > 20
    assert rows(got) == want


def test_an_edit_leaves_unaffected_grams():
    r = random.Random(5)
    pool = ["".join(r.choice("abcé") for _ in range(r.randrange(6, 12))) for _ in range(400)]
    counts = Counter(m[p:p + q] for w in pool for m in ["\x01" + w + "\x02"] for q in range(2, 5) for p in range(len(m) - q + 1))
    for frequent in (0, 20, 90):
        grams = {g: c for g, c in counts.items() if len(g) == 2 or counts[g[:-1]] > frequent}
        assert max(map(len, grams)) == 4 if frequent < 90 else True

        def parts(word):
            return spelling.decomposed("\x01" + word + "\x02", grams, 4, frequent)

        for w in pool:
            i = r.randrange(len(w))
            for other, shift in ((w[:i] + "z" + w[i + 1:], 0), (w[:i] + w[i + 1:], -1), (w[:i] + r.choice("abcéz") + w[i:], 1)):
                theirs = {(g, p) for g, p, _ in parts(other)}
                if shift == 1:      # between the characters i and i + 1 of the marked word
                    before, behind = [e for e in parts(w) if e[2] <= i + 1], [e for e in parts(w) if e[1] >= i + 1]
                else:
                    before, behind = [e for e in parts(w) if e[2] <= i + 1], [e for e in parts(w) if e[1] > i + 1]
                assert {(g, p) for g, p, _ in before} | {(g, p + shift) for g, p, _ in behind} <= theirs
                assert set(spelling.index_keys(w, grams, 4, frequent)) & set(spelling.index_keys(other, grams, 4, frequent))


def test_a_dictionary_too_large_is_pruned_harder(spark):
    words = spark.createDataFrame([(w,) for w in {"".join(random.Random(i).choices("abcd", k=7)) for i in range(500)}],
                                  "word string")
    grams, frequent = spelling.dictionary(words, longest=4, frequent=0, most=60)
    assert frequent > 0 and sum(len(g) > 2 for g in grams) <= 60 and sum(len(g) == 2 for g in grams) >= 16


def test_variants_of_odd_rows(spark):
    assert rows(spelling.variants(odd(spark))) == spelled(odd_rows())
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="longest gram"):
        spelling.variants(odd(spark), shortest=3)
    unknown = docs(spark, [(None, "wonderful " * 5), (1, None)])
    assert rows(spelling.variants(unknown).select("word", "n")) in ([("wonderful", 5)], [])
    assert rows(clashing(unknown).transform(lambda d: spelling.variants(d)).select(F.count("*"))) in ([(1,)], [(0,)])
