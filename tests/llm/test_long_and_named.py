"""Pages whose containers bear misleading names, and very long inputs."""

import time

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from tickforge.llm import main_text, packing, topk_search

PARAGRAPHS = [f"Paragraph {i} of this article goes on for quite a while, with many words and no links in it." for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("attribute", [
    *(f"class='{c}'" for c in ("has-sidebar", "no-sidebar", "with-sidebar content-area", "header-fixed", "navbar-offset",
                               "ad-free", "alert-free", "search-results", "social-studies", "content-sidebar")),
    "id='comments-off'"])
def test_an_article_stays_whatever_its_container_is_called(attribute):
    menu = "<ul class='menu'><li><a>Home</a></li><li><a>News</a></li></ul>"
    page = f"<html><body>{menu}<div {attribute}>{BODY}<div class='ad-slot'>Buy now</div></div></body></html>"
    assert main_text.extract(page).split("\n\n") == PARAGRAPHS
    assert main_text.extract(f"<article><div class='entry {attribute[7:-1]}'>{BODY}</div></article>").split("\n\n") == PARAGRAPHS


@pytest.mark.parametrize("name", ["comments", "post-comments", "comment-list", "sidebar", "site-footer", "cookie-banner",
                                  "ad-slot", "share-buttons"])
def test_marked_parts_go(name):
    page = f"<body><div class='post'>{BODY}</div><div class='{name}'><p>A remark that is quite as long as any line above it.</p></div>"
    assert main_text.extract(page).split("\n\n") == PARAGRAPHS


@pytest.mark.parametrize("piece", ["<span><p>word word</p>", "<b></i>x", "<div><p>words words", "<p><i>a</i><div>b c d</div>"])
def test_unclosed_elements_take_time_in_proportion(piece):
    start = time.process_time()
    main_text.extract("<article>" + piece * 16_000)
    assert time.process_time() - start < 8      # a quadratic walk takes minutes


@pytest.mark.parametrize("space", [" ", "\n", "\t", " "])
def test_long_white_space_gives_the_library_ids(space):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model, library = packing.tokenizer(path, public_tokenizers.PATTERN), tokenizers.Tokenizer.from_file(path)
    n = packing.LONG_SPACE
    for text in (space * n, f"a b{space * n}c {space * (n + 1)}", f"x{space * n}<|endoftext|>{space * (n + 7)}. y", f"a{space * (n - 1)}b"):
        assert packing.encode(model, text) == library.encode(text, add_special_tokens=False).ids


def test_two_million_blanks():
    model = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "start" + " " * 2_000_000 + "end"
    assert packing.encode(model, text) == library.encode(text, add_special_tokens=False).ids


def test_products_are_exact_at_any_size(spark):
    big = {0: [6000.0] * 64, 1: [6000.0] * 64, 2: [-1e5] * 64, 3: [1e5, -1e5] * 32, 4: [3.5] * 64, 5: [1e-9] * 64, 100: [1e5] * 64}
    df = spark.createDataFrame(list(big.items()), "vec_id bigint, embedding array<double>")
    got = {}
    for r in topk_search.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {k: [int(np.floor(1024 * x)) for x in v] for k, v in big.items()}
    for q in (0, 100):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in big if c != q)
        assert sorted(got[q]) == [(i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    with pytest.raises(OverflowError, match="64 bits"):
        topk_search.products(np.full((1, 4), 2.0 ** 40), np.full((1, 4), 2.0 ** 40))


def test_ties_at_the_last_rank_fall_to_smaller_ids():
    c = np.ones((9, 2))
    at, ids, scores = topk_search.best_of(np.array([7]), np.ones((1, 2)), np.arange(9), c, 3)
    assert list(at) == [0, 0, 0] and list(ids) == [0, 1, 2] and set(scores) == {2}
