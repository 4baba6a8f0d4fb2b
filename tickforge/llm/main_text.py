"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, threshold clustering.

The standard library's streaming parser feeds a page into lines: a line is the text of one block element, with the
number of tags met since the line before.  Lines inside parts that are never an article (menus, page headers, footers,
sidebars, notices, adverts, forms, comments, scripts, styles) have ratio 0.  The ratios are smoothed with a Gaussian
and clustered in two by a threshold.  The text is, in page order and without excluded parts: every line of the upper
cluster (content); every line of an article or main element that holds such a line, and headings right before one; and
every line of the smallest container that holds all content outside those elements, unless that content is less than
half of all.  So short lines between long ones stay, as the smoothing and the regions decide, not a line's own length.
Several articles of a page are all kept.

Names are weak evidence: a class like ``sidebar`` or ``post-comments`` excludes its part, one that says the opposite
(``no-sidebar``, ``header-fixed``) does not, and one that merely holds such a word (``navbar-offset``, ``search-results``)
does unless the part holds more than half of what the clustering calls content.

One page is one row's work, in time proportional to its length: rows are handled where they lie, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown, or never an article's.
EXCLUDED = frozenset("script style noscript template head title nav footer aside form button select textarea option "
                     "iframe svg canvas object audio video dialog menu label fieldset".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
CONTAINER = frozenset("article main section div body td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold others.  Ids of all others are often slugs of their text, such as <h2 id="related-work">.
PARTS = CONTAINER | frozenset("ul ol dl table".split())
#: Words of a class, id or role that mark a part as no article.  In an article, only class and role of ``PARTS`` count;
#: outside, ids of ``PARTS`` do, too, and class and role of any element.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsored sponsor promo promotion sidebar "
                  "nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments respond "
                  "replies reply disqus cookie cookies consent notice notices gdpr newsletter subscribe subscription "
                  "signup login share sharing social related recommended popup modal overlay toolbar widget skip "
                  "complementary contentinfo search pagination pager alert disclaimer announcement".split())
#: Beginnings of such words.
MARK_STARTS = ("comment", "sidebar", "advert", "cookie", "newsletter", "breadcrumb", "sponsor", "subscri")
#: Marks that an article's own parts may bear, too.
OWN_MARKS = frozenset({"header", "masthead", "banner"})
#: Parts of a name that turn its meaning round, and parts by which a name is that of a layout.
MODIFIERS = frozenset("has no not non with without free fixed off on offset enabled disabled hide hidden".split())
LAYOUT = frozenset("content main layout page wrap wrapper container body site article".split())
_PART = re.compile(r"[^a-z0-9]+")
NONE, WEAK, STRONG = 0, 1, 2
#: An open element of these ends where a new block of the given kinds begins.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
          "th": {"td", "th", "tr"}, "option": {"option"}}
_SPACES = re.compile(r"\s+")
SIGMA = 1.0


def name_mark(name: str, marks: frozenset[str] = MARKS) -> int:
    """What one word of a class, id or role says: STRONG as a whole, by its last part or its beginning; WEAK by another
    part, or beside a word for layout; NONE otherwise, and with a part that turns it round."""
    parts = [p for p in _PART.split(name) if p]
    if not parts or not MODIFIERS.isdisjoint(parts) and len(parts) > 1:
        return NONE
    if len(parts) > 1 and not LAYOUT.isdisjoint(parts):
        return NONE if marks.isdisjoint(parts) and not name.startswith(MARK_STARTS) else WEAK
    if parts[-1] in marks or name.startswith(MARK_STARTS):
        return STRONG
    return NONE if marks.isdisjoint(parts) else WEAK


def _marked(tag: str, attrs: list, inside: bool) -> int:
    """Attributes that hide an element or name it as no article.  ``inside``: in an article."""
    found = NONE
    for k, v in attrs:
        v = (v or "").lower()
        named = k in ("class", "role") and (tag in PARTS or not inside) or k == "id" and tag in PARTS and not inside
        if named and tag not in ("html", "body", "main"):
            words = v.split()
            if tag == "article":
                words = [w for w in words if any(p.startswith("comment") for p in _PART.split(w))]
            marks = MARKS - OWN_MARKS if inside else MARKS
            found = max([found, *(name_mark(w, marks) for w in words)])
        if k == "hidden" or (k == "aria-hidden" and v == "true") or (
                k == "style" and "display:none" in v.replace(" ", "")):
            return STRONG
    return found


class _Lines(HTMLParser):
    """Lines of a page: (text, tags, excluded, container, weak part)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []    # name, excluded, innermost container, innermost weak part
        self.blocks: list[int] = []         # places of block elements in ``open``
        self.count: Counter[str] = Counter()    # open elements by name
        self.lines: list[tuple[str, int, bool, int, int]] = []
        self.names, self.above = ["body"], [0]      # containers, in page order: their names, and those around them
        self.weak = [0]                     # weak parts: those around them
        self.headings: set[int] = set()     # numbers of lines
        self.parts: list[str] = []
        self.hidden = False
        self.tags = 0

    def _at(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, 0)

    def _close(self, place: int) -> None:
        """End the open elements from ``place`` on."""
        for name, *_ in self.open[place:]:
            self.count[name] -= 1
        del self.open[place:]
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def end_line(self) -> None:
        text = _SPACES.sub(" ", "".join(self.parts)).strip()
        if text or self.hidden:
            _, container, weak = self._at()
            if any(self.count[name] for name in HEADINGS):
                self.headings.add(len(self.lines))
            self.lines.append((text, self.tags, not text, container, weak))
            self.tags, self.hidden = 0, False
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.end_line()
            # a block inside inline elements of an unclosed paragraph ends the paragraph too
            if self.blocks and tag in CLOSES.get(self.open[self.blocks[-1]][0], ()):
                self._close(self.blocks[-1])
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        excluded, container, weak = self._at()
        excluded = excluded or tag in EXCLUDED
        if not excluded and (attrs or tag == "header"):
            inside = bool(self.count["article"] or self.count["main"])
            mark = STRONG if tag == "header" and not inside else _marked(tag, attrs, inside)
            if mark == WEAK and tag in BLOCK:
                self.weak.append(weak)
                weak = len(self.weak) - 1
            else:
                excluded = mark != NONE
        if tag in CONTAINER:
            self.names.append(tag)
            self.above.append(container)
            container = len(self.names) - 1
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append((tag, excluded, container, weak))
        self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
        if not self.count[tag]:
            return      # a stray end
        if tag in BLOCK:
            self.end_line()
        self.tags += 1
        place = len(self.open) - 1
        while self.open[place][0] != tag:
            place -= 1
        self._close(place)

    def handle_data(self, data):
        if self._at()[0]:
            self.hidden = self.hidden or not data.isspace()
        else:
            self.parts.append(data)


def _smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(x)), kernel, mode="full")[reach:reach + len(x)]
    return np.convolve(x, kernel, mode="full")[reach:reach + len(x)] / weight


def _threshold(x: np.ndarray) -> float:
    """Between the two clusters of values that are nearest their own means."""
    cut = float(x.mean())
    for _ in range(20):
        low, high = x[x <= cut], x[x > cut]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = float(new)
    return cut


def _clustered(lines: list, sigma: float) -> np.ndarray:
    """Which lines are content."""
    ratio = np.array([0.0 if excluded else len(text) / max(1, tags) for text, tags, excluded, *_ in lines])
    smooth = _smooth(np.log1p(ratio), sigma)
    return smooth > _threshold(smooth) if len(lines) > 1 else np.ones(1, dtype=bool)


def _weighed(page: _Lines, sigma: float) -> list:
    """The page's lines, excluded where a weakly marked part holds no more than half of the content."""
    if len(page.weak) == 1:
        return page.lines
    content, held = _clustered(page.lines, sigma), [0] * len(page.weak)
    for line, good in zip(page.lines, content, strict=True):
        held[line[4]] += len(line[0]) if good else 0
    for part in range(len(held) - 1, 0, -1):        # a part is numbered after those around it
        held[page.weak[part]] += held[part]
    out = [False] * len(held)
    for part in range(1, len(held)):
        out[part] = out[page.weak[part]] or 2 * held[part] <= held[0]
    return [("", tags, True, container, 0) if out[weak] else (text, tags, excluded, container, weak)
            for text, tags, excluded, container, weak in page.lines]


def _around(page: _Lines, a: int, b: int) -> int:
    """The smallest container around two; numbers grow inwards."""
    while a != b:
        a, b = (page.above[a], b) if a > b else (a, page.above[b])
    return a


def extract(html: str | None, sigma: float = SIGMA) -> str:
    """Main text of one page; empty for a null, empty or text-free page."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.end_line()
    lines = _weighed(page, sigma)
    kept = [k for k, line in enumerate(lines) if not line[2]]
    if not kept:
        return ""
    content = _clustered(lines, sigma)
    chosen = [k for k in kept if content[k] or len(kept) == 1]
    if not chosen:
        return "\n\n".join(lines[k][0] for k in kept)
    # articles with content, and the smallest container of the content outside of them
    of_article = [False] * len(page.names)      # by container
    for n in range(1, len(page.names)):
        of_article[n] = page.names[n] in ("article", "main") or of_article[page.above[n]]
    region, seen = [False] * len(page.names), [False] * len(page.names)
    for k in chosen:
        n = lines[k][3]
        while of_article[n] and not seen[n]:
            seen[n], region[n] = True, page.names[n] in ("article", "main")
            n = page.above[n]
    outside = [k for k in chosen if not of_article[lines[k][3]]]
    if outside and 2 * sum(len(lines[k][0]) for k in outside) >= sum(len(lines[k][0]) for k in chosen):
        found = [lines[k][3] for k in outside]
        region[_around(page, min(found), max(found))] = True    # of all, as containers are numbered in page order
    for n in range(1, len(page.names)):
        region[n] = region[n] or region[page.above[n]]
    text, taken = [], False
    for k in reversed(kept):
        taken = content[k] or region[lines[k][3]] or (taken and k in page.headings)
        if taken:
            text.append(lines[k][0])
    return "\n\n".join(reversed(text))


def _pages(sigma: float):
    def run(batches):
        for pdf in batches:
            pdf["text"] = [extract(h, sigma) for h in pdf["html"]]
            pdf["n_chars"] = [len(t) for t in pdf["text"]]
            yield pdf[["key", "url", "text", "n_chars"]]
    return run


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
              sigma: float = SIGMA) -> DataFrame:
    """``key``, ``url``, text, n_chars of every page.

    A null or empty page, or one without text, gives an empty text; null ids and urls stay null, repeated rows stay
    repeated; other columns are not read.  A page that ends in mid-tag is read as far as it goes.
    """
    kind = dict(pages.dtypes)[key]
    out = pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"),
                       F.col(html).alias("html")).mapInPandas(
        _pages(sigma), "key string, url string, text string, n_chars bigint")
    return out.select(F.col("key").cast(kind).alias(key), F.col("url").alias(url), "text", "n_chars")
