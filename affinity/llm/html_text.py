"""Main text of HTML pages from parser events.

The standard library's parser streams tags and data; every block element's
text is a line.  Each line has its text-to-tag ratio (code points of text per
tag on it), smoothed by a Gaussian over neighbouring lines; two-means
clustering of the smoothed ratios gives the threshold that parts content lines
from the rest.  Lines inside menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts and styles never count, whatever their ratio.
A ``head`` ends with the first element that can't be in it, an open menu or
header where an ``article`` or ``main`` begins.

The content region starts from the smallest element that holds nearly all text
of the content lines (the innermost ``article`` or ``main`` with half of it wins).
If lines with the ratio of content of their own (the threshold, or a quarter of
the content's mean) are outside of it, it grows to the least element that holds
them all, or to an ``article`` or ``main`` around
that one.  All lines of the region are taken, short ones too, so that one-word
paragraphs stay; only a region that grew beyond ``article`` and ``main`` loses
the children before its first and behind its last with such a line, other than
headings and paragraphs that touch these.  Headings right before a region that is no ``article`` or
``main`` belong to it.

Class and id names mark what is not the text: outside of ``article`` and ``main`` any of the listed
words, inside of them those of classes and a few ids only (others are made from headings); on headings never.

Defined results: null or empty html, and html without content, give an empty
text; broken markup (unclosed or crossing tags, cut pages) is taken as the
parser reports it; a page is parsed whole, whatever its length; repeated pages
and other columns have no influence; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm.rows import map_texts

# Fixed values of HTML: elements that begin a line, that have no end tag, and whose content is not text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("""head script style noscript template title nav footer aside form button select textarea iframe object svg
    canvas audio video menu dialog""".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
#: Words of class or id names that mark what is not the article.
MARKED = re.compile(r"""(?:^|[-_\s])(?:ad|ads|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|menu\w*|nav|navbar|navigation|topbar|toolbar
    |breadcrumbs?|sidebar\w*|side|aside|footer\w*|foot|masthead|site-?header|page-?header|header|cookies?|consent|gdpr|notice\w*|popup
    |modal|newsletter|subscribe|subscription|signup|login|share\w*|sharing|social\w*|related\w*|recommend\w*|teasers?|pagination|pager
    |comments?|comment-?list|replies|reply|respond|disqus|form|search\w*|widget\w*|copyright|legal|disclaimer|skip-?link|hidden)(?:$|[-_\s])""",
                    re.I | re.X)
#: Ids that mark the same inside an article, where other ids are made from headings.
MARKED_IDS = frozenset("comments comment-list respond disqus_thread sidebar breadcrumbs cookie-notice newsletter".split())
MARK = "#mark"
HOLDERS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD = frozenset("head base link meta title style script noscript template".split())
#: Elements that end where an article or main begins, if they are still open.
ENDED = frozenset("nav header menu button select".split())
#: Elements whose end tag the next one of the same kind implies, and those beyond which it does not.
IMPLIED = frozenset("p li dt dd td th tr option".split())
SCOPES = frozenset("ul ol dl table div section article main body blockquote".split())
#: Elements that hold a line or a list of lines, but never a whole text.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption table tbody thead tr td th caption".split())
#: Children that a region keeps at its edges whatever their ratio.
EDGES = frozenset("p h1 h2 h3 h4 h5 h6".split())


class _Lines(HTMLParser):
    """Lines with their path of open block elements.  Work a tag is constant, whatever is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, str]] = []  # tag, innermost block element, what skips it ("": nothing does)
        self.places: dict[str, list[int]] = {}  # of open elements by tag, and of those that end a search
        self.parent = [-1]
        self.name = [""]
        self.lines: list[tuple[str, int, int]] = []  # text, tags, element
        self.parts: list[str] = []
        self.tags = 0

    @property
    def element(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    @property
    def skipped_by(self) -> str:
        return self.stack[-1][2] if self.stack else ""

    def last(self, kind: str) -> int:
        """Place in the stack of the innermost open element of that tag or kind; -1 for none."""
        places = self.places.get(kind)
        return places[-1] if places else -1

    def kinds(self, tag: str) -> tuple[str, ...]:
        return (tag, *[k for k, tags in (("#block", BLOCKS), ("#scope", SCOPES), ("#holder", HOLDERS)) if tag in tags])

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.element))
        self.parts, self.tags = [], 0

    def cut(self, place: int) -> None:
        """Close the element at that place of the stack and all in it."""
        for tag, _, _ in self.stack[place:]:
            for kind in self.kinds(tag):
                self.places[kind].pop()
        del self.stack[place:]

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag == "hr":
            self.parts.append(" ")
        if tag in BLOCKS:
            self.flush()
            if tag in IMPLIED and self.last(tag) > self.last("#scope"):
                self.cut(self.last(tag))
        if self.last("head") >= 0 and tag not in HEAD:  # its end tag may be left out
            self.cut(self.last("head"))
        self.tags += 1
        if tag in VOID:
            return
        above = self.skipped_by
        if above and tag in HOLDERS:
            above = self.opened(tag, above)
        number = self.element
        if tag in BLOCKS:
            self.parent.append(number)
            self.name.append(tag)
            number = len(self.parent) - 1
        for kind in self.kinds(tag):
            self.places.setdefault(kind, []).append(len(self.stack))
        self.stack.append((tag, number, above or self.skips(tag, dict(attrs))))

    def opened(self, tag: str, above: str) -> str:
        """What still skips an article or main that opens in what is skipped: a
        menu ends there (its end tag is missing), a form around the text isn't
        one to fill in, and main is the text wherever it is but in hidden elements."""
        if above in ENDED and self.last(above) >= 0:
            first = next(k for k in self.places[above] if self.stack[k][2] == above)
            self.cut(first)
            return self.skipped_by
        return "" if above == "form" or tag == "main" and above in (MARK, "aside", "footer") else above

    def skips(self, tag: str, attrs: dict) -> str:
        """The tag, or MARK, if the element isn't part of a text; else nothing."""
        if tag in SKIPPED:
            return tag
        if tag in ("html", "body") or tag in HOLDERS and "comment" not in (attrs.get("class") or "").lower():
            return ""
        held = self.last("#holder") >= 0
        if tag == "header" and not held:
            return tag
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return "hidden"
        if (attrs.get("role") or "").lower() in SKIPPED_ROLES:
            return MARK
        if tag not in BLOCKS and tag != "span" or tag in HEADINGS:
            return ""
        classes, name = attrs.get("class") or "", attrs.get("id") or ""
        if held:  # ids are made from headings there, and a header in an article is its own
            classes = " ".join(c for c in classes.split() if not c.lower().endswith("header"))
            return MARK if classes and MARKED.search(classes) or name.lower() in MARKED_IDS else ""
        return MARK if classes + name and MARKED.search(f"{classes} {name}") else ""

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag in BLOCKS:
            if self.last(tag) >= 0:
                self.cut(self.last(tag))
        elif self.last(tag) > self.last("#block"):
            self.cut(self.last(tag))

    def handle_data(self, data):
        if not self.skipped_by:
            self.parts.append(data)


def smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian mean over neighbouring lines; lines beyond the ends don't count."""
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    out = np.convolve(ratio, kernel)[radius:radius + len(ratio)]
    return out / np.convolve(np.ones(len(ratio)), kernel)[radius:radius + len(ratio)]


def threshold(values: np.ndarray) -> float:
    """Two-means clustering of the logs, from the extremes; the midpoint of the means."""
    x = np.log1p(values)
    low, high = float(x.min()), float(x.max())
    for _ in range(50):
        cut = (low + high) / 2
        up = x > cut
        if not up.any() or up.all():
            break
        new = float(x[~up].mean()), float(x[up].mean())
        if new == (low, high):
            break
        low, high = new
    return float(np.expm1((low + high) / 2))


def main_text(html: str, sigma: float = 1.0, share: float = 0.9) -> str:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    size = np.array([len(t) for t, _, _ in lines], float)
    ratio = size / np.array([max(1, n) for _, n, _ in lines])
    value = smoothed(ratio, sigma)
    cut = threshold(value) * (1 - 1e-9)  # equal values stay at it, however it is rounded
    weight = np.where(value >= cut, size, 0.0)
    # Text of content lines in each element and all below it.
    held = np.zeros(len(parser.parent))
    inside = [0] * len(lines)
    for k, (_, _, e) in enumerate(lines):
        inside[k] = e
        held[e] += weight[k]
    for e in range(len(held) - 1, 0, -1):  # a parent's number is smaller
        held[parser.parent[e]] += held[e]
    holders = [e for e in range(1, len(held)) if parser.name[e] in HOLDERS and held[e] >= 0.5 * held[0]]
    fitting = holders or [e for e in range(len(held)) if held[e] >= share * held[0] and parser.name[e] not in PARTS]
    best = fitting[-1] if not holders else max(holders)
    keep = below(parser.parent, best)
    # Content by themselves, not by their neighbours, wherever they are: two-means parts paragraphs too where no line is low.
    mean = float((weight * ratio).sum() / weight.sum())
    own = np.flatnonzero(ratio >= min(cut, threshold(ratio), mean / 4))
    if all(keep[inside[k]] for k in own):
        first = next(k for k in range(len(lines)) if keep[inside[k]])
        above = titles(parser, inside, best, first)
        return " ".join(t for k, (t, _, e) in enumerate(lines) if keep[e] or above <= k < first)
    region = common(parser.parent, [inside[k] for k in own] + [best])
    around = region
    while around > 0 and parser.name[around] not in HOLDERS:
        around = parser.parent[around]
    if around > 0:
        keep = below(parser.parent, around)
        return " ".join(t for t, _, e in lines if keep[e])
    keep = below(parser.parent, region)
    top = top_children(parser.parent, region)
    child = [top[e] for e in inside]
    held_by = {child[k] for k in own} - {region}
    alone = set(own.tolist())
    full = [k for k in range(len(lines)) if keep[inside[k]] and (child[k] in held_by or k in alone)]
    first, last = full[0], full[-1]
    edge = lambda k: keep[inside[k]] and (child[k] == region or parser.name[child[k]] in EDGES)
    while first > 0 and edge(first - 1):
        first -= 1
    while last + 1 < len(lines) and edge(last + 1):
        last += 1
    above = titles(parser, inside, region, first)
    return " ".join(t for k, (t, _, e) in enumerate(lines) if first <= k <= last and keep[e] or above <= k < first)


def titles(parser: _Lines, inside: list[int], region: int, first: int) -> int:
    """The first line of the headings right before a region that is no article
    or main: the earliest heading of the headings and paragraphs that touch it."""
    at = first
    if region > 0 and parser.name[region] not in HOLDERS:
        k = first - 1
        while k >= 0 and parser.name[inside[k]] in EDGES:
            if parser.name[inside[k]] in HEADINGS:
                at = k
            k -= 1
    return at


def below(parent: list[int], best: int) -> np.ndarray:
    """Which elements are the given one or inside it."""
    keep = np.zeros(len(parent), bool)
    keep[best] = True
    for e in range(best + 1, len(parent)):
        keep[e] = keep[parent[e]]
    return keep


def common(parent: list[int], elements: list[int]) -> int:
    """The least element that holds all of them: the first one above the least number whose numbers reach the greatest."""
    end = list(range(len(parent)))
    for e in range(len(parent) - 1, 0, -1):  # a parent's number is smaller
        end[parent[e]] = max(end[parent[e]], end[e])
    out, most = min(elements), max(elements)
    while end[out] < most:
        out = parent[out]
    return out


def top_children(parent: list[int], region: int) -> list[int]:
    """For each element the child of the region that it is in; the region for itself and what is outside."""
    top = [region] * len(parent)
    for e in range(region + 1, len(parent)):
        top[e] = e if parent[e] == region else top[parent[e]]
    return top


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), sigma: float = 1.0,
            share: float = 0.9) -> DataFrame:
    """``keep`` columns beside the text of each page."""
    return map_texts(pages, html, list(keep), "text string", lambda batch: [[main_text(h, sigma, share) for h in batch]])


QUERY = "op4_html_text"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))


ORACLE_SQL = None
