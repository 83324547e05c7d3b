"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser streams events. Its text is cut into lines at
block-level tags; each line gets its ratio of text to tags. The logarithms of the ratios,
smoothed by a Gaussian along the page, fall into two clusters by their distance from
nothing and from the mean of the upper cluster; lines of the upper one are content lines.
They are taken over all lines of the page and select its regions. A region is an article (or
main) element where the page marks some, or what stands between lines that are kept apart
or marked. A marked region is selected if it has a content line, another one if its content lines hold a tenth of the text
that those of the heaviest region hold; so a marked article without content lines is left out and text outside of one is found.
A marked region is content from end to end, as a short paragraph or a heading inside it has a low ratio; of another one, what
stands from its first to its last content line. Lines inside elements that never hold the article (menus, footers,
adverts, forms, comments, notices) bound regions, count as empty and are never content.

Defined results: a null or empty html gives the empty text; broken markup is read as
far as the parser can; repeated rows, null ids and null urls give a row each; an
empty table gives none. Pages are read whole whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

# HTML element names by their part in a page.
SILENT = frozenset("script style noscript template head title svg math iframe object select textarea button canvas audio video datalist".split())
ASIDE = frozenset("nav footer aside form header menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("html body".split())
MAIN = frozenset("article main".split())
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|footer|header|masthead|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|share|social|related|recommend\w*|comments?|disqus|respond|replies|login|signup|search|widget|toolbar|pagination|pager|skip)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

SPREAD = 2.0


class Lines(HTMLParser):
    """Collects (text, tags, number of its article or 0, kept apart) for each block-level line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # name, then the two counters as they were before it
        self.silent = self.apart = self.main = self.articles = 0
        self.text: list[str] = []
        self.tags = 0
        self.lines: list[tuple[str, int, int, bool]] = []

    def flush(self) -> None:
        s = " ".join("".join(self.text).split())
        if s or self.tags:
            self.lines.append((s, self.tags, self.articles if self.main else 0, self.apart > 0))
        self.text, self.tags = [], 0

    def shut(self, k: int) -> None:
        """Close everything from the k-th open element on."""
        for name, silent, apart in reversed(self.open[k:]):
            self.silent, self.apart = silent, apart
            self.main -= name in MAIN
        del self.open[k:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if tag in CLOSES_P:
                for k in range(len(self.open) - 1, -1, -1):
                    if self.open[k][0] == "p":
                        self.flush()
                        self.shut(k)
                        break
                    if self.open[k][0] in BLOCK:
                        break
            if tag == "li" and any(n == "li" for n, _, _ in self.open):
                k = max(i for i, x in enumerate(self.open) if x[0] == "li")
                if not any(n in ("ul", "ol", "menu") for n, _, _ in self.open[k:]):
                    self.flush()
                    self.shut(k)
            self.flush()
        if tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        before = (tag, self.silent, self.apart)
        if tag in SILENT:
            self.silent += 1
        elif tag in ASIDE or (tag not in MAIN and tag not in ("html", "body") and self.named(attrs)):
            self.apart += 1
        if tag in MAIN:
            self.articles += not self.main
            self.main += 1
        self.open.append(before)

    @staticmethod
    def named(attrs) -> bool:
        for k, v in attrs:
            if v and (k == "role" and v.strip().lower() in ROLES or k in ("class", "id") and NAMED.search(v)) or k == "hidden" or k == "aria-hidden" and v == "true":
                return True
            if k == "style" and v and re.search(r"display\s*:\s*none", v, re.I):
                return True
        return False

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in BLOCK:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)
        else:  # HTML takes <div/> as <div>
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.shut(k)
                return
            if self.open[k][0] in BLOCK and tag not in BLOCK:
                return  # a stray end of an inline element

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)


def ratios(lines: list[tuple[str, int, int, bool]]) -> np.ndarray:
    """Logarithms of text to tags; 0 for what is kept apart."""
    return np.log1p([0.0 if apart else len(s) / max(1, t) for s, t, _, apart in lines])


def smoothed(x: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    k = int(3 * spread)
    kernel = np.exp(-np.arange(-k, k + 1) ** 2 / (2 * spread * spread))
    weight = np.convolve(np.ones(len(x)), kernel)[k : k + len(x)]
    return np.convolve(x, kernel)[k : k + len(x)] / weight


def threshold(x: np.ndarray) -> float:
    """Where two clusters of x part, one with its centre at 0, the other at its mean."""
    high = x.max()
    while (new := x[x >= high / 2].mean()) < high:
        high = new
    return high / 2


def main_text(html: str, rate=ratios) -> str:
    """Blocks of the content regions, in page order, joined by a line break."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    lines = [x for x in parser.lines if x[0]]
    open_ = np.array([not x[3] for x in lines], bool)
    if not open_.any():
        return ""
    ratio = smoothed(rate(lines))
    content = open_ & (ratio >= threshold(ratio))
    chosen = _regions(content, lines, open_)
    return "\n".join(x[0] for x, c in zip(lines, chosen, strict=True) if c)


def _regions(content: np.ndarray, lines, open_: np.ndarray) -> np.ndarray:
    """The lines of the regions that content lines select.

    Candidates are each marked article, and each run between lines that are kept apart or stand in an article. An article with a
    content line is taken with all its open lines; of a run those from its first to its last content line are, if its
    content lines hold a tenth of the text that those of the heaviest region hold.
    """
    article = np.array([x[2] for x in lines], np.int64)
    size = np.array([len(x[0]) for x in lines], np.int64)
    bare = open_ & (article == 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], bare.astype(np.int8), [0]]))).reshape(-1, 2)
    regions = [np.flatnonzero(open_ & (article == k)) for k in np.unique(article[open_ & (article > 0)]).tolist()]
    marked = len(regions)
    for a, b in edge.tolist():
        at = np.flatnonzero(content[a:b]) + a
        if len(at):
            regions.append(np.arange(at[0], at[-1] + 1))
    weights = [int(size[r][content[r]].sum()) for r in regions]
    out = np.zeros(len(lines), bool)
    for k, (r, w) in enumerate(zip(regions, weights, strict=True)):
        if w and (k < marked or 10 * w >= max(weights)):
            out[r] = True
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in text_chunks(batch, "html"):
                texts = [main_text(h.decode("utf-8", "replace")) for h in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("html")).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
