"""Main text of web pages by text-to-tag ratios.

A parser of the standard library reads a page as a stream of events. Text between two block-level tags is a line; its
ratio is its number of characters by the number of tags met since the line before. Lines inside elements that name
themselves as something else than the article (``SKIPPED`` tags, roles, and classes or ids with a word of ``ASIDE``)
have ratio 0. Ratios are smoothed with a Gaussian, so that short lines among long ones gain and long lines among menus
lose, and lines at or above the threshold, a share of the standard deviation, are seeds. Where an ``article`` or ``main``
element holds most of the seeds' characters, the content region is the innermost such element that holds all seeds of the
outermost one; else it is the innermost container of any kind that holds all seeds, or the page. All its lines that are
not aside are kept, whatever their length.

Character references are decoded, white space inside a line becomes one space, and lines are joined by an empty line.
Null and empty pages, and pages without such a line, have empty text. Pages are read whole; unclosed elements are closed
where an element around them ends. Repeated rows are read each by itself.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import regex
from pyspark.sql import DataFrame

from clearlot.llm.common import id_field, in_python, schema_of

#: Elements whose text is never part of the article.
SKIPPED = frozenset(
    "head title script style noscript template iframe object svg canvas math audio video map nav footer aside form "
    "button select textarea input menu dialog figcaption".split()
)
#: A page's header is skipped; the header of an article holds its headline.
HEADER = "header"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open element of the same kind.
CLOSED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"),
                  "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
CONTAINERS = frozenset("article main section div td body".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of class names and ids.
ASIDE = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies disqus cookie cookies "
    "consent gdpr notice notices alert popup modal overlay share sharing social related recommended newsletter "
    "subscribe signup login pagination pager widget toolbar skip".split()
)
ARTICLE = frozenset("article main content post entry story body".split())
NAME = regex.compile(r"[A-Za-z][a-z]*|[A-Z]+")

SIGMA = 1.0
#: Lines are seeds from this share of the standard deviation of the ratios on.
THRESHOLD = 0.5
#: An article or main element that holds at least this share of the seeds' characters bounds the region.
MOST = 0.8


class _Lines(HTMLParser):
    """The lines of a page: text, tags before it, whether it is aside, and the containers around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, tuple[tuple[int, str], ...]]] = []
        self.open: list[tuple[str, bool, tuple[tuple[int, str], ...]]] = [("", False, ())]
        self.parts: list[str] = []
        self.tags = 0
        self.count = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            _, aside, around = self.open[-1]
            self.lines.append((text, self.tags, aside, around))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        for other in CLOSED_BY_NEXT.get(tag, ()):
            self._close(other, CONTAINERS | {"ul", "ol", "dl", "table", "select"} - {other})
        _, aside, around = self.open[-1]
        aside = aside or tag in SKIPPED or (attrs != [] and _named_aside(tag, dict(attrs)))
        if tag == HEADER and not any(name in ("article", "main") for _, name in around):
            aside = True
        if aside != self.open[-1][1]:
            self._flush()
        if tag in CONTAINERS:
            self.count += 1
            around = (*around, (self.count, tag))
        self.open.append((tag, aside, around))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                if self.open[at][1] != self.open[at - 1][1]:
                    self._flush()
                del self.open[at:]
                return
            if self.open[at][0] in within:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        self.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] not in ("script", "style"):
            self.parts.append(data)

    def close(self) -> None:
        super().close()
        self._flush()


def _named_aside(tag: str, attrs: dict[str, str | None]) -> bool:
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return True
    if (attrs.get("role") or "").lower() in ROLES:
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    for named in (attrs.get("class") or "").split() + [attrs.get("id") or ""]:
        words = [word.lower() for word in NAME.findall(named)]
        if any(word in ASIDE for word in words) and words[-1:] != ["content"] and not ARTICLE.issuperset(words):
            return True
    return False


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Values averaged with a Gaussian of the given width; at the ends over what is there."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    if not len(values):
        return values
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach : reach + len(values)]
    return np.convolve(values, kernel, "full")[reach : reach + len(values)] / weight


def main_lines(html: str, sigma: float = SIGMA, threshold: float = THRESHOLD, most: float = MOST) -> list[str]:
    """The lines of the content region, in page order."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    sizes = np.array([0 if aside else len(text) for text, _, aside, _ in lines], np.float64)
    if not sizes.any():
        return []
    ratios = smoothed(sizes / np.maximum([tags for _, tags, _, _ in lines], 1), sigma)
    seeds = (sizes > 0) & (ratios >= min(threshold * ratios.std(), ratios[sizes > 0].max()))
    held: dict[tuple[int, str], float] = {}
    depth: dict[tuple[int, str], int] = {}
    for (_, _, _, around), size in zip(lines, np.where(seeds, sizes, 0), strict=True):
        for level, container in enumerate(around):
            held[container] = held.get(container, 0) + size
            depth[container] = level
    wanted = sizes[seeds].sum()
    articles = [one for one, size in held.items() if one[1] in ("article", "main") and size >= most * wanted]
    if articles:
        wanted = held[min(articles, key=lambda container: (depth[container], container[0]))]
    whole = [container for container in articles or held if held[container] >= wanted]
    region = max(whole, key=lambda container: (depth[container], -container[0]), default=None)
    return [
        text
        for text, _, aside, around in lines
        if not aside and (region is None or region in around)
    ]


def extract_pages(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per page its id, url, ``text`` and ``n_chars``; other columns are left out."""
    schema = schema_of(id_field(pages, id_column), id_field(pages, url_column), "text string", "n_chars long")

    def start():
        def row(key, url, html) -> tuple:
            text = "\n\n".join(main_lines(html or ""))
            return key, url, text, len(text)

        return row

    return in_python(pages.select(id_column, url_column, html_column), schema, start, measure=2)
