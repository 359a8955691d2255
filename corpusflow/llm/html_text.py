"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The page is read once as a stream of events of the standard library's parser. Each block of text is a line; it carries the text's length,
the number of tags since the line before it, and its region, the nearest enclosing sectioning element. The text-to-tag ratios of
a page's lines are smoothed with a Gaussian kernel; a line is content if its smoothed ratio is above a threshold that lies
between the means of the two clusters of ratios. A region with a content line is a content region, and all of its lines are kept in page order.
Elements that never hold an article's text (menus, headers and footers of the page, sidebars, forms, scripts, adverts, comments) are skipped
as the events go by, by tag, role or a whole class or id. A form or a class does not skip an article or main inside it, and forms that hold most
of the text of a page without an article are kept.

Defined results: null or empty html and pages without text give an empty text; unclosed and misplaced tags are taken as they come;
repeated rows each get a result; very long pages are read whole; an empty table gives an empty table. Only page_id, url and html are read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from corpusflow.llm.common import map_texts

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
SECTIONS = frozenset("article main section div body td".split())
SKIPPED = frozenset(
    "head nav aside footer form script style noscript template menu button select textarea input iframe object svg canvas dialog "
    "audio video map datalist search title".split()
)
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
#: Parts that make up a class or id of boilerplate, and parts that may stand beside them; any other part, as in has-sidebar or nav-open, says something else.
_PARTS = (
    r"(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|"
    r"alerts?|popup|modal|overlay|sidebar|side-bar|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|"
    r"share|sharing|social|related|recommended|newsletter|subscribe|signup|login|skip|pagination|pager)"
)
_BESIDE = (
    r"(?:site|page|global|main|top|bottom|left|right|primary|secondary|mobile|sticky|post|posts|article|articles|entry|user|news|list|items?|links?|buttons?|icons?|"
    r"media|box|bar|area|block|section|container|wrapper|wrap|inner|form|unit|slot|message|policy|text|link|google|the|\d+)"
)
_BOILERPLATE = re.compile(rf"(?:{_BESIDE}[-_])*{_PARTS}\d*(?:[-_](?:{_PARTS}|{_BESIDE})\d*)*", re.IGNORECASE)
#: Whole classes and ids of reader comments, with what is inside, articles included.
_COMMENTS = re.compile(
    r"comments?|comments?[-_]?(?:list|section|area|thread|form|container|wrapper|block|body|content|meta|author|title|template|reply|respond)|"
    r"(?:li-|div-)?comment-\d+|respond|disqus(?:[-_]thread)?|replies", re.IGNORECASE
)
_OPTIONS = frozenset("option optgroup hr script template".split())  # what may stand in a list of choices
_HEADER = re.compile(r"(?:site|page|global|top|main)?[-_]?header(?:[-_]?\d+)?", re.IGNORECASE)
#: How an element is skipped: a form only if the page has more besides, a class not where an article or main is inside, and all else always.
_FORM, _CLASS, _ALWAYS = 1, 2, 3
_CUT = re.compile(r"<[/!?]?[A-Za-z][^<>]*\Z")  # a tag that the end of the page cuts off
_SPACE = re.compile(r"\s+")
#: Elements whose end tag may be left out, and what ends them.
_ENDS = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

SIGMA = 1.0


class Lines(HTMLParser):
    """Lines of a page as (text, tags, region); a region is the number of its sectioning element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.formed: list[bool] = []  # lines that stand in a form
        self.article = False  # a line stands in an article or main
        self.open: list[tuple[str, int, int]] = []  # tag, skipped, region
        self.parts: list[str] = []
        self.tags = 0
        self.regions = 0

    def _top(self) -> tuple[str, int, int]:
        return self.open[-1] if self.open else ("", 0, 0)

    def _break(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        self.parts.clear()
        if text:
            self.lines.append((text, self.tags, self._top()[2]))
            self.formed.append(self._top()[1] == _FORM)
            self.article = self.article or any(t in ("article", "main") for t, _, _ in self.open)
            self.tags = 0

    def handle_starttag(self, tag, attrs) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._break()
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag not in _OPTIONS:  # anything else ends a list of choices that was left open
            at = next((i for i, o in enumerate(self.open) if o[0] == "select"), len(self.open))
            del self.open[at:]
        while self.open and tag in _ENDS.get(self.open[-1][0], ()):
            self.open.pop()
        _, skipped, region = self._top()
        if tag in ("article", "main") and skipped < _ALWAYS:
            skipped = 0
        own = _FORM if tag == "form" else _ALWAYS if tag in SKIPPED else 0
        skipped = max(skipped, own, self._boilerplate(tag, dict(attrs)))
        if tag in SECTIONS and not any(t in ("article", "main") for t, _, _ in self.open):
            self.regions += 1
            region = self.regions
        self.open.append((tag, skipped, region))

    def _boilerplate(self, tag: str, attrs: dict) -> int:
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
        if tag in ("html", "body", "main"):
            return 0
        if any(map(_COMMENTS.fullmatch, names)):
            return _ALWAYS
        if tag == "article":
            return 0
        if tag == "header":
            return _ALWAYS * (not any(t in ("article", "main") for t, _, _ in self.open))
        if (attrs.get("role") or "").lower() in SKIPPED_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return _ALWAYS
        if any(map(_BOILERPLATE.fullmatch, names)):
            return _CLASS
        return _CLASS * (any(map(_HEADER.fullmatch, names)) and not any(t == "article" for t, _, _ in self.open))

    def without_forms(self) -> list[tuple[str, int, int]]:
        """The lines without those in forms, unless the page has no article and most of its text is in forms."""
        inside = sum(len(t) for (t, _, _), f in zip(self.lines, self.formed, strict=True) if f)
        if not self.article and 2 * inside > sum(len(t) for t, _, _ in self.lines):
            return self.lines
        out, tags = [], 0
        for (text, own, region), formed in zip(self.lines, self.formed, strict=True):
            tags += own
            if not formed:
                out.append((text, tags, region))
                tags = 0
        return out

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._break()
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data) -> None:
        if self._top()[1] <= _FORM:
            self.parts.append(data)

    def close(self) -> None:
        super().close()
        self._break()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the lines; the kernel is scaled anew at the ends of the page."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    whole = np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Middle between the means of two clusters, found by repeated averaging from the mean on; values that are all alike pass."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            return float(values.min())
        nearer = (low.mean() + high.mean()) / 2
        if abs(nearer - cut) < 1e-9:
            break
        cut = float(nearer)
    return cut


def extract(html: str | None, sigma: float = SIGMA) -> str:
    page = Lines()
    page.feed(_CUT.sub("", html or ""))
    page.close()
    lines = page.without_forms()
    if not lines:
        return ""
    ratios = smoothed(np.array([len(t) / max(1, tags) for t, tags, _ in lines]), sigma)
    content = ratios >= threshold(ratios)
    regions = {r for (_, _, r), c in zip(lines, content, strict=True) if c}
    return "\n".join(t for t, _, r in lines if r in regions)


def main_text(pages: DataFrame, sigma: float = SIGMA) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``."""

    def each(html: str | None) -> tuple:
        text = extract(html, sigma)
        return text, len(text)

    return map_texts(pages, ["page_id", "url"], "html", each, {"text": "string", "n_chars": "long"})
