"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser gives the events of a page. A line is
the text of one block; its ratio is its characters over the tags since the
line before. The ratios are smoothed by a Gaussian over the page's lines, and
lines over a threshold (a share of the ratios' deviation) are seeds, the clusters
of content.

*The region* is where the seeds are: the smallest part of the page that holds most
of their text. If an article or main part is around it, the outermost of these is
the region; else it grows, from the root down, to the smallest part that holds
all seeds, paragraphs, headings and items but those of other, smaller articles. The
region gives all of its lines, short ones too.

*Set apart* are menus, page headers, footers, sidebars, notices, adverts, forms and
reader comments, by tag, role, or a whole word of class or id that says so. Such a
word only weighs in, the seeds decide: a part that holds most of the page's seeds,
with the page's article, main part or heading in it, or outside of which there are
none, is the frame of the content and not set apart, whatever it is called. Nothing is
taken of what a page hides (head, scripts, ``hidden``, ``display: none``).
Outside of an article or main part, items of bare links and rows of links are left out too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split())
PARTS = frozenset("html body main article section div center table tbody tr td".split())
TEXTS = frozenset("address blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
HIDDEN = frozenset("head script style noscript template title iframe object svg canvas math audio video map".split())
#: Set apart whatever they hold, and only if they do not frame the content.
APART = frozenset("nav footer aside button select textarea option label input menu dialog".split())
FRAMES = frozenset("form fieldset header".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_WHERE = r"(?:(?:site|page|main|global|top|bottom|left|right|primary|secondary|post|article|entry|blog|user|reader)[-_]?)?"
_WHAT = (r"(?:ads?|advert\w*|sponsor\w*|promos?|promotions?|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|nav|navbar|"
         r"navigation|menus?|breadcrumbs?|sidebar|footer|foot|masthead|topbar|toolbar|alerts?|comments?|replies|disqus|respond|"
         r"share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|pagination|pager|widgets?|skip)")
_HOW = r"(?:[-_]?(?:bar|box|list|area|section|block|wrapper|wrap|container|inner|links?|menu|nav|form|unit|slot|message|thread|posts|\d+))?"
NAMES = re.compile(rf"(?:^|\s){_WHERE}(?:{_WHAT}[-_]?)*{_WHAT}{_HOW}(?=$|\s)", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!important\s*)?(?:;|$)", re.I)
PAGE_HEADER = re.compile(r"(?:^|\s)(?:(?:site|page|top|global)[_-]?)?header(?:$|\s)", re.I)
ENDS_P = BLOCKS - frozenset("body html head title option".split())
_CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
           "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_SPACE = re.compile(r"\s+")
LISTS = frozenset("li td ul ol".split())

SIGMA = 1.0
SHARE = 0.5        # of the deviation: the threshold of a seed
MOST = 0.8         # of the seeds' text: the smallest part that holds it is the heart of the region
HALF = 0.5         # of the seeds' text: a part that is named otherwise may be the frame of it


class Page(HTMLParser):
    """Lines of a page with their element, tags and share of link text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent = [-1]
        self.tag = ["#root"]
        self.mark = [0]           # 0: content, 1: set apart unless it frames the content, 2: set apart
        self.hidden = [False]
        self.inside = [False]     # in an article or main part
        self.stack = [0]
        self.lines: list[tuple[str, int, int, bool]] = []  # text, element, tags before, nothing but a list of links
        self.text: list[str] = []
        self.linked = 0
        self.size = 0
        self.anchors = 0          # links of the line that is being read
        self.links = 0
        self.tags = 0
        self.at = 0

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                self.lines.append((text, self.at, self.tags, self.linked >= self.size
                                   and (self.tag[self.at] in LISTS or self.anchors > 2)))
                self.tags = 0
            self.text, self.linked, self.size = [], 0, 0
        self.anchors = 0

    def _pop(self, keep: int) -> None:
        for e in self.stack[keep:]:
            if self.tag[e] == "a":
                self.links -= 1
        del self.stack[keep:]

    def _close(self, names: frozenset | tuple, stops: frozenset | tuple = ()) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[k]]
            if t in names:
                self._pop(k)
                return
            if t in stops:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            if tag in ENDS_P:
                self._close(("p",), PARTS | APART | FRAMES)
            if tag in _CLOSES:
                names, stops = _CLOSES[tag]
                self._close(tuple(names.split()), tuple(stops.split()))
        elif tag == "br":
            self.text.append(" ") if self.text else None
        if tag in VOID:
            return
        top = self.stack[-1]
        inside = self.inside[top] or tag in ("article", "main")
        mark = 2 if tag in APART else 1 if tag in FRAMES and not (tag == "header" and inside) else 0
        hidden = self.hidden[top] or tag in HIDDEN
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value and value.lower() == "true" \
                    or name == "style" and value and UNSEEN.search(value):
                hidden = True
            elif value and (name == "role" and value.lower() in ROLES
                            or name in ("class", "id") and tag not in ("html", "body", "article", "main")
                            and (NAMES.search(value) or not inside and PAGE_HEADER.search(value))):
                mark = max(mark, 1)
        self.parent.append(top)
        self.tag.append(tag)
        self.mark.append(mark)
        self.hidden.append(hidden)
        self.inside.append(inside)
        self.stack.append(len(self.tag) - 1)
        if tag == "a":
            self.links += 1
            self.anchors += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag not in VOID:
            self._close((tag,))

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if self.hidden[top]:
            return
        bare = len(data) if not data.isspace() else 0
        if bare:
            if not self.size:
                self.at = self._block()
            self.size += bare
            if self.links:
                self.linked += bare
        self.text.append(data)

    def _block(self) -> int:
        for e in reversed(self.stack):
            if self.tag[e] in BLOCKS or e == 0:
                return e
            if self.mark[e]:
                return e
        return 0


def smooth(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel, "full")[reach:reach + len(ratio)] / weight


def _totals(page: Page, at: list[int], amount: np.ndarray) -> np.ndarray:
    """Of each element, the amounts of the lines in it."""
    total = np.zeros(len(page.tag))
    np.add.at(total, at, amount)
    for e in range(len(total) - 1, 0, -1):
        total[page.parent[e]] += total[e]
    return total


def _under(page: Page, marked: np.ndarray) -> np.ndarray:
    """The elements that are marked or in one that is."""
    out = marked.copy()
    for e in range(1, len(out)):
        out[e] |= out[page.parent[e]]
    return out


def seeds(page: Page, fine: np.ndarray) -> np.ndarray:
    """Which lines are seeds: their smoothed ratio reaches the threshold. Lines that are not ``fine`` have ratio 0."""
    ratio = np.array([len(t) / max(1, tags) if ok else 0.0 for (t, _, tags, _), ok in zip(page.lines, fine)])
    level = smooth(ratio)
    found = fine & (level >= SHARE * level.std())
    return found if found.any() else fine


def set_apart(page: Page) -> np.ndarray:
    """The elements that are set apart, or in one that is. Frames of the content are not."""
    at = [e for _, e, _, _ in page.lines]
    size = np.array([len(t) for t, _, _, _ in page.lines], float)
    surely = _under(page, np.array(page.mark) == 2)
    marked = np.array(page.mark) > 0
    bare = np.array([links for _, _, _, links in page.lines])
    weight = _totals(page, at, size * seeds(page, ~surely[at] & ~bare))
    core = np.array([t in ("article", "main", "h1") for t in page.tag]) & ~surely
    core = _totals(page, np.flatnonzero(core), np.ones(int(core.sum())))
    for e in range(1, len(marked)):
        if not marked[e] or page.mark[e] != 1 or weight[e] < HALF * weight[0] or not weight[0]:
            continue
        # what the parts beside it leave, without those that are set apart themselves
        rest = marked.copy()
        rest[e] = True
        if core[e] == core[0] > 0 or not size[~_under(page, rest)[at]].any():
            marked[e] = False
    return _under(page, marked)


def main_text(html: str | None) -> str:
    """The lines of a page's content region, joined by line breaks."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    page.flush()
    lines = page.lines
    if not lines:
        return ""
    at = [e for _, e, _, _ in lines]
    apart = set_apart(page)
    own = np.array([not apart[e] and not links for _, e, _, links in lines])
    seed = seeds(page, own)
    size = np.array([len(t) for t, _, _, _ in lines], float)
    weight = _totals(page, at, size * seed)
    heart = 0
    for e in range(1, len(page.tag)):  # the smallest part that holds most: the deepest, as elements come in order
        if weight[e] >= MOST * weight[0] > 0 and page.parent[e] >= heart:
            heart = e
    region, e = None, heart
    while e > 0:
        if page.tag[e] in ("article", "main"):
            region = e
        e = page.parent[e]
    whole = region is not None
    if not whole:
        # articles that hold little beside the heart are no part of it; two that share the seeds are
        others = np.array([t == "article" and not page.inside[page.parent[k]] and weight[k] < (1 - MOST) * weight[0]
                           for k, t in enumerate(page.tag)])
        others = _under(page, others) if weight[0] else np.zeros(len(page.tag), bool)
        own &= ~others[at]
        seed &= own
        count = _totals(page, at, own.astype(float))
        kept = _totals(page, at, (own & (seed | np.array([page.tag[e] in TEXTS for e in at]))).astype(float))
        child: dict[int, list[int]] = {}
        for e in range(1, len(page.tag)):
            child.setdefault(page.parent[e], []).append(e)
        region = 0
        while down := [e for e in child.get(region, ()) if page.tag[e] in PARTS and count[e] > 1 and kept[e] == kept[region]]:
            region = down[0]
    within = np.zeros(len(page.tag), bool)
    within[region] = True
    within = _under(page, within)
    return "\n".join(t for k, (t, e, _, _) in enumerate(lines) if within[e] and (not apart[e] if whole else own[k]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html = batch.column("html")
        text = [main_text(html[k].as_py()) for k in range(len(html))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
             pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars (its code points) of every
    row of ``pages`` (page_id, url, html).

    A null or empty html gives the empty text; null or repeated page_id and
    url are passed on; other columns are ignored; an empty table gives an
    empty result. Broken markup is read as far as the parser makes sense of it.
    """
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html"))
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
