"""Main text of web pages from text-to-tag ratios.

The page is read as a stream of the standard library's parser events. Block elements
end lines; of each line the text, the characters of it outside links, the tags met since
the line before, and the innermost open block are kept. From there on numbers decide:

1. Lines inside blocks that the page itself marks as no part of the article (menus, forms,
   adverts and the like, by element, role, or class and id) are set aside; where article and
   main elements hold more than half of the other text, so is what lies outside them.
2. The ratio of each other line is its characters outside links by its tags, on a logarithmic
   scale, so that one huge paragraph doesn't set the scale for all. Menus that aren't marked,
   blocks of several lines that hold links only, have ratio 0.
3. Ratios are smoothed with a Gaussian kernel over neighbouring lines (menus stay 0). The
   threshold is a share of the ratios' standard deviation; runs of lines that reach it are
   the content clusters.
4. The region is the block whose lines exceed the threshold by most in sum: a block
   around it would add lines that fall short, a block inside it would lose lines that
   reach it. Paragraphs and headings of clusters that run across its edges belong to it, too.
5. All lines of the region are the text, short ones included; only those set aside and menus
   are held against the threshold by their own ratio, 0, and go.

Elements that are never shown (scripts, styles, templates, hidden ones) give no lines,
however they are nested.

Edge cases: null and empty pages have an empty text; a page where nothing but marked
lines or menus is left has an empty text; unclosed and stray tags are repaired by
popping to the nearest matching element, an unclosed menu ends where an article begins; repeated
rows and null ids are rows like others; other columns are ignored. Time and memory are linear
in the page, however deep it is nested.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowsmith.llm._io import small_batches

SIGMA = 1.0
#: Share of the ratios' standard deviation that a smoothed ratio must reach.
THRESHOLD = 0.8

# Elements by their part in a page, after the HTML standard.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("audio canvas datalist head iframe noscript object script style svg template title video".split())
ASIDE = frozenset("aside button dialog footer form menu nav option select textarea".split())
TEXTUAL = frozenset("blockquote dd dt h1 h2 h3 h4 h5 h6 li p pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Starting one of these ends an open p.
CLOSES_P = BLOCKS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
#: Words of a class or id that mark a block, if all others in the same name are of the second list.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus dropdown foot footer footers gdpr login menu menus modal nav navbar navigation newsletter notice notices pagination popup popups promo promos promotion related replies search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe teaser teasers toolbar widget widgets".split()
)
PLAIN = frozenset(
    "all area articles aside bar block body bottom box btn button buttons card center col column container content desktop element fb fixed floating form global google group holder icon icons inner item items js layer left line link links list main media message mobile module outer overlay page panel policy post posts primary right row secondary section site slot small sticky stories sub text thread to top unit user wp wrap wrapper".split()
)
#: The same for the head of a page; inside an article these name its title block.
HEADS = frozenset("head header headers masthead".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

SHOWN, MARKED, HIDDEN = 0, 1, 2


def marks(name: str, words: frozenset[str]) -> bool:
    """Whether one of the names in a class or id consists of one of ``words`` and plain words only."""
    for one in name.split():
        parts = {p.lower() for p in _NAME.findall(one) if not p.isdigit()}
        if parts & words and not parts - words - MARKS - PLAIN:
            return True
    return False


@dataclass
class Line:
    """A line of text: characters outside links, tags since the line before, number of its block, whether it is
    marked as no part of the article, whether it stands in an article or main element."""

    text: str
    own: int
    tags: int
    block: int
    marked: bool
    inside: bool


class Lines(HTMLParser):
    """Collects the lines, and the parent and name of each block; blocks are numbered in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = [("", 0, SHOWN)]  # name, block, state
        self.parent, self.name = [0], [""]
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.linked = self.tags = self.links = self.articles = 0
        self.standing: Counter[str] = Counter()  # names of the open elements

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            _, block, state = self.open[-1]
            self.lines.append(Line(text, max(0, len(text) - self.linked), self.tags, block, state == MARKED, self.articles > 0))
            self.tags = 0
        self.text, self.linked = [], 0

    def state(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """What an element makes of its text, by its name and attributes."""
        if tag in UNSEEN:
            return HIDDEN
        out = MARKED if tag in ASIDE or tag == "header" and not self.articles else SHOWN
        for k, v in attrs:
            if k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and _UNSEEN_STYLE.search(v):
                return HIDDEN
            if not v:
                continue
            if k == "role" and v.lower() in ROLES:
                out = MARKED
            elif k in ("class", "id") and tag not in ("html", "body", "main") and tag not in HEADINGS:
                if marks(v, MARKS) or not self.articles and tag != "article" and marks(v, HEADS):
                    out = MARKED
        return out

    def pop(self, at: int) -> None:
        """Close all open elements from place ``at`` on."""
        names = [t for t, _, _ in self.open[at:]]
        self.articles -= names.count("article") + names.count("main")
        self.standing.subtract(names)
        del self.open[at:]

    def push(self, tag: str, block: int, state: int) -> None:
        self.open.append((tag, block, state))
        self.standing[tag] += 1
        self.articles += tag in ("article", "main")

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "a":
            self.links += 1
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.text.append(" ")
            return
        block = tag in BLOCKS
        if block:
            self.flush()
            self.links = 0
            if tag in CLOSES_P and self.open[-1][0] == "p":
                self.pop(-1)
            if tag in ("li", "dt", "dd", "tr", "td", "th") and self.open[-1][0] == tag:
                self.pop(-1)
            if tag in ("article", "main") and self.standing["nav"]:  # nothing of the kind stands in a menu: it was never closed
                self.pop(next(i for i, (t, _, _) in enumerate(self.open) if t == "nav"))
        _, over, outer = self.open[-1]
        state = max(outer, self.state(tag, attrs))
        if block:
            number = len(self.name)
            role = dict(attrs).get("role")
            self.parent.append(over)
            self.name.append("main" if role in ("main", "article") else tag)
            self.push(tag, number, state)
        elif state > outer:  # of other elements only those that change what is shown are kept
            if state == MARKED:
                self.flush()
            self.push(tag, over, state)
        elif outer and self.open[-1][0] == tag:  # the same again inside: its end isn't the end of the outer one
            self.push(tag, over, state)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.flush()
            self.links = 0
        for i in range(len(self.open) - 1, 0, -1) if self.standing[tag] > 0 else ():
            if self.open[i][0] == tag:
                if self.open[i][2] == MARKED:
                    self.flush()
                self.pop(i)
                break
            if tag not in BLOCKS and self.open[i][0] in BLOCKS:
                break  # inline elements end with their block

    def handle_data(self, data):
        if self.open[-1][2] != HIDDEN:
            self.text.append(data)
            if self.links:
                self.linked += len(_SPACE.sub(" ", data))


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the kernel is renormalised at the ends. A sigma of 0 and no ratios change nothing."""
    if not sigma or not len(ratios):
        return ratios.astype(float)
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel)[reach:-reach] / np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]


def _within(parent: np.ndarray) -> np.ndarray:
    """The last block inside each block; blocks are numbered in page order."""
    last = np.arange(len(parent))
    for n in range(len(parent) - 1, 0, -1):
        if last[n] > last[parent[n]]:
            last[parent[n]] = last[n]
    return last


def menus(page: Lines, last: np.ndarray) -> np.ndarray:
    """Whether each line stands in a block of several lines that hold links only."""
    block = np.array([x.block for x in page.lines])
    order = np.argsort(block, kind="stable")
    linked = np.array([x.own == 0 for x in page.lines])[order]
    plain = np.concatenate([[0], np.cumsum(~linked)])
    lo, hi = np.searchsorted(block[order], np.arange(len(last))), np.searchsorted(block[order], last, "right")
    menu = (plain[hi] == plain[lo]) & (hi - lo > 1)
    out = np.zeros(len(block) + 1, np.int64)
    np.add.at(out, lo[menu], 1)
    np.add.at(out, hi[menu], -1)
    inside = np.empty(len(block), bool)
    inside[order] = np.cumsum(out)[:-1] > 0
    return inside


def region(page: Lines, sigma: float = SIGMA, threshold: float = THRESHOLD) -> np.ndarray:
    """Places of the lines that are the page's main text."""
    lines = page.lines
    block = np.array([x.block for x in lines])
    last = _within(np.array(page.parent))
    inside, own = (np.array([getattr(x, a) for x in lines]) for a in ("inside", "own"))
    out = np.array([x.marked for x in lines])
    if 2 * own[inside & ~out].sum() > own[~out].sum():
        out |= ~inside
    menu = menus(page, last) & ~out
    ratio = np.log1p([x.own / max(1, x.tags) for x in lines])
    ratio[out | menu] = 0
    level = threshold * (ratio[~out].std() if not out.all() else 0)
    smooth = np.zeros(len(lines))
    smooth[~out] = smoothed(ratio[~out], sigma)
    smooth[menu] = 0
    weightless = out | menu
    excess = np.zeros(len(last))
    np.add.at(excess, block, np.where(weightless, 0, smooth - level))
    for n in range(len(last) - 1, 0, -1):
        excess[page.parent[n]] += excess[n]
    held = np.zeros(len(last), bool)
    held[block] = True
    for n in range(len(last) - 1, 0, -1):
        held[page.parent[n]] |= held[n]
    excess[~held] = -np.inf
    best = int(np.argmax(excess))  # of equal ones the outermost
    mine = (block >= best) & (block <= last[best])
    cluster = smooth >= level
    at = np.flatnonzero(mine)
    for side in (range(at[0] - 1, -1, -1), range(at[-1] + 1, len(lines))):
        mine[_reached(side, lines, page.name, cluster, weightless)] = True
    return np.flatnonzero(mine & ~(weightless & (ratio < max(level, 1e-9 if threshold else 0.0))))


def _reached(places: Iterable[int], lines: list[Line], name: list[str], cluster: np.ndarray, weightless: np.ndarray) -> list[int]:
    """The lines of paragraphs and headings among ``places`` up to the end of the cluster; a heading stands with what follows it."""
    out = []
    for i in places:
        kind = name[lines[i].block]
        if weightless[i] or kind not in TEXTUAL or not (cluster[i] or kind in HEADINGS):
            break
        out.append(i)
    while out and not cluster[out[-1]] and out[-1] > out[0]:  # headings at the end of a page head nothing
        out.pop()
    return out


def main_text(html: str | None, sigma: float = SIGMA, threshold: float = THRESHOLD) -> str:
    """The text of the page's content region, blocks joined by one space."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page.flush()
    if not page.lines:
        return ""
    return " ".join(page.lines[i].text for i in region(page, sigma, threshold))


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
