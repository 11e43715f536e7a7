"""Main text of web pages by text-to-tag ratios (operator 2).

Events of the standard library's parser become lines, one for each block of
text. A line's ratio is its characters by the tags met since the line before;
lines in menus, headers, footers, sidebars, notices, adverts, forms, comments
and the like count as zero. The ratios are smoothed with a Gaussian over
neighbouring lines and split into two clusters by their means. The smallest
element that holds most of the upper cluster's characters says where the text
is. Inside articles or mains, the region is the smallest element that holds all
of the upper cluster that lies in any of these, and the article or main around
it; elsewhere, the smallest element that holds the whole upper cluster. All the
region's lines that are not boilerplate are the text, short ones included. Where
the region is the whole page, lines of links below the threshold go as well, and
lines outside paragraphs and headings with half the threshold's ratio before or
after the upper cluster.

Defined cases: a null or empty page, and a page without text, give the empty
text; unclosed and stray tags are closed where the next block begins or their
parent ends; markup declarations that the parser refuses are taken as text;
repeated rows are extracted each; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candela.llm.store import extended, fitted

FEED_CHARS = 1 << 16
SIGMA = 1.0
RADIUS = 2
#: share of the upper cluster's characters that says where the text is
MOST = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre
search section select summary table tbody td tfoot th thead tr ul""".split())
#: elements that may be the region; a paragraph, a quote or a cell never is
CONTAINER = frozenset("article main section div body html center".split())
LANDMARK = frozenset(("article", "main"))
#: their lines are the author's, however short
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
DROPPED = frozenset("""aside button canvas datalist dialog fieldset footer form head iframe label legend map menu nav
noscript object option script search select style svg template textarea title""".split())
BOILER_WORDS = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent
cookie cookies dialog disqus footer header masthead menu modal nav navbar navigation newsletter notice pager pagination
popup promo promotion recommended related respond search share sharing sidebar social sponsor sponsored subscribe toolbar
widget""".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())
#: words that leave the meaning of a name to the others in it
NEUTRAL_WORDS = frozenset("""area bar block bottom box btn button buttons center container count desktop fixed float footer
global group header icon icons inner item items js left link links list mobile nav outer overlay page panel primary right
row secondary section signup site slot small sticky thread title top unit wide wrap wrapper zone""".split())
#: elements that never hold text, as against those that may be round a whole page
MUTE = frozenset("""button canvas datalist dialog fieldset head iframe label legend map menu noscript object option script
search select style svg template textarea title""".split())
#: headings that join the region they stand before
HEADINGS = frozenset(("h1", "h2"))
BOILER_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
_WORD = re.compile(r"[a-z0-9]+")


class _Line(NamedTuple):
    text: str
    tags: int
    linked: int      #: characters in links
    mute: bool       #: of an element that never holds text
    suspect: int     #: number of the innermost element taken for boilerplate, or -1
    container: int
    block: str       #: tag of the block


class _Open(NamedTuple):
    tag: str
    mute: bool
    suspect: int
    container: int
    silent: bool  #: mute from within a line


class _Lines(HTMLParser):
    """Lines of a page. Looks at the elements that are open go by counts of
    tags and places of blocks, so that unclosed tags cost no more than others."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.blocks: list[int] = []  # places of the blocks among the open ones
        self.count: Counter[str] = Counter()
        self.parent: list[int] = [-1]  # of container 0, the page
        self.kind: list[str] = ["html"]
        #: of every suspect: the one around it, its tag, whether a main heading or part is in it
        self.around: list[int] = []
        self.suspect_tag: list[str] = []
        self.heads: list[bool] = []
        self.text: list[str] = []
        self.silent = self.linked = self.tags = 0
        self.lines: list[_Line] = []

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            top = self.open[-1] if self.open else _Open("", False, -1, 0, False)
            block = self.open[self.blocks[-1]].tag if self.blocks else ""
            self.lines.append(_Line(text, self.tags, self.linked, top.mute, top.suspect, top.container, block))
            self.tags = 0
        self.text.clear()
        self.linked = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.text.append("\n")
        if tag in VOID:
            return
        if tag in BLOCK:
            self._implied(tag)
        _, mute, suspect, container, _ = self.open[-1] if self.open else _Open("", False, -1, 0, False)
        boiler = not mute and (tag in DROPPED or tag == "header" and not (self.count["article"] or self.count["main"])
                               or attrs and self._boiler(tag, attrs))
        # within a line it is boilerplate for good
        silent = not mute and tag not in BLOCK and (boiler or tag in MUTE)
        mute = mute or tag in MUTE or silent
        if boiler and not mute:
            self.around.append(suspect)
            self.suspect_tag.append(tag)
            self.heads.append(False)
            suspect = len(self.around) - 1
        if tag in ("h1", "main"):
            s = suspect
            while s >= 0 and not self.heads[s]:
                self.heads[s] = True
                s = self.around[s]
        if tag in CONTAINER:
            self.parent.append(container)
            self.kind.append(tag)
            container = len(self.kind) - 1
        self.silent += silent
        self.count[tag] += 1
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(_Open(tag, mute, suspect, container, silent))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag):
        if not self.count[tag]:
            self.tags += 1
            return
        i = len(self.open) - 1
        while self.open[i].tag != tag:
            i -= 1
        if self.blocks and self.blocks[-1] >= i:
            self.flush()
        self.tags += 1
        self._close(i)

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            if self.count["a"]:
                self.linked += len(data)

    def _close(self, i):
        for x in self.open[i:]:
            self.count[x.tag] -= 1
            self.silent -= x.silent
        del self.open[i:]
        while self.blocks and self.blocks[-1] >= i:
            self.blocks.pop()

    def _implied(self, tag):
        """A block ends an open paragraph; an item ends the open item."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        while self.blocks:
            t = self.open[self.blocks[-1]].tag
            if t != "p" and t not in ends:
                return
            self._close(self.blocks[-1])
            if t != "p" and t != "td" and t != "th":
                return

    def dropped(self) -> list[bool]:
        """Whether a line is boilerplate. An element taken for it is none after
        all if the page's main heading or part is in it and it holds more
        paragraph text than stands outside of such elements, or if nothing
        does and it holds the most."""
        n = len(self.around)
        prose, outside, free = [0] * n, 0, 0
        for x in self.lines:
            if x.mute:
                continue
            size = len(x.text) if x.block == "p" else 0
            if x.suspect >= 0:
                prose[x.suspect] += size
            else:
                outside += size
                free += 1
        total = list(prose)
        for s in range(n - 1, -1, -1):  # a suspect's number is larger than that of the one around it
            if self.around[s] >= 0:
                total[self.around[s]] += total[s]
        able = [t not in ("nav", "aside", "footer", "header") for t in self.suspect_tag]
        pardoned = [able[s] and self.heads[s] and total[s] > outside for s in range(n)]
        if not free and not any(pardoned) and any(able):
            top = max((s for s in range(n) if able[s] and self.around[s] < 0), key=total.__getitem__, default=-1)
            if top >= 0 and total[top]:
                pardoned[top] = True
        bad = [False] * n
        for s in range(n):
            bad[s] = not pardoned[s] or self.around[s] >= 0 and bad[self.around[s]]
        return [x.mute or x.suspect >= 0 and bad[x.suspect] for x in self.lines]

    @staticmethod
    def _boiler(tag, attrs):
        """Whether attributes name boilerplate: a class or id of such words and
        of words without meaning of their own, next to none that names text."""
        if tag in ("html", "body", "article", "main"):
            return False
        found, content = False, False
        for name, value in attrs:
            if name == "hidden" or name == "role" and (value or "").lower() in BOILER_ROLES:
                return True
            if name in ("class", "id"):
                for one in (value or "").lower().split():
                    words = set(_WORD.findall(one))
                    content |= bool(words & CONTENT_WORDS)
                    found |= bool(words & BOILER_WORDS) and not {x for x in words - BOILER_WORDS - NEUTRAL_WORDS if not x.isdigit()}
        return found and not content

    @classmethod
    def of(cls, html: str) -> _Lines:
        for text in (html, html.replace("<!", "&lt;!")):
            self = cls()
            try:
                for i in range(0, len(text), FEED_CHARS):
                    self.feed(text[i:i + FEED_CHARS])
                self.close()
                break
            except AssertionError:  # how the parser refuses a markup declaration
                continue
        self.flush()
        return self


def smoothed(ratios: np.ndarray) -> np.ndarray:
    k = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratios)), k)[RADIUS:len(ratios) + RADIUS]
    return np.convolve(ratios, k)[RADIUS:len(ratios) + RADIUS] / weight


def threshold(values: np.ndarray) -> float:
    """Between the means of two clusters, begun at the extremes."""
    lo, hi = values.min(), values.max()
    for _ in range(50):
        upper = values > (lo + hi) / 2
        if upper.all() or not upper.any():
            break
        new = values[~upper].mean(), values[upper].mean()
        if new == (lo, hi):
            break
        lo, hi = new
    return float((lo + hi) / 2)


def landmarks(page: _Lines) -> list[int]:
    """Of every container the outermost article or main that holds it or is it, or -1."""
    out: list[int] = []
    for c, kind in enumerate(page.kind):
        above = out[page.parent[c]] if c else -1
        out.append(above if above >= 0 else c if kind in LANDMARK else -1)
    return out


def common(page: _Lines, containers: set[int]) -> int:
    """The smallest container that holds all of them."""
    heap, held = [-c for c in containers], set(containers)
    heapq.heapify(heap)
    while len(held) > 1:
        last = -heapq.heappop(heap)  # none of the others lies in it
        held.discard(last)
        if page.parent[last] not in held:
            held.add(page.parent[last])
            heapq.heappush(heap, -page.parent[last])
    return held.pop()


def main_text(html: str | None) -> str:
    """The page's main text: its blocks, two line feeds between."""
    if not html:
        return ""
    page = _Lines.of(html)
    lines, dropped = page.lines, page.dropped()
    kept = [i for i, x in enumerate(dropped) if not x]
    if not kept:
        return ""
    ratios = np.array([0.0 if d else len(x.text) / max(x.tags, 1) for x, d in zip(lines, dropped, strict=True)])
    level = smoothed(ratios)
    cut = threshold(level)
    content = [i for i in kept if level[i] >= cut] or kept
    chars = [0] * len(page.kind)
    for i in content:
        chars[lines[i].container] += len(lines[i].text)
    for c in range(len(chars) - 1, 0, -1):  # a container's number is larger than its parent's
        chars[page.parent[c]] += chars[c]
    most = MOST * sum(len(lines[i].text) for i in content)
    region = max(c for c, n in enumerate(chars) if n >= most)
    marks = landmarks(page)
    held = {lines[i].container for i in content}
    if marks[region] >= 0:
        region = common(page, {c for c in held if marks[c] >= 0})
        region = region if marks[region] < 0 else marks[region]
    else:
        region = common(page, held)
    inside = [False] * len(page.kind)
    for c in range(len(inside)):
        inside[c] = c == region or c > 0 and inside[page.parent[c]]
    chosen = [i for i in kept if inside[lines[i].container]]
    if page.kind[region] in ("html", "body"):
        chosen = [i for i in chosen if not (level[i] < cut and 2 * lines[i].linked >= len(lines[i].text))
                  and (content[0] <= i <= content[-1] or lines[i].block in PROSE or 2 * ratios[i] >= cut)]
    # a headline beside the region, before it
    first = chosen[0]
    beside = [i for i in kept if i < first and lines[i].container == page.parent[region] and lines[i].block in HEADINGS
              and 2 * lines[i].linked < len(lines[i].text)]
    return "\n\n".join(lines[i].text for i in [*beside, *chosen])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points of text) of every page."""
    def make(column):
        texts = [main_text(x) for x in column.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

    given = fitted(pages, page_id="long", url="string", html="string")
    return extended(given, "html", {"text": "string", "n_chars": "long"}, make).select("page_id", "url", "text", "n_chars")
