"""Main text of web pages from streaming parser events and text-to-tag ratios.

The standard library's parser turns a page into lines, one per block of text, and
counts the tags of each.  The ratio of text to tags is smoothed over neighbouring
lines with a Gaussian, and lines above a threshold of the page's own spread are
content; they select the regions to keep (the article elements of the page that hold
most of the content, or else the stretch of the body that the content spans).  Blocks
that are no part of an article by element or by name (menus, headers, footers, sidebars,
notices, adverts, forms, comments) are left out whatever their ratio; a name that only
says what an element has or hasn't, or that stands on a heading or around the page's main
part, names no such block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import texts_as_bytes, with_arrow_columns
from .registry import register

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose begin and end separate blocks of text.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot
thead tr ul caption title head""".split())
#: Elements that are no part of an article's text.
OUTSIDE = frozenset("""head title script style noscript template svg math iframe object canvas audio video map nav menu header
footer aside form button select option textarea input label fieldset datalist dialog""".split())
#: Words of class, id and role that name such parts.
NAMES = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos
promotion promotions banner banners menu menus nav navs navbar navigation breadcrumb breadcrumbs sidebar sidebars side-bar aside
header masthead topbar footer foot bottombar cookie cookies consent gdpr notice notices alert alerts popup popups modal modals
overlay newsletter newsletters subscribe subscription signup login share sharing social related recommend recommended
recommendation recommendations comment comments commentlist disqus replies responses copyright complementary contentinfo search
searchbox pagination pager widget widgets toolbar skip-link skiplink sr-only""".split())
#: Words that make a class say what an element has, hasn't or does, not what it is.
ABOUT = frozenset("has have no not non with without is are can allow allows enable enables show shows hide hides".split())
STATES = frozenset("enabled disabled on off open opened closed count counts allowed visible hidden active inactive true false left right".split())
DIGITS = re.compile(r"\d+$")
HUMP = re.compile("(?<=[a-z])(?=[A-Z])")  # topNav: top-Nav
#: An end tag that such a start tag implies for an open element of the second kind.
IMPLIED = {"p": "p", "li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "option": "option"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLANKS = re.compile(r"\s+")
RADIUS, SIGMA = 2, 1.0
KERNEL = [math.exp(-k * k / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
#: A line is content above this share of the standard deviation of the smoothed ratios.
SPREAD = 0.5
#: A smoothed ratio from which a line is content whatever the spread: one huge block doesn't outweigh the others.
ENOUGH = 40.0
#: Content beside the article elements that many times theirs: they are teasers.
BESIDE = 2
#: A line whose text is links by more than this share is no content outside article elements.
LINKS = 0.5
PIECE = 1 << 16


def names_part(names: str) -> bool:
    """Whether a class, id or role names a part of a page that is no article.

    Each name is taken by itself, cut at hyphens, underscores and humps."""
    for name in names.split():
        words = [DIGITS.sub("", w) for w in re.split(r"[_-]+", HUMP.sub("-", name).lower()) if w]
        if not words or words[0] in ABOUT or words[-1] in STATES:
            continue
        pairs = {f"{a}-{b}" for a, b in zip(words, words[1:])}
        if any(w in NAMES for w in words) or pairs & NAMES:
            return True
    return False


class Line:
    __slots__ = ("text", "tags", "links", "region", "heading", "part", "ratio")

    def __init__(self, text: str, tags: int, links: int, region: int, heading: bool, part: int):
        self.text, self.tags, self.links, self.region, self.heading, self.part = text, tags, links, region, heading, part
        self.ratio = len(text) / max(1, tags)


class LineParser(HTMLParser):
    """Collects lines of text outside excluded elements; lines within parts excluded by name know which."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, excluded, article element, part by name
        self.names: Counter[str] = Counter()                # open elements by tag
        self.excluded = self.articles = self.anchors = 0
        self.region = self.regions = 0
        self.part = 0                                       # innermost open part by name (0: none)
        self.around = [0]                                   # per part the one around it
        self.main: set[int] = set()                         # innermost parts around a main element or first heading
        self._clear()

    def _clear(self) -> None:
        self.parts: list[str] = []
        self.tags = self.link_chars = 0
        self.heading = False

    def _flush(self) -> None:
        if self.parts:
            text = BLANKS.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append(Line(text, self.tags, self.link_chars, self.region, self.heading, self.part))
        self._clear()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if (closes := IMPLIED.get(tag)) is not None and (self.names[tag] or self.names[closes]):
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if name == tag or name == closes:
                    self._close(k)
                    break
                if name in BLOCKS and name not in HEADINGS:
                    break
        if tag in BLOCKS:
            self._flush()
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        if tag in ("td", "th"):
            self.parts.append(" ")
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        out = tag in OUTSIDE or any(a == "hidden" or a == "aria-hidden" and v == "true" for a, v in attrs)
        part = not out and bool(names) and tag not in ("html", "body", "main") and tag not in HEADINGS and (
            tag != "article" or self.articles > 0) and names_part(names)
        article = not out and not part and not self.excluded and (tag in ("article", "main") or "main" in re.split(r"[\s_-]+", HUMP.sub("-", names)))
        if article and not self.articles:
            self.regions += 1
            self.region = self.regions
        if tag == "main" or tag == "h1":
            self.main.add(self.part)
        if part:
            self.around.append(self.part)
            self.part = len(self.around) - 1
        self.open.append((tag, out, article, part))
        self.names[tag] += 1
        self.excluded += out
        self.articles += article
        self.anchors += tag == "a"
        self.heading = self.heading or tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.names[tag]:
            k = len(self.open) - 1
            while self.open[k][0] != tag:
                k -= 1
            self._close(k)
        elif tag in BLOCKS:
            self._flush()

    def _close(self, k: int) -> None:
        """Ends the k-th open element and all that it holds."""
        if any(x[0] in BLOCKS or x[3] for x in self.open[k:]):
            self._flush()
        for tag, out, article, part in self.open[k:]:
            self.names[tag] -= 1
            self.excluded -= out
            self.articles -= article
            self.anchors -= tag == "a"
        for x in reversed(self.open[k:]):
            if x[3]:
                self.part = self.around[self.part]
        del self.open[k:]
        if not self.articles:
            self.region = 0

    def handle_data(self, data: str) -> None:
        if not self.excluded:
            self.parts.append(data)
            if self.anchors:
                self.link_chars += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """Marked sections are no text."""

    def parse_html_declaration(self, i: int) -> int:
        # other marked sections than CDATA are comments to a browser
        if self.rawdata.startswith("<![", i) and not self.rawdata.startswith("<![CDATA[", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def finish(self) -> list[Line]:
        if re.match(r"<[a-zA-Z/!?]", self.rawdata):  # a tag or comment that never ends is no text
            self.rawdata = ""
        self.close()
        self._flush()
        return self.lines


def smoothed(values: list[float]) -> list[float]:
    """Gaussian mean over neighbouring lines; at the ends over those there are."""
    out = []
    for i in range(len(values)):
        low, high = max(0, i - RADIUS), min(len(values), i + RADIUS + 1)
        weights = KERNEL[low - i + RADIUS:high - i + RADIUS]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def without_parts(lines: list[Line], around: list[int], main: set[int]) -> list[Line]:
    """Lines outside the parts excluded by name.

    A part that holds the page's main element or first heading and most of its text is a
    wrapper whose name means something else: it excludes nothing."""
    held, has_main = [0] * len(around), [k in main for k in range(len(around))]
    for line in lines:
        held[line.part] += len(line.text)
    for k in range(len(around) - 1, 0, -1):      # inner parts have larger numbers
        held[around[k]] += held[k]
        has_main[around[k]] |= has_main[k]
    open_to = [True] * len(around)
    for k in range(1, len(around)):
        open_to[k] = open_to[around[k]] and has_main[k] and 2 * held[k] > held[0]
    return [line for line in lines if open_to[line.part]]


def main_text(html: str) -> str:
    """The blocks of the selected regions, one a line (empty if none)."""
    parser = LineParser()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at:at + PIECE])
    lines = without_parts(parser.finish(), parser.around, parser.main)
    if not lines:
        return ""
    ratios = smoothed([line.ratio for line in lines])
    mean = sum(ratios) / len(ratios)
    threshold = min(ENOUGH, SPREAD * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)))
    content = [r >= threshold for r in ratios]
    plain = [c and line.links <= LINKS * len(line.text) for c, line in zip(content, lines)]
    inside, beside = (sum(len(line.text) for line, c in zip(lines, plain) if c and bool(line.region) == r) for r in (True, False))
    if any(line.region for line in lines) and beside <= BESIDE * inside:
        # article elements with content are kept whole: short blocks belong to them
        chosen = {line.region for line, c in zip(lines, content) if c and line.region}
        chosen = chosen or {line.region for line in lines if line.region}
        return "\n".join(line.text for line in lines if line.region in chosen)
    found = [i for i, c in enumerate(plain) if c and not lines[i].region] or [i for i, c in enumerate(plain) if c]
    if not found:
        return ""
    first, last = found[0], found[-1]
    while first and lines[first - 1].heading and not lines[first - 1].region:
        first -= 1
    teasers = any(not lines[i].region for i in found)
    return "\n".join(line.text for line in lines[first:last + 1]
                     if line.links <= LINKS * len(line.text) and not (teasers and line.region))


def with_main_text(pages: DataFrame, html_col: str = "html", name: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """``pages`` less ``without``, plus the main text of each whole page.

    A null or empty html, and a page without content, give the empty text.  Repeated
    rows each come back; an empty table gives no rows."""
    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([main_text((raw or b"").decode()) for raw in texts_as_bytes(batch, html_col)], pa.string())]
        return compute
    return with_arrow_columns(pages, start, [(name, T.StringType())], without)


@register("op10_html")
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return with_main_text(pages, without=("html",)).withColumn("n_chars", F.length("text").cast("long"))
