"""HTML extraction: parser events, text-to-tag ratio per line, smoothing, threshold clusters."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their meaning in the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video select option datalist".split())
_ASIDE = frozenset("nav header footer aside form menu dialog button label textarea fieldset".split())
_BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html"
    " legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_MAIN = frozenset("article main".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold blocks of text rather than being one.
_CONTAINER = frozenset("html body div section article main center form header footer nav aside fieldset details dialog td".split())
_CLOSES_P = _BLOCK | _ASIDE
#: Words of class, id and role that name what isn't the article.
_OTHER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|cookie|cookies"
    r"|consent|gdpr|notice|notices|alert|popup|modal|overlay|nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs"
    r"|sidebar|side|aside|footer|header|masthead|comment|comments|disqus|reply|replies|related|share|sharing|social"
    r"|newsletter|subscribe|subscription|login|signup|search|pagination|pager|toolbar|widget|complementary|contentinfo)"
    r"(?:$|[\s_-])",
    re.I,
)
#: Class words that say how something is laid out, not what it is.
_MODIFIER = re.compile(
    r"(?:^|(?<=\s))(?:(?:has|with|without|no|is|show|hide)[-_]\S*|\S*[-_](?:fixed|sticky|open|closed|enabled|disabled|visible|hidden|layout))(?=\s|$)",
    re.I,
)
#: Words of names that no wrapper of the main text has.
_NEVER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w+|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|comments?|disqus|repl\w+|related"
    r"|shar\w+|social|newsletter|login|signup|search|pagination|pager|breadcrumbs?)(?:$|[\s_-])",
    re.I,
)
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class ExtractParams:
    """Lines' ratios are smoothed by a Gaussian of deviation ``sigma`` lines; lines from
    ``threshold`` standard deviations of all ratios upwards are content. ``hint``: what the ratio
    of a line counts for whose elements are named as something other than the article. ``share``:
    of a cluster's text that its region holds at least."""

    sigma: float = 1.0
    threshold: float = 1.0
    hint: float = 0.0
    share: float = 0.8


@dataclass(slots=True)
class Line:
    """Text of a block, the tags since the line before, the element that it stands in."""

    text: str
    tags: int
    element: int
    heading: bool


class _Lines(HTMLParser):
    """A page as lines: a line is the text of a block between block boundaries."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.tag = ["#page"]  # by element: its name, the element around it,
        self.around = [-1]
        self.aside = [-1]  # the nearest aside that it is or is in,
        self.main = [0]  # and the outermost article or main element that it is or is in
        self.outer_aside: dict[int, int] = {}  # by aside: the next one around it
        self.may_wrap: dict[int, bool] = {}  # by aside: may be a wrapper of the page's text
        self.holders: set[int] = set()  # asides around a main element
        self.open: list[tuple[int, bool]] = [(0, False)]  # element, unseen
        self.parts: list[str] = []
        self.tags = 0
        self.heading = False

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append(Line(text, self.tags, self.open[-1][0], self.heading))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P or tag == "br":
            if tag == "br":
                self.parts.append(" ")
            else:
                self.end_line()
                self.close_paragraph(tag)
                self.heading = tag in _HEADING
        self.tags += 1
        if tag in _VOID:
            return
        around, unseen = self.open[-1]
        here, aside, main = len(self.tag), self.aside[around], self.main[around]
        outermost = tag in ("html", "body", "main") or (tag == "article" and not main)
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        other = not outermost and bool(named) and bool(_OTHER.search(_MODIFIER.sub(" ", named)))
        if tag == "main":
            at = aside
            while at >= 0:
                self.holders.add(at)
                at = self.outer_aside[at]
        if other or (tag in _ASIDE and not (tag == "header" and main)):
            self.may_wrap[here] = (tag == "form" or tag not in _ASIDE) and not main and not _NEVER.search(named)
            self.outer_aside[here] = aside
            aside = here
        self.tag.append(tag)
        self.around.append(around)
        self.aside.append(aside)
        self.main.append(main or (here if tag in _MAIN else 0))
        if any(k == "hidden" for k, _ in attrs) and tag not in ("html", "body"):
            unseen = True
        self.open.append((here, unseen or tag in _UNSEEN))

    def close_paragraph(self, tag):
        """A block ends an open paragraph (and a list item ends the one before it)."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[at][0]]
            if name == "p" or (name == "li" and tag == "li"):
                del self.open[at:]
                return
            if name in _BLOCK or name in _ASIDE:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.tag[self.open[-1][0]] == tag and tag in ("svg", "math"):
            self.open.pop()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in _CLOSES_P:
            self.end_line()
            self.heading = False
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[at][0]]
            if name == tag:
                del self.open[at:]
                return
            if tag not in _CLOSES_P and tag not in _UNSEEN and (name in _CLOSES_P):
                return

    def parse_marked_section(self, i, report=1):
        """Sections of kinds that the base class refuses are comments up to the next ``>``."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if not self.open[-1][1]:
            self.parts.append(data)

    def finish(self) -> list[Line]:
        if self.rawdata.startswith("<!"):  # a comment without an end lasts to the end
            self.rawdata = ""
        self.close()
        self.end_line()
        return self.lines

    def within(self, element: int) -> Iterator[int]:
        """The element and those around it, from the inside out."""
        while element >= 0:
            yield element
            element = self.around[element]

    def sums(self, parts: Iterable[tuple[int, int]]) -> list[int]:
        """By element: the sum of the (element, number) parts in it. Elements come after those around them."""
        out = [0] * len(self.tag)
        for element, n in parts:
            out[element] += n
        for e in range(len(out) - 1, 0, -1):
            out[self.around[e]] += out[e]
        return out

    def asides(self, element: int) -> Iterator[int]:
        at = self.aside[element]
        while at >= 0:
            yield at
            at = self.outer_aside[at]


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    """Gaussian-weighted mean over neighbouring lines, weights renormalised at both ends."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for x in range(len(ratios)):
        near = range(max(0, x - reach), min(len(ratios), x + reach + 1))
        weights = [kernel[abs(y - x)] for y in near]
        out.append(sum(w * ratios[y] for w, y in zip(weights, near, strict=True)) / sum(weights))
    return out


def clusters(content: list[bool]) -> list[range]:
    """The runs of lines that are content."""
    edges = [k for k in range(len(content) + 1) if (k < len(content) and content[k]) != (k > 0 and content[k - 1])]
    return [range(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _hinted(page: _Lines) -> list[bool]:
    """Whether each line is within an aside that isn't a mere wrapper.

    Where no article or main element is outside of all asides, a named element or form is a mere
    wrapper if it holds the main element, or more text than is left outside of asides."""
    lines = page.lines
    if any(page.main[x.element] and page.aside[x.element] < 0 for x in lines):
        return [page.aside[x.element] >= 0 for x in lines]
    free: set[int] = set()
    while True:
        inside, outside = Counter(), 0
        for x in lines:
            left = [a for a in page.asides(x.element) if a not in free]
            if not left:
                outside += len(x.text)
            elif all(page.may_wrap[a] for a in left):
                inside.update(dict.fromkeys(left, len(x.text)))
        wraps = (w for w, may in page.may_wrap.items() if may and w not in free and (w in page.holders or inside[w] > outside))
        found = next(wraps, None)
        if found is None:
            break
        free.add(found)
    return [any(a not in free for a in page.asides(x.element)) for x in lines]


def _region(page: _Lines, lines: list[Line], content: list[bool], rich: list[bool], p: ExtractParams) -> int:
    """The element that the largest cluster of content lines shows to hold the article.

    It is the innermost container of most of the cluster's text, or one around it as long as what
    that adds is for the most part content or headings too."""
    largest = max(clusters(content), key=lambda run: sum(len(lines[k].text) for k in run))
    holds = page.sums((lines[k].element, len(lines[k].text)) for k in largest)
    region = max(e for e, n in enumerate(holds) if n >= p.share * holds[0] and (e == 0 or page.tag[e] in _CONTAINER))
    text = page.sums((x.element, len(x.text)) for x in lines)
    good = page.sums(
        (x.element, len(x.text)) for x, c, r in zip(lines, content, rich, strict=True) if (c and r) or x.heading
    )
    for e in page.within(region):
        if 2 * (good[e] - good[region]) > text[e] - text[region]:
            region = e
    return region


def main_text(html: str | None, p: ExtractParams = ExtractParams()) -> str:
    """The main text of a page.

    Each line has the ratio of its text to its tags, smoothed over its neighbours; lines from the
    threshold upwards are content, and the largest run of them leads to the region that the article
    stands in, whatever its elements are called. An article or main element around that region is
    the region, and others that hold content belong to it: all their lines are the article's, short
    paragraphs and headings too. In any other region the article goes from the first to the last
    content line, with headings and lines of the same container before and after.

    Elements and names of menus, headers, footers, sidebars, notices, adverts, forms and comments
    are hints: their lines' ratios don't count, and they don't go with the lines around them,
    unless what is named so is a wrapper of the page's text. Names that only say how a wrapper is
    laid out don't count, and where all lines would be hinted at, none is, unless the page has an
    article or main element, which is empty then."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    every = page.finish()
    apart = _hinted(page)
    if all(apart):
        if any(tag in _MAIN for tag in page.tag):
            return ""
        apart = [False] * len(every)
    if not every:
        return ""
    ratios = [len(x.text) / max(1, x.tags) * (p.hint if a else 1.0) for x, a in zip(every, apart, strict=True)]
    soft = smoothed(ratios, p.sigma)
    mean = sum(soft) / len(soft)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in soft) / len(soft))
    cut = min(p.threshold * deviation, max(x for x, a in zip(soft, apart, strict=True) if not a))
    lines = [x for x, a in zip(every, apart, strict=True) if not a]
    content = [x >= cut for x, a in zip(soft, apart, strict=True) if not a]
    rich = [x >= cut for x, a in zip(ratios, apart, strict=True) if not a]
    region = _region(page, lines, content, rich, p)
    main = page.main[region]
    if main:
        regions = {page.main[x.element] for x, c in zip(lines, content, strict=True) if c}
        return " ".join(x.text for x in lines if page.main[x.element] in regions and page.main[x.element])
    return " ".join(x.text for x in _from_first_to_last(page, lines, content, rich, region))


def _from_first_to_last(page: _Lines, lines: list[Line], content: list[bool], rich: list[bool], region: int) -> list[Line]:
    """The region's lines from the first to the last of content, and what belongs to them at the edges."""
    box, within = [0], [region == 0]  # by element: its container, and whether it is in the region
    for e in range(1, len(page.tag)):
        box.append(e if page.tag[e] in _CONTAINER else box[page.around[e]])
        within.append(e == region or within[page.around[e]])
    hits = [k for k, x in enumerate(lines) if content[k] and within[x.element]]
    hits = [k for k in hits if rich[k]] or hits
    near = {box[lines[k].element] for k in hits} | {region}
    boxes = {e for e in near if page.tag[e] not in ("#page", "html", "body")}
    first, last = hits[0], hits[-1]

    def belongs(k: int) -> bool:
        if not 0 <= k < len(lines) or not within[lines[k].element]:
            return False
        here = box[lines[k].element]
        return here in boxes or (content[k] and here in near)

    while belongs(first - 1) or (first and lines[first - 1].heading and within[lines[first - 1].element]):
        first -= 1
    while belongs(last + 1):
        last += 1
    return [x for x in lines[first : last + 1] if within[x.element]]


def extract(
    pages: DataFrame, params: ExtractParams | None = None, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """page_id (under the name of ``id_col``), the ``keep`` columns, text and n_chars (code points)
    of every row.

    Null and empty pages and those without content have the empty text. Character references are
    decoded, white space within a block is one space, blocks come in page order, joined by one
    space. Rows are read one by one, whole, whatever their ids; an empty table gives an empty
    result. Other columns are ignored."""
    p = params or ExtractParams()
    chosen = pages.select(F.col(id_col).alias("page_id"), *keep, F.col(html_col).alias("html"))
    kinds = dict(chosen.dtypes)

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), p) for h in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], *(batch[c] for c in keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", *keep, "text", "n_chars"],
            )

    schema = f"page_id {kinds['page_id']}, " + "".join(f"{c} {kinds[c]}, " for c in keep) + "text string, n_chars long"
    return chosen.mapInArrow(run, schema).withColumnRenamed("page_id", id_col)
