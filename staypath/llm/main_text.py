"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of elements from the root. Text length and punctuation are summed
up per path and divided by the path's blocks; both series are smoothed over the blocks in page order and multiplied, and
paths below the standard deviation of the products are no content. The element that holds the content paths' text (an
article or main element where there is one) is the article: its other blocks stay too, unless most of a block is link text.
Elements that name themselves as something else (tags such as nav and form, roles, words of class and id) are left out
before; if nothing else is on a page, words of class and id are not asked.
"""

import html
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PUNCTUATION = re.compile(r"[.,;:!?…、。！，：；？،؛؟।]")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul caption button".split())
CLOSED_BY = {name: frozenset(others.split()) for name, others in {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "thead": "tbody tfoot",
    "tbody": "thead tbody tr td th", "tfoot": "thead tbody tr td th", "option": "option", "optgroup": "optgroup option",
    "body": "head"}.items()}
#: an element is not closed from inside these
SCOPES = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
TABLE = frozenset(["table"])
SECTIONS = frozenset("html body div section main article center table tbody tr td blockquote".split())

# Elements, roles and words of class and id that are not part of an article.
OTHER_TAGS = frozenset("head nav aside form button select menu dialog template svg math canvas object audio video search fieldset".split())
PAGE_ENDS = frozenset(["header", "footer"])
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promotions "
    "nav navbar navi navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside widget widgets "
    "footer header masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay banner "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations "
    "pagination pager copyright disclaimer skip hidden teaser teasers trackback trackbacks pingback".split())
#: class words such as has-sidebar say something about the element, not what it is
ABOUT = ("has", "with", "no", "without", "is", "not", "js")

KERNEL = np.array([1.0, 2.0, 4.0, 2.0, 1.0])
#: share of the content that the article's element holds, and of link text that makes a block a list of links
HOLDS, LINKS = 0.9, 0.5


class Element:
    __slots__ = ("name", "parent", "path", "other", "named", "block", "link", "weight")

    def __init__(self, name, parent, path, other, named, block, link):
        self.name, self.parent, self.path, self.other, self.named, self.block, self.link, self.weight = name, parent, path, other, named, block, link, 0


def _words(value: str):
    """Lower-cased words of a class or id value, without those that only say what else there is."""
    for name in value.split():
        parts = WORD.findall(CAMEL.sub("-", name).lower())
        if parts and parts[0] not in ABOUT:
            yield from parts
            yield from WORD.findall(name.lower())


class Page:
    """Blocks of a page in page order: text, element, length without white space, share of link text."""

    def __init__(self, source: str):
        self.paths: dict[tuple, int] = {}
        self.elements = [Element("", None, -1, False, False, True, False)]
        self.texts, self.owners, self.linked = [], [], []
        self._parts, self._links = [], 0
        self._read(source)

    def _push(self, name, rest, top):
        other, named, hidden = name in OTHER_TAGS, False, False
        article = top
        if name in PAGE_ENDS:
            while article is not None and article.name not in ("article", "main"):
                article = article.parent
            other = name == "footer" or article is None
        label = name
        if rest and not rest.isspace():
            values = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}
            kinds = values.get("class", "")
            if name not in ("html", "body", "article", "main"):
                named = any(w in OTHER_WORDS for w in chain(_words(kinds), _words(values.get("id", ""))))
            other |= values.get("role", "").lower() in OTHER_ROLES
            hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
            if kinds:
                label += "." + ".".join(sorted(set(WORD.findall(kinds.lower()))))
        block = name in BLOCKS
        path = self.paths.setdefault((top.path, label), len(self.paths)) if block else top.path
        made = Element(name, top, path, top.other or other or hidden, top.named or named, block, top.link or name == "a")
        self.elements.append(made)
        return made

    def _flush(self, top):
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                while not top.block:
                    top = top.parent
                self.texts.append(text)
                self.owners.append(top)
                self.linked.append(self._links)
            self._parts, self._links = [], 0

    def _said(self, text, top):
        """Text inside an element; what is left out anyway is not kept, except by class and id."""
        if not top.other:
            text = html.unescape(text)
            self._parts.append(text)
            if top.link:
                self._links += len("".join(text.split()))

    def _closed(self, top, names, scope):
        """The element above the innermost open one of ``names``, ``top`` itself if none is open inside ``scope``."""
        at = top
        while at.parent is not None and at.name not in scope:
            if at.name in names:
                return at.parent
            at = at.parent
        return top

    def _leave(self, top, above):
        while top is not above:
            if top.block:
                self._flush(top)
            self.open[top.name] -= 1
            top = top.parent
        return above

    def _read(self, source):
        top, at, n = self.elements[0], 0, len(source)
        self.open: dict[str, int] = {}
        own: tuple[bool, bool] = (False, False)
        while at < n:
            low = source.find("<", at)
            if low < 0:
                self._said(source[at:], top)
                break
            found = TAG.match(source, low)
            if found is None:  # a bare "<"
                self._said(source[at:low + 1], top)
                at = low + 1
                continue
            if low > at:
                self._said(source[at:low], top)
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["close"]:
                if name == "br":
                    self._said(" ", top)
                elif self.open.get(name):
                    block = name in BLOCKS
                    # the end of an inline element does not close a block
                    above = top
                    while above.name != name and (block or not above.block):
                        above = above.parent
                    if above.name == name:
                        top = self._leave(top, above.parent)
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else n
                if name == "noscript" and end is None:
                    at = found.end()
                continue
            if name in ("br", "wbr"):
                self._said(" " if name == "br" else "", top)
                continue
            block = name in BLOCKS
            if block:
                if self.open.get("p") and name not in ("button",):
                    top = self._leave(top, self._closed(top, ("p",), TABLE | {"button"}))
                closing = CLOSED_BY.get(name)
                while closing and any(self.open.get(c) for c in closing):
                    above = self._closed(top, closing, SCOPES.get(name, TABLE))
                    if above is top:
                        break
                    top = self._leave(top, above)
                self._flush(top)
            if name in VOID:
                continue
            before = top
            top = self._push(name, found["rest"], top)
            self.open[name] = self.open.get(name, 0) + 1
            if not block and (top.other, top.named) != (before.other, before.named):
                self._flush(before)
                top.block = True  # an inline advert is a block of its own
        while top is not None:
            if top.block:
                self._flush(top)
            top = top.parent

    def blocks(self, named: bool):
        """Numbers of the blocks that are not left out by what their elements say they are."""
        return [i for i, e in enumerate(self.owners) if not e.other and not (named and e.named)]


def content_paths(paths: np.ndarray, lengths: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Mask of the blocks whose path is content: smoothed ratios of text and punctuation per path, multiplied."""
    _, at, n = np.unique(paths, return_inverse=True, return_counts=True)
    text, mark = np.bincount(at, lengths) / n, np.bincount(at, marks) / n
    smooth = lambda x: np.convolve(x, KERNEL)[2:-2] / np.convolve(np.ones(len(x)), KERNEL)[2:-2]
    fused = np.bincount(at, smooth(text[at]) * (1.0 + smooth(mark[at]))) / n
    return fused[at] >= fused[at].std()


def main_text(source: str | None) -> str:
    """The article of a page: its blocks, one a line. Empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    kept = page.blocks(named=True) or page.blocks(named=False)
    if not kept:
        return ""
    owners = [page.owners[i] for i in kept]
    lengths = np.array([len(page.texts[i]) - page.texts[i].count(" ") for i in kept], dtype=float)
    marks = np.array([len(PUNCTUATION.findall(page.texts[i])) for i in kept], dtype=float)
    links = np.array([page.linked[i] for i in kept]) > LINKS * lengths
    content = content_paths(np.array([e.path for e in owners]), np.where(links, 1.0, lengths), np.where(links, 0.0, marks)) & ~links
    if not content.any():
        content = ~links if not links.all() else np.ones(len(kept), dtype=bool)
    for e, weight, good in zip(owners, lengths, content):
        if good:
            e.weight += weight
    for e in reversed(page.elements[1:]):  # made after their parents
        e.parent.weight += e.weight
    total = page.elements[0].weight
    articles = [e for e in page.elements if e.name == "article" and e.weight] or [e for e in page.elements if e.name == "main" and e.weight]
    inside = set()
    if articles:
        most = max(e.weight for e in articles)
        inside = {id(e) for e in articles if 2 * e.weight >= most}
    else:
        below = {}
        for e in page.elements[1:]:
            if e.weight >= HOLDS * total and e.name in SECTIONS:
                below[id(e.parent)] = e
        home = page.elements[0]
        while id(home) in below:
            home = below[id(home)]
        inside = {id(home)}
    held = {id(page.elements[0]): id(page.elements[0]) in inside}
    for e in page.elements[1:]:
        held[id(e)] = id(e) in inside or held[id(e.parent)]
    return "\n".join(page.texts[i] for i, e, good, link in zip(kept, owners, content, links) if held[id(e)] and (good or not link))


ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(batches):
    for batch in batches:
        for low in range(0, len(batch), 256):
            rows = batch.slice(low, 256)
            texts = [main_text(source) for source in rows.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=ROWS)


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``: the article of the whole ``html`` and its code points.

    Character references are decoded, white space inside a block is one space, blocks are joined by one line feed in page
    order. Null, empty and other pages without an article have an empty text; repeated rows and rows without id stay as
    they are. Each page is read by itself, so nothing is shuffled.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint")
