"""Main text of HTML pages by tree scoring.

A page is read once by a tolerant tokeniser into a tree, with the elements that
HTML closes implicitly. Elements that are never the article (menus, page headers
and footers, sidebars, scripts, what is hidden) give no text. What is left is
cut in blocks at block elements.

Each block is a paragraph that has points: for being there, for its commas, and
for its length, discounted by the share of its characters that are links. Names
of classes and ids are evidence only, and say nothing of a heading. Outside a
marked article, a whole name such as "sidebar" drops its subtree, unless the
article is in it with most of the points; a part of a name ("cookie-notice",
"ad-slot") does unless most points of the page are there; parts that say how a
page looks ("has-sidebar", "category-legal") say nothing. Inside a marked article
only names that mean nothing else do ("ad", "cookie-bar"); others ("legal",
"related-work", "side-effects") leave it to what the element holds: links or
fields of a form, or neither a heading nor prose. Comments of readers are named
so by words that go together ("comment-list"; not "comments-by-darwin"), never
count as the page's points, and a "discussion" is one only if replies, authors
or fields are in it. A form counts as one by its points: around most of the page,
or around the article, it is a mere wrapper.

A block passes its points to the element that holds it, and fewer to each
ancestor. An element's score is discounted once more by the link density of its
whole subtree. The best element, or the main or else the article element around
it, is the container, so all articles and prose of one main element belong to it;
siblings of it that score well, or hold prose with few links, are kept as well.
All blocks of the kept subtrees are returned in page order. Lists of links are
left out where no article is around them, unless a heading calls them sources or
the like; in an article they are part of it. All steps are linear in the page.

Defined results: a null page counts as empty; a page without text gives an empty
text; repeated rows each get a row; null ids and urls stay null; broken markup,
a cut page, unclosed elements and very deep nesting are read as far as they go.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import small_batches

# Elements of HTML by their role here, and words of class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea xmp noembed noframes title".split())
DROPPED = frozenset("head nav footer aside button select option dialog menu svg object canvas audio video map datalist progress meter".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("button caption legend optgroup option select summary tbody td tfoot th thead title tr head body html li dd dt".split()) | {"li", "dd", "dt"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td th li dd dt blockquote figcaption caption summary center address".split()) | HEADINGS
#: What a start tag closes, up to the elements that bound it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promos promotion comment comments respond reply replies disqus discussion "
    "sidebar side widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "popup modal overlay newsletter subscribe subscription signup signin login share sharing social related recommended recommendations pagination pager skip toolbar copyright legal "
    "disclaimer hidden offscreen sitemap topbar tags outbrain taboola".split()
)
LIKELY = frozenset("article post entry content main story text body".split())
#: Parts of an article whose names sound unlikely.
OWN_PARTS = frozenset("header tags side banner".split())
#: First parts of names that say how a page looks or is filed.
STATES = frozenset("has no not with without is hide show category tag type format status".split())
READERS = frozenset("comment comments respond replies disqus".split())
TALK = frozenset("discussion discussions reply thread".split())
#: Words that go with those of readers' comments, and words that an article's own parts never have for a name.
WITH_READERS = frozenset("area author avatar block body box container content count counter entry facebook fb feed form group header footer inner item label layout link links list main meta module number page panel post reply respond section single story tab thread threads title tree user view widget wp wrap wrapper article".split())
ALIEN = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos cookie cookies consent gdpr newsletter popup modal outbrain taboola sidebar share sharing pagination pager breadcrumb breadcrumbs navbar hidden offscreen".split())
WITH_ALIEN = frozenset("area bar block bottom box button buttons container content holder image inline inner item left link links list module notice panel policy right row section signup slot tools top unit wrap wrapper post article entry".split())
#: Names of what only readers' comments hold.
SIGNS = frozenset("avatar gravatar reply replies permalink commenter upvote downvote".split())
FIELDS = frozenset("input select textarea button".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
MARKED = {"article": 2, "main": 1}
ENDS = tuple(".!?…:;\"'”’»)。！？")

_TAG = re.compile(r"""<!--(?:.*?-->|[^\0]*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMA = re.compile("[,،、，;；]")
_SOURCES = re.compile(r"(?:sources?|references?|bibliography|(?:foot)?notes?|literature|citations?|works cited|further reading|see also|(?:external |web)?links|credits)\W*", re.I)
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


#: What names say of an element: nothing; that it depends on what it holds; a part of one is unlikely, a whole one is; readers may speak there, or do; or it is no text at all.
NOTHING, HELD, PART, WHOLE, TALKED, COMMENTS, NEVER = range(7)


def _within(words: frozenset, parts: list[str], others: frozenset) -> bool:
    """Whether the first or last part is one of the words, and all others go with them."""
    return (parts[0] in words or parts[-1] in words) and all(p in words or p in others or p.isdigit() for p in parts)


def _named(names: str, in_article: bool) -> int:
    found = NOTHING
    for name in names.split():
        parts = _PARTS.findall(name)
        if not parts or len(parts) > 1 and parts[0] in STATES:
            continue
        first, last = parts[0], parts[-1]
        if _within(READERS, parts, WITH_READERS):
            return COMMENTS
        if _within(TALK, parts, WITH_READERS):
            found = max(found, TALKED)
        elif in_article:
            if _within(ALIEN, parts, WITH_ALIEN):
                found = max(found, WHOLE if len(parts) == 1 else PART)
            elif (first in UNLIKELY or last in UNLIKELY) and not (first in LIKELY and last in OWN_PARTS):
                found = max(found, HELD)
        elif first in READERS or last in READERS or first in TALK or last in TALK:
            continue
        elif len(parts) == 1:
            found = max(found, WHOLE * (first in UNLIKELY))
        elif first in UNLIKELY or last in UNLIKELY:
            found = max(found, PART)
    return found


def _evidence(tag: str, attributes: str, in_article: bool) -> tuple[int, int, bool]:
    """What speaks against an element, whether it marks the article (2) or the main part (1), and whether it is a sign of readers."""
    marked, sign = MARKED.get(tag, 0), False
    if tag in DROPPED or tag == "header" and not in_article:
        return NEVER, 0, False
    found = NOTHING
    if not attributes or tag in ("html", "body"):
        return found, marked, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value) or name == "role" and value in ROLES:
            return NEVER, 0, False
        if name == "role":
            marked = max(marked, MARKED.get(value, 0))
        if name in ("class", "id"):
            found = max(found, _named(value, in_article) if tag not in HEADINGS else NOTHING)
            sign = sign or any(p in SIGNS for p in _PARTS.findall(value))
    return (found if found == COMMENTS or not marked else NOTHING), marked, sign or found == COMMENTS


class _Page:
    """The tree of a page: for each node its element, parent, end and evidence, and the blocks of text."""

    def __init__(self, html: str):
        self.tags, self.parents, self.ends = ["#"], [0], [0]
        self.against, self.marks = [NOTHING], [0]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.links: list[int] = [0]  # links in each node itself
        self.fields: list[int] = [0]  # fields of forms, likewise
        self.signs: list[bool] = [False]
        self._open, self._dropped, self._articles, self._anchors = [0], 0, 0, 0
        self._holders, self._count = [0], Counter()  # open block elements; open elements by name
        self._text: list[str] = []
        self._linked: list[str] = []
        self._holder = 0
        self._read(html)

    def _flush(self):
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                linked = len(" ".join(unescape(" ".join(self._linked)).split())) if self._linked else 0
                self.blocks.append((self._holder, text, min(linked, len(text))))
        self._text, self._linked = [], []

    def _say(self, text: str):
        if self._dropped or not text:
            return
        if not self._text:
            self._holder = self._holders[-1]
        self._text.append(text)
        if self._anchors:
            self._linked.append(text)

    def _pop(self, depth: int):
        """Close all open elements from this depth on."""
        for i in reversed(self._open[depth:]):
            if self.tags[i] in BLOCKS:
                self._flush()
                self._holders.pop()
            self.ends[i] = len(self.tags)
            if self._dropped == i:
                self._dropped = 0
            self._count[self.tags[i]] -= 1
            self._articles -= self.marks[i] > 0
            self._anchors -= self.tags[i] == "a"
        del self._open[depth:]

    def _find(self, wanted, bounds) -> int:
        if not any(self._count[t] for t in wanted):
            return 0
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in wanted:
                return depth
            if tag in bounds:
                break
        return 0

    def _start(self, tag: str, attributes: str):
        if tag in CLOSES_P and (depth := self._find({"p"}, {"button", "table", "td", "th", "article", "section", "div", "body"})):
            self._pop(depth)
        if tag in CLOSES:
            while depth := self._find(*CLOSES[tag]):
                self._pop(depth)
        if tag in BLOCKS:
            self._flush()
        if tag == "br" or tag == "hr":
            self._say(" ")
        if tag in FIELDS and "hidden" not in attributes:
            self.fields[self._open[-1]] += 1
        if tag in VOID:
            return
        if tag == "a" and (depth := self._find({"a"}, BLOCKS)):
            self._pop(depth)
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.ends.append(0)
        self.links.append(0)
        self.fields.append(0)
        if tag == "a":
            self.links[self._open[-1]] += 1
        self._open.append(node)
        self._count[tag] += 1
        if tag in BLOCKS:
            self._holders.append(node)
        against, marked, sign = _evidence(tag, attributes, self._articles > 0)
        self.against.append(against)
        self.signs.append(sign)
        self.marks.append(marked)
        if against == NEVER and not self._dropped:
            self._dropped = node
        self._articles += marked > 0
        self._anchors += tag == "a"

    def _read(self, html: str):
        at, n = 0, len(html)
        while at < n:
            found = _TAG.search(html, at)
            if not found:
                self._say(html[at:])
                break
            if found.start() > at:
                self._say(html[at : found.start()])
            at = found.end()
            slash, tag, attributes = found.groups()
            if tag is None:
                if html.startswith("<![CDATA[", found.start()):
                    self._say(found[0][9:-3].replace("&", "&amp;"))
                continue
            tag = tag.lower()
            if slash:
                bounds = () if tag in BLOCKS else BLOCKS
                if depth := self._find({tag}, bounds):
                    self._pop(depth)
                continue
            self._start(tag, attributes)
            if tag in RAW:
                close = _CLOSE[tag].search(html, at)
                at = close.start() if close else n
        self._pop(1)
        self._flush()
        self.ends[0] = len(self.tags)


def _up(values: list, parents: list[int]) -> list:
    """Sums over subtrees; a node comes after its parent."""
    out = list(values)
    for i in range(len(out) - 1, 0, -1):
        out[parents[i]] += out[i]
    return out


def _down(own: list[bool], parents: list[int]) -> list[bool]:
    """Whether a node or an ancestor of it is marked."""
    out = list(own)
    for i in range(1, len(out)):
        out[i] = out[i] or out[parents[i]]
    return out


def _points(page: _Page, blocks) -> list[float]:
    out = []
    for node, text, link in blocks:
        plain = 0.1 if page.tags[node] in HEADINGS else 1 + len(_COMMA.findall(text)) + min(len(text) / 100, 3)
        out.append(plain * (1 - link / len(text)))
    return out


def _dead(page: _Page) -> list[bool]:
    """The nodes that names speak against, when points and what they hold are asked, and all within them."""
    n, tags, against, parents = len(page.tags), page.tags, page.against, page.parents
    if not any(against) and "form" not in tags:
        return [False] * n
    fields, signs = _up(page.fields, parents), _up([int(x) for x in page.signs], parents)
    talk = [a == COMMENTS or a == TALKED and (signs[i] > 0 or fields[i] > 0) for i, a in enumerate(against)]
    readers = _down(talk, parents)
    own, sizes, linked, prose = [0.0] * n, [0] * n, [0] * n, [0] * n
    for (node, text, link), gain in zip(page.blocks, _points(page, page.blocks)):
        own[node] += gain * (not readers[node])
        sizes[node] += len(text)
        linked[node] += link
        prose[node] += tags[node] in HEADINGS or (tags[node] in ("p", "pre", "blockquote") or text.endswith(ENDS)) and text.count(" ") > 1
    points, marked = _up(own, parents), _up([int(m > 0) for m in page.marks], parents)
    sizes, linked, prose = (_up(x, parents) for x in (sizes, linked, prose))
    unlikely = _down([PART <= a <= COMMENTS for a in against], parents)
    rest = sum(p for p, u in zip(own, unlikely) if not u)
    dead = [False] * n
    for i in range(1, n):
        most = 2 * points[i] > points[0]
        if dead[parents[i]] or talk[i]:
            dead[i] = dead[parents[i]] or points[0] > 0
        elif tags[i] == "form":
            dead[i] = not most and not marked[i]
        elif against[i] == WHOLE:
            dead[i] = not (most and (marked[i] or not rest))
        elif against[i] == PART:
            dead[i] = not most
        elif against[i] == HELD:
            dead[i] = not most and (3 * linked[i] >= sizes[i] or fields[i] > 0 or not prose[i])
    return dead


def _called_sources(page: _Page, blocks) -> set[int]:
    """The elements that follow a heading such as "Sources" (where the next block begins, up to what holds the heading)."""
    out, heading = set(), None
    for node, text, _ in blocks:
        if heading is not None:
            i, last = node, page.parents[heading]
            while i > last:
                out.add(i)
                i = page.parents[i]
        heading = node if page.tags[node] in HEADINGS and _SOURCES.fullmatch(text) else None
    return out


def main_text(html: str) -> str:
    """The main text of a page, its blocks joined by newlines."""
    page = _Page(html)
    dead = _dead(page)
    blocks = [b for b in page.blocks if not dead[b[0]]]
    if not blocks:
        return ""
    n, tags, parents, marks = len(page.tags), page.tags, page.parents, page.marks
    points, sizes, linked, prose = [0.0] * n, [0] * n, [0] * n, [0] * n
    for (node, text, link), gain in zip(blocks, _points(page, blocks)):
        sizes[node] += len(text)
        linked[node] += link
        prose[node] += tags[node] not in HEADINGS and (tags[node] in ("p", "pre", "blockquote") or text.endswith(ENDS) and text.count(" ") > 1)
        holder = parents[node] if tags[node] in PARAGRAPHS else node
        for level in range(5):
            points[holder] += gain if not level else gain / (2 if level == 1 else 3 * level)
            if not holder:
                break
            holder = parents[holder]
    sizes, linked, prose, links = (_up(x, parents) for x in (sizes, linked, prose, page.links))
    density = [a / b if b else 0.0 for a, b in zip(linked, sizes)]
    scores = [p * (1 - d) for p, d in zip(points, density)]
    best = max(range(n), key=lambda i: (scores[i], -i))
    container, i = best, best
    while i:  # the outermost main, or else article, around it
        if marks[i] == 1 or marks[i] == 2 and marks[container] != 1:
            container = i
        i = parents[i]
    least, loose = max(2.0, 0.2 * scores[best]), parents[container]
    kept = [False] * n
    kept[container] = True
    if container:
        for i in range(loose + 1, page.ends[loose]):
            if i == container or parents[i] != loose or not sizes[i]:
                continue
            paragraph = tags[i] in PARAGRAPHS and tags[i] not in ("li", "td", "th")
            few_links = density[i] < 0.25
            if scores[i] >= least and density[i] < 0.5 or few_links and (paragraph or not marks[container] and prose[i]):
                kept[i] = True
    kept = _down(kept, parents)
    menus = [False] * n
    if marks[container] != 2:
        inside = _down([m == 2 for m in marks], parents)
        called = _called_sources(page, blocks)
        menus = _down([tags[i] in ("ul", "ol", "dl", "div", "table", "p") and links[i] >= 3 and density[i] >= 0.8 and not inside[i] and i not in called for i in range(n)], parents)
    beside = lambda node, text, link: container and node == loose and tags[loose] != "#" and 4 * link < len(text)
    return "\n".join(text for node, text, link in blocks if (kept[node] or beside(node, text, link)) and not menus[node])


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) if x else "" for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each page."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
