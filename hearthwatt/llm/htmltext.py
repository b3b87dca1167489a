"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to the elements above them, less for higher ones;
an element's points shrink with the share of its text that is links. The element with most
points holds the main text, together with those siblings that also have many.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.frames import kept_apart, map_rows, text_or_empty

# Fixed values of HTML: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp noembed".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these names, up to the nearest of the stops.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
STOPS = frozenset("ul ol dl table td th div article section main body html".split())

#: Elements that never hold main text.
OUTSIDE = frozenset(
    "head nav footer aside form script style noscript template iframe button select textarea input label "
    "svg canvas object audio video menu dialog title search noframes xmp noembed fieldset".split()
)
#: Words in a class, id or role that mark what isn't the article.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary consent contentinfo cookie cookies disqus footer gdpr header masthead menu menubar "
    "modal nav navbar navigation newsletter notice pagination pager popup promo promoted related reply replies "
    "respond share sharing sidebar sidebars social sponsor sponsored subscribe subscription toolbar topbar widget "
    "alert announcement search".split()
)
KEPT_WORDS = frozenset("article content entry main post story text body".split())
#: Words that beside a word from OUTSIDE_WORDS don't change what it says.
PLAIN_WORDS = frozenset(
    "area articles bar block bottom box button buttons card cards col column container form global group icons inner "
    "item items left link links list message module outer overlay page panel policy posts primary right row secondary "
    "section signup site slot stories strip tags title top unit wrap wrapper zone".split()
)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<odd_close>/?)(?P<odd_name>[a-zA-Z][^\s/>]*)(?P<odd_attributes>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z/][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WHITE = re.compile(r"[ \t\n\r\f\v ]+")

#: What a sibling of the best element needs: a share of its points, or being a paragraph of so
#: many characters with few links.
SIBLING_SHARE = 0.2
SIBLING_CHARACTERS = 80
SIBLING_LINKS = 0.25
#: Points of an element that a name may put outside the article, and the share of links from
#: which it then is.
SUSPECT_POINTS, SUSPECT_LINKS = 0.5, 0.5
#: Beside paragraphs that stand in the page itself, a list with such a share of links is a menu.
MENU_LINKS = 0.8


@dataclass(slots=True)
class Element:
    name: str
    parent: int
    outside: bool
    content: bool
    suspect: bool = False
    points: float = 0.0
    own: float = 0.0
    characters: int = 0
    linked: int = 0
    links: int = 0
    children: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    """Text between two block boundaries, in its nearest block element."""

    element: int
    text: str
    linked: int


def _names(attributes: str) -> tuple[list[set[str]], bool]:
    """Lower-case words of each name in class, id and role, and whether the element is hidden."""
    names: list[set[str]] = []
    hidden = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            names.extend({w.lower() for w in NAME_WORDS.findall(name)} for name in value.split())
    return names, hidden


class Page:
    """Elements and text blocks of one page; every rule takes time in proportion to its size."""

    def __init__(self, source: str):
        self.elements = [Element("#page", -1, False, False)]
        self.blocks: list[Block] = []
        self.open = [0]
        self.parts: list[str] = []
        self.linked = 0
        self.anchors = 0
        self._read(source)
        self._flush()

    def _block(self) -> int:
        return next(i for i in reversed(self.open) if i == 0 or self.elements[i].name in BLOCKS)

    def _flush(self) -> None:
        if self.parts:
            text = WHITE.sub(" ", "".join(self.parts)).strip(" ")
            if text:
                self.blocks.append(Block(self._block(), text, min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def _text(self, text: str) -> None:
        if text and not self.elements[self.open[-1]].outside:
            text = html.unescape(text)
            self.parts.append(text)
            if self.anchors:
                self.linked += len(text.strip())

    def _pop(self) -> None:
        if self.elements[self.open.pop()].name == "a":
            self.anchors -= 1

    def _close(self, names: tuple[str, ...], stops: frozenset[str] = frozenset()) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            name = self.elements[self.open[at]].name
            if name in names:
                while len(self.open) > at:
                    self._pop()
                return
            if name in stops:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._flush()
            self._close(("p",), STOPS)
        if name in CLOSES:
            self._close(CLOSES[name], STOPS - set(CLOSES[name]))
        if name == "a":
            self._close(("a",), STOPS)
        parent = self.elements[self.open[-1]]
        names, hidden = _names(attributes) if attributes else ([], False)
        words, suspect = set().union(*names), False
        content = name in ("article", "main") or (name in BLOCKS and bool(words & KEPT_WORDS))
        outside = parent.outside or hidden or name in OUTSIDE
        if name not in ("article", "main", "body", "html"):
            within = any(self.elements[i].name in ("article", "main") for i in self.open)
            marking = OUTSIDE_WORDS - ({"header"} if within else set())
            marked = [n for n in names if n & marking]
            if marked and not (words & KEPT_WORDS and words & marking <= {"sidebar", "widget", "header", "nav"}):
                # "related-posts" is outside; "related-work" may be anything.
                clear = any(n <= OUTSIDE_WORDS | PLAIN_WORDS | KEPT_WORDS for n in marked)
                outside, suspect = outside or clear, not clear
            outside |= name == "header" and not within
        self.elements.append(Element(name, self.open[-1], outside, content, suspect))
        parent.children.append(len(self.elements) - 1)
        if name in VOID:
            if name in ("br", "hr", "img", "wbr"):
                self._text(" " if name != "wbr" else "")
            return
        self.open.append(len(self.elements) - 1)
        if name == "a":
            self.anchors += 1
            self.elements[self._block()].links += 1

    def _read(self, source: str) -> None:
        at = 0
        while (m := TOKEN.search(source, at)) is not None:
            self._text(source[at : m.start()])
            at = m.end()
            name = (m["name"] or m["odd_name"] or "").lower()
            if not name:
                continue
            attributes = m["attributes"] or m["odd_attributes"] or ""
            if m["close"] or m["odd_close"]:
                if name in BLOCKS:
                    self._flush()
                self._close((name,))
            else:
                self._start(name, attributes)
                if name in RAW:
                    end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
                    self._pop()
        self._text(source[at:])


def _score(page: Page) -> None:
    """Points rise from each block: all of them to the element that holds the paragraph, half
    to the one above, then a third of half, a quarter, and so on."""
    elements = page.elements
    for block in page.blocks:
        size, commas = len(block.text), block.text.count(",") + block.text.count("，")
        points = (1 + commas + size / 100) * (1 - block.linked / size)
        at = block.element
        elements[at].own += points
        if elements[at].name in ("p", "pre", "li", "td", "dd", "dt", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"):
            at = max(0, elements[at].parent)
        step = 0
        while at >= 0:
            elements[at].points += points / (1 if step == 0 else 2 * step)
            step, at = step + 1, elements[at].parent
        at = block.element
        while at >= 0:
            elements[at].characters += size
            elements[at].linked += block.linked
            at = elements[at].parent
    for element in reversed(elements[1:]):
        elements[element.parent].links += element.links


def _final(element: Element) -> float:
    density = element.linked / element.characters if element.characters else 0.0
    return element.points * (1 - density) * (2 if element.content else 1) * (SUSPECT_POINTS if element.suspect else 1)


def main_text(source: str) -> str:
    """Blocks of the main text in page order, two line ends between them; empty if none."""
    page = Page(source)
    if not page.blocks:
        return ""
    _score(page)
    elements = page.elements
    best = max(range(len(elements)), key=lambda i: (_final(elements[i]), -i))
    chosen = {best}
    limit = SIBLING_SHARE * _final(elements[best])
    for i in elements[elements[best].parent].children if best else ():
        e = elements[i]
        if i == best or e.outside or not e.characters:
            continue
        few_links = e.linked <= SIBLING_LINKS * e.characters
        # Points of a paragraph's or heading's own text went to the parent.
        if (max(_final(e), e.own) >= max(limit, 1e-9) and few_links) or (e.name == "p" and e.characters >= SIBLING_CHARACTERS and few_links):
            chosen.add(i)
    kept = [False] * len(elements)
    whole_page = elements[best].name in ("body", "html", "#page")
    for i, e in enumerate(elements):
        menu = whole_page and e.name in ("ul", "ol") and e.links > 1 and e.linked > MENU_LINKS * e.characters
        foreign = e.suspect and e.linked > SUSPECT_LINKS * e.characters
        kept[i] = i in chosen or (i > 0 and kept[e.parent] and not menu and not foreign)
    return "\n\n".join(b.text for b in page.blocks if kept[b.element])


def extract_text(
    df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """``id_col``, the ``keep`` columns, ``text`` and its length ``n_chars`` for every page.

    A null or empty page, or one with no text outside menus, adverts and the like, gives an
    empty text. Pages cut off anywhere are read as far as they go, long ones whole. Of elements
    with equal points the first holds the main text. Within it lists of links and sections stay,
    whatever a part of their names may hint at, if they are text and not links. Each row, also a
    repeated one, gives one row; further columns are not read. An empty table gives no rows.
    """
    names = [id_col, *[c for c in keep if c not in (id_col, "text", "n_chars")]]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def extract(rows):
        texts = [main_text(source) for source in rows["html"]]
        return {c: rows[c] for c in apart.values()} | {"text": texts, "n_chars": [len(t) for t in texts]}

    apart = kept_apart(names)
    schema = ", ".join(f"{r} {kinds[c]}" for c, r in apart.items()) + ", text string, n_chars long"
    picked = df.select(*[F.col(c).alias(r) for c, r in apart.items()], text_or_empty(html_col).alias("html"))
    return map_rows(picked, extract, schema).withColumnsRenamed({r: c for c, r in apart.items()})
